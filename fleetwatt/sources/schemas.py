"""Schemas of the tables the package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

from fleetwatt import KEY, TIME


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_D, _S, _I, _T = T.DoubleType(), T.StringType(), T.IntegerType(), T.TimestampNTZType()

# Signal names of the raw hourly files.
WEATHER = (
    "Price",
    "Temperature",
    "Pressure (hPa)",
    "Cloud_cover (%)",
    "Cloud_cover_low (%)",
    "Cloud_cover_mid (%)",
    "Cloud_cover_high (%)",
    "Wind_speed_10m (km/h)",
    "Shortwave_radiation (W/m²)",
    "direct_radiation (W/m²)",
    "diffuse_radiation (W/m²)",
    "direct_normal_irradiance (W/m²)",
)

# files carry text moments with an offset; `normalise_time` turns them into naive UTC
FORECAST_CSV = _table((TIME, _S), ("Demand", _D), ("pv", _D), *[(w, _D) for w in WEATHER])
STORAGE_CSV = _table((TIME, _S), ("pv_low", _D), ("pv_high", _D), *[(w, _D) for w in WEATHER])
TRAIN_CSV = _table(
    (TIME, _S), ("Demand", _D), ("pv", _D), ("pv_mod1", _D), ("pv_mod2", _D), ("pv_mod3", _D), *[(w, _D) for w in WEATHER]
)

SERIES = _table((KEY, _S), (TIME, _T), ("value", _D))
PREDICTION = _table((KEY, _S), ("model_name", _S), ("fold", _I), (TIME, _T), ("y_true", _D), ("y_pred", _D))
METRIC = _table((KEY, _S), ("model_name", _S), ("fold", _I), ("MAE", _D), ("RMSE", _D), ("nRMSE", _D))
