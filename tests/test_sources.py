"""Reading and writing files."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetwatt.operators.coerce import normalise_time
from fleetwatt.session import materialise
from fleetwatt.sources import readers, schemas, writers
from frames import START, series


def test_csv_with_bad_cells(spark, tmp_path):
    path = tmp_path / "meter.csv"
    path.write_text("pv,timestamp,Demand,extra\n0.5,2024-01-01 00:00:00+00:00,1.25,x\nbad,soon,2,y\n,2024-01-01 01:00:00+00:00,,z\n")
    df = readers.read_csv(spark, str(path), schemas.FORECAST_CSV, times=["timestamp"])
    assert df.columns == schemas.FORECAST_CSV.names
    got = [(r["timestamp"], r["Demand"], r["pv"], r["Price"]) for r in df.collect()]
    assert (START, 1.25, 0.5, None) in got and (None, 2.0, None, None) in got and len(got) == 3
    text = readers.read_csv(spark, str(path), schemas.FORECAST_CSV)
    assert normalise_time(text).count() == 2


def test_absent_paths_give_empty_tables(spark, tmp_path):
    gone = str(tmp_path / "gone")
    df = readers.scan_csv_safe(spark, gone, schemas.FORECAST_CSV, times=["timestamp"])
    assert df.isEmpty() and df.columns == schemas.FORECAST_CSV.names and dict(df.dtypes)["timestamp"] == "timestamp_ntz"
    assert readers.scan_parquet_safe(spark, gone, schemas.SERIES, ["value"]).columns == ["value"]
    assert readers.load_table(spark, gone, schemas.SERIES).isEmpty()


def test_round_trips(spark, tmp_path):
    df = series(spark, [1.0, None, 3.5])
    writers.write_csv(df, str(tmp_path / "deep" / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "deep" / "csv"), schemas.SERIES, times=["timestamp"])
    assert sorted(back.collect()) == sorted(df.collect())
    writers.write_feature_table(df, str(tmp_path / "features"))
    again = spark.read.parquet(str(tmp_path / "features")).select(df.columns)
    assert sorted(again.collect(), key=str) == sorted(df.collect(), key=str)
    assert sorted(materialise(df).collect(), key=str) == sorted(df.collect(), key=str)


def test_first_nonempty_and_aliases(spark):
    some, none = series(spark, [1.0]), series(spark, [])
    assert readers.first_nonempty([none, some, none]) is some
    assert readers.first_nonempty([none, none]) is none
    df = spark.createDataFrame([("a", 1.0)], "_c0 string, Importance double")
    assert readers.rename_aliases(df, {"importance": ["gain", "Importance"]}, first="feature").columns == ["feature", "importance"]


def test_scan_reads_only_the_wanted_columns(spark, tmp_path):
    path = str(tmp_path / "p")
    series(spark, range(10)).withColumn("other", F.lit(1)).write.parquet(path)
    df = readers.scan_parquet_safe(spark, path, schemas.SERIES, ["value"]).where("value > 3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<value:double>" in plan and "PushedFilters: [IsNotNull(value), GreaterThan(value,3.0)]" in plan


def test_intermediate_tables_go_with_their_block(spark):
    import glob

    from fleetwatt.session import materialise, scratch

    with scratch():
        table = materialise(spark.range(5), "short-lived")
        assert table.count() == 5
        (where,) = table.inputFiles()[:1] or [""]
        folder = where.removeprefix("file://").rsplit("/", 1)[0]
        assert glob.glob(folder)
    assert not glob.glob(folder)


def test_the_package_reaches_workers(spark):
    """Also if the driver found it by a path that workers do not have."""

    def where(batches):
        import pandas as pd

        import fleetwatt

        for _ in batches:
            yield pd.DataFrame({"path": [fleetwatt.__file__]})

    assert "fleetwatt" in spark.range(1).mapInPandas(where, "path string").first()[0]
