"""Writing tables.  Spark writes folders and creates their parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt import KEY, TIME
from fleetwatt.functions.clock import as_column


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_feature_table(
    df: DataFrame, path: str, key: str = KEY, time: str = TIME, buckets: int = 64, mode: str = "overwrite"
) -> None:
    """Parquet by series bucket and month, so scans prune on both.

    A bucket of a month may still be hot; the salt spreads it over several files.
    """
    rows = df.withColumn("series_bucket", F.pmod(F.xxhash64(as_column(key)), F.lit(buckets)).cast("int")).withColumn(
        "month", F.date_format(time, "yyyy-MM")
    )
    salt = F.pmod(F.xxhash64(as_column(time)), F.lit(8))
    rows.repartition("series_bucket", "month", salt).write.mode(mode).partitionBy("series_bucket", "month").parquet(path)
