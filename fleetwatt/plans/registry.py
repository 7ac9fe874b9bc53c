"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.clock import as_column
from fleetwatt.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 8
#: Shuffled bytes that one task of a query reads.  Hourly grids shrink to about eight bytes a
#: row when shuffled and need 20 times that to be sorted, so tasks are smaller than by default.
TASK_BYTES = "16m"


def tidy(df: DataFrame) -> DataFrame:
    """Result columns as the SQL side gives them: doubles to eight digits, naive moments."""
    out = []
    for f in df.schema:
        c = as_column(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, DIGITS) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
            return tidy(build(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
