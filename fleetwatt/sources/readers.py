"""Reading CSV and parquet, tolerant of missing files and bad cells."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetwatt.functions.clock import as_column
from fleetwatt.operators.coerce import parse_time, to_number


def read_csv(spark: SparkSession, path: str, schema: T.StructType, times: Sequence[str] = ()) -> DataFrame:
    """Headed CSV by column name; unreadable numbers and moments become null.

    The file is read as text by its own header, so neither the order of its columns
    nor extra ones matter, then typed by ``schema``.
    """
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    typed = []
    for f in schema:
        if f.name not in text.columns:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name in times:
            typed.append(parse_time(f.name).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType):
            typed.append(to_number(f.name).alias(f.name))
        else:
            typed.append(as_column(f.name).try_cast(f.dataType).alias(f.name))
    return text.select(*typed)


def _or_empty(spark: SparkSession, read: Callable[[], DataFrame], schema: T.StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return spark.createDataFrame([], schema)
        raise


def timed_schema(schema: T.StructType, times: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.name in times else f.dataType) for f in schema])


def scan_csv_safe(spark: SparkSession, path: str, schema: T.StructType, times: Sequence[str] = ()) -> DataFrame:
    """``read_csv``; a path that is not there gives an empty table of the schema."""
    return _or_empty(spark, lambda: read_csv(spark, path, schema, times), timed_schema(schema, times))


def scan_parquet_safe(
    spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Parquet with only the wanted columns; a path that is not there gives an empty table."""
    names = list(columns or schema.names)
    wanted = T.StructType([schema[n] for n in names])
    return _or_empty(spark, lambda: spark.read.parquet(path).select(*[as_column(n) for n in names]), wanted)


def first_nonempty(candidates: Sequence[DataFrame]) -> DataFrame:
    """The first table with a row; the last one if all are empty.  Probes one row each."""
    for df in candidates[:-1]:
        if not df.isEmpty():
            return df
    return candidates[-1]


def rename_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]], first: str | None = None) -> DataFrame:
    """Canonical column names: the first alias present is renamed; ``first`` names column one."""
    out = df
    if first is not None and first not in out.columns:
        out = out.withColumnRenamed(out.columns[0], first)
    for name, others in aliases.items():
        if name not in out.columns:
            match = next((o for o in others if o in out.columns), None)
            if match is not None:
                out = out.withColumnRenamed(match, name)
    return out


def load_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV report without its all-null rows."""
    return scan_csv_safe(spark, path, schema).na.drop(how="all")
