"""What several text operators share: settled tables, document blocks, sizes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatt.session import ensure_checkpoint_dir

#: A null id sorts before every other id and comes back as null.
NO_ID = -(2**63)


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def settled(df: DataFrame) -> DataFrame:
    """Compute a table once, cut its lineage, keep it in the shared checkpoint folder.

    Spark removes the files when nothing refers to the table any more (with
    ``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def id_key(name: str) -> Column:
    return F.coalesce(column(name).cast("long"), F.lit(NO_ID))


def id_back(name: str) -> Column:
    return F.when(column(name) != F.lit(NO_ID), column(name))


def text_bytes(name: str) -> Column:
    return F.coalesce(column(name), F.lit("")).cast("binary")


@dataclass(frozen=True)
class Blocks:
    """Documents dealt into blocks of consecutive ids; block numbers rise with the id."""

    table: DataFrame
    count: int
    text_bytes: int


def dealt(docs: DataFrame, id_col: str, text_col: str, block_mb: float, carry: tuple[str | Column, ...] = ()) -> Blocks:
    """``_block, _id, _text`` (and ``_c0 ..``, the carried columns), one partition per block or less.

    A block holds about ``block_mb`` of text; its boundaries are quantiles of the id, so
    the driver holds eight bytes for each block.  Rows of one id share a block.  All
    readers of the table share one shuffle of the text.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        id_key(id_col).alias("_id"),
        text_bytes(text_col).alias("_text"),
        *[(column(c) if isinstance(c, str) else c).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    total = keyed.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    count = max(2 * spark.sparkContext.defaultParallelism, math.ceil(total / (block_mb * 1e6)))
    points = [i / count for i in range(1, count)]
    cuts = keyed.agg(F.percentile_approx("_id", points, 20 * count)).first()[0] or []
    inner = sorted({float(c) for c in cuts})
    splits = [-math.inf, *(inner or [0.0]), math.inf]
    placed = Bucketizer(splits=splits, inputCol="_at", outputCol="_block").transform(keyed.withColumn("_at", F.col("_id").cast("double")))
    placed = placed.withColumn("_block", F.col("_block").cast("int")).drop("_at")
    return Blocks(placed.repartition(count, "_block"), count, total)
