"""Sharding by balanced label propagation, with DataFrame operations only.

Documents start in hashed shards.  Equal texts are linked; their link is one row per
group and shard, never a pair.  Each round a group's documents want to move to the
shard that holds most of them and has room, as many as its quota admits, in the order of
a hash that keeps a group together (documents of a large group are admitted one by one).
Where a small group's main shard is full, its documents there follow if the whole group
is admitted.  Every move gathers its group further, so rounds end: when nothing moves.
A shard's quota is its even share less the linked documents it holds: unlinked ones give
way.  At last shards above their exact share give their surplus, unlinked documents
first, to those below.  Ranks are distributed: a count per shard and hash range, offsets over that
small table, and row numbers within a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key, settled

SHARDS = 24
#: Documents of larger groups are admitted by themselves, those of smaller ones together.
TOGETHER = 256
#: Hash ranges of a shard, as a power of two; a range is ranked by one task.
RANGES = 10


def _ranked(df: DataFrame, key: str, order: str, tie: str, out: str) -> DataFrame:
    """Adds the rank (from 0) of each row within ``key`` by ``order``, a long from 0 on, and ``tie``."""
    ranges = df.withColumn("_range", F.shiftright(F.col(order), 63 - RANGES).cast("int"))
    counts = ranges.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_range").orderBy(order, tie)
    numbered = ranges.withColumn("_nth", F.row_number().over(inside))
    # at most 2 ** RANGES rows for each shard
    joined = numbered.join(F.broadcast(offsets), [key, "_range"])
    return joined.withColumn(out, F.col("_before") + F.col("_nth") - 1).drop("_range", "_nth", "_before")


def _positive(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 1)


def _counts(df: DataFrame, key: str, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in df.groupBy(key).agg(F.count(F.lit(1))).collect()}
    return [found.get(s, 0) for s in range(shards)]


def _look(values: list[int], key: str) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col(key) + 1)


def _round(now: DataFrame, shards: int, share: int, nth: int) -> DataFrame:
    """Move linked documents to the shard that holds most of their group and has room; ``_moved`` tells which."""
    linked = now.where("_linked > 1")
    quota = [max(0, share - n) for n in _counts(linked, "_shard", shards)]
    open_shard = _look(quota, "_shard") > 0
    votes = linked.groupBy("_group", "_shard").agg(F.count(F.lit(1)).alias("_n"))
    ranked = F.struct(F.col("_n"), F.xxhash64("_group", "_shard").alias("_h"), F.col("_shard").alias("_s"))
    wish = votes.groupBy("_group").agg(F.max(F.when(open_shard, ranked)).alias("_open"))
    # the group's main shard if it has room, else its best one that has
    wish = wish.select("_group", F.col("_open._s").alias("_aim"), F.col("_open._n").alias("_at_aim"))
    mine = linked.join(wish, "_group").join(votes.select("_group", "_shard", "_n"), ["_group", "_shard"])
    mine = mine.where(F.col("_aim").isNotNull() & (F.col("_shard") != F.col("_aim")))
    # documents of a fuller shard that is closed only follow, behind all others
    follows = F.struct("_n", F.xxhash64("_group", "_shard")) > F.struct("_at_aim", F.xxhash64("_group", "_aim"))
    mine = mine.withColumn("_follows", follows).where(~F.col("_follows") | (F.col("_linked") <= TOGETHER))
    together = F.when(F.col("_linked") > TOGETHER, F.xxhash64("_row", F.lit(5))).otherwise(F.xxhash64("_group", F.lit(5 + nth)))
    order = F.shiftrightunsigned(together, 2) + F.when(F.col("_follows"), F.lit(2**62)).otherwise(F.lit(0))
    movers = mine.select("_row", "_group", "_linked", "_at_aim", "_aim", "_follows", order.alias("_order"))
    movers = _ranked(movers, "_aim", "_order", "_row", "_rank")
    fits = movers.where(F.col("_rank") < _look(quota, "_aim"))
    whole = fits.where(F.col("_linked") <= TOGETHER).groupBy("_group").agg((F.count(F.lit(1)) + F.first("_at_aim") == F.first("_linked")).alias("_whole"))
    admitted = fits.join(whole, "_group", "left").where("not _follows or _whole").select("_row", "_aim")
    moved = now.join(admitted, "_row", "left").withColumn("_moved", F.col("_aim").isNotNull())
    return settled(moved.withColumn("_shard", F.coalesce("_aim", "_shard")).drop("_aim"))


def _evened(now: DataFrame, shards: int, total: int) -> DataFrame:
    """Shards above their share give the surplus, unlinked documents first, to those below."""
    held = _counts(now, "_shard", shards)
    share = [total // shards] * shards
    for s in sorted(range(shards), key=lambda s: (-held[s], s))[: total % shards]:
        share[s] += 1
    surplus = [max(0, n - t) for n, t in zip(held, share)]
    if not any(surplus):
        return now
    first = [sum(surplus[:s]) for s in range(shards)]
    order = F.shiftrightunsigned(F.xxhash64("_row", F.lit(9)), 2) + F.when(F.col("_linked") > 1, F.lit(2**62)).otherwise(F.lit(0))
    over = now.where(_look(surplus, "_shard") > 0).select("_row", "_shard", order.alias("_order"))
    given = _ranked(over, "_shard", "_order", "_row", "_rank").where(F.col("_rank") < _look(surplus, "_shard"))
    place = F.col("_rank") + _look(first, "_shard")
    aim, at = F.lit(None).cast("int"), 0
    for s in range(shards):
        wanted = max(0, share[s] - held[s])
        if wanted:
            aim = F.when((place >= at) & (place < at + wanted), F.lit(s)).otherwise(aim)
            at += wanted
    moved = now.join(given.select("_row", aim.alias("_aim")), "_row", "left")
    return moved.withColumn("_shard", F.coalesce("_aim", "_shard")).drop("_aim")


def shards_of(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shard and slot of every document under the law ``rows``.

    Returns the id, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``, ``law``,
    ``shard`` (0 to ``shards`` - 1; their document counts differ by one at most), ``slot``
    (gapless from 0 in each shard), ``grown_shard`` (null under this law), ``start_shard``
    (before any move) and ``linked`` (documents of equal text, itself included).

    A null text counts as empty, and empty texts as equal.  A null id comes back null;
    rows that share an id are documents each.  Empty shards are left out; an empty table
    gives an empty table.  Texts are equal if their lengths, CRC-32 and 64-bit hashes are.
    Other columns are not read.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    own = docs.select(
        id_key(id_col).alias("_id"),
        (F.octet_length(text) + 8).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        F.xxhash64(text).alias("_h"),
    )
    own = own.select("_id", "_size", "_crc", F.xxhash64("_h", "_crc", "_size").alias("_group"))
    own = settled(own.withColumn("_row", F.monotonically_increasing_id()))
    total = own.count()
    groups = own.groupBy("_group").agg(F.count(F.lit(1)).alias("_linked"))
    start = F.pmod(F.xxhash64("_id", "_row", F.lit(1)), F.lit(shards)).cast("int")
    now = own.select("_row", "_group").join(groups, "_group").join(own.select("_row", "_id"), "_row")
    now = settled(now.select("_row", "_group", "_linked", start.alias("_shard"), start.alias("_start")))
    nth, moving = 0, True
    while moving:
        now = _round(now, shards, total // shards, nth)
        moving = not now.where("_moved").isEmpty()
        now, nth = now.drop("_moved"), nth + 1
    now = _evened(now, shards, total)
    slots = _ranked(now.withColumn("_order", _positive(F.xxhash64("_row", F.lit(13)))), "_shard", "_order", "_row", "slot")
    out = own.drop("_group").join(slots, "_row")
    return out.select(
        id_back("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_start").alias("start_shard"),
        F.col("_linked").alias("linked"),
    )


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return shards_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
