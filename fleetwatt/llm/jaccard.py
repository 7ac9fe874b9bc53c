"""Near copies by SimHash and MinHash bands, checked by the Jaccard similarity of their word shingles.

Documents with the same set of shingles are one node.  Nodes whose SimHash fingerprints
differ in at most three bits are candidates, found at the anchor points of ``simhash``.
Three bits reach few pairs at similarity 0.8, so bands find the others: a band is a hash
of ``ROWS`` minima; nodes that share one are candidates too, linked as a star to the
smallest of the band.  At similarity s a pair shares none of the bands with probability
(1 - s ** ROWS) ** BANDS: 3 in a million at 0.8, fewer above.

Candidates are only asked, never linked by these alone: the exact similarity of each
member to the first of its candidate component comes first, and where some member is not
near the first, all pairs that this leaves open follow, in tiles.  So the result is that
of comparing every pair of candidates; a large group whose members are all near its
first is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import id_back, id_key, settled, text_bytes
from fleetwatt.llm.simhash import components, linked, majority, shingle_hashes, without_later

BANDS = 32
ROWS = 5
#: Nodes, and MB of their shingles, of one candidate component that one task compares with as many others.
TILE = 2048
TILE_MB = 8.0
#: Shingles whose minima are taken at once.
CHUNK = 2048

_RANDOM = np.random.default_rng(42)
_TIMES = _RANDOM.integers(0, 2**64, BANDS * ROWS, np.uint64) | np.uint64(1)
_MIX = _RANDOM.integers(0, 2**64, (BANDS, ROWS), np.uint64) | np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**64, BANDS, np.uint64)


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """The sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(text, shingle))


def _set_key(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), 42)


def bands(own: np.ndarray) -> np.ndarray:
    """The band keys of a set of shingles; an empty one has none."""
    if not len(own):
        return np.zeros(0, np.uint64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(own), CHUNK):
        np.minimum(least, (_TIMES[:, None] * own[None, at : at + CHUNK]).min(axis=1), out=least)
    return (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + _PLUS


def is_near(both, a, b):
    """Whether sets of ``a`` and ``b`` shingles that share ``both`` have similarity 0.8 or more, in whole numbers."""
    return 9 * both >= 4 * (a + b)


def _set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint64)


def _near_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pairs = zip(map(_set, b.column("_hashes").to_pylist()), map(_set, b.column("_lead").to_pylist()))
        ok = [bool(is_near(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))) for x, y in pairs]
        yield pa.RecordBatch.from_arrays([b.column("_set"), b.column("_root"), pa.array(ok, pa.bool_())], names=["_set", "_root", "_ok"])


def pieces(sets: list[np.ndarray], ask: np.ndarray) -> np.ndarray:
    """Smallest row of each row's connected piece, by the near rows of each row to ``ask``."""
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    code = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    holder = np.repeat(np.arange(n), sizes)[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(code))])
    ends = np.cumsum(sizes)
    root = np.arange(n)
    for i in np.flatnonzero(ask):
        mine = code[ends[i] - sizes[i] : ends[i]]
        times = start[mine + 1] - start[mine]
        skip = start[mine] - np.concatenate([[0], np.cumsum(times)[:-1]])
        both = np.bincount(holder[np.repeat(skip, times) + np.arange(times.sum())], minlength=n)
        joined = np.zeros(n, bool)
        joined[root[is_near(both, sizes[i], sizes)]] = True
        root[joined[root]] = np.flatnonzero(joined)[0]
    return root


def _tile(group: pd.DataFrame) -> pd.DataFrame:
    root = pieces([_set(x) for x in group["_hashes"]], ~group["_ok"].to_numpy(bool))
    keys, away = group["_set"].to_numpy(np.int64), np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"_a": keys[away], "_b": keys[root[away]]})


def _close(nodes: DataFrame) -> DataFrame:
    """Links ``_u, _v`` between nodes that join all whose fingerprints differ in at most three bits."""
    fps = settled(nodes.groupBy("_fp").agg(F.min("_set").alias("_first")))
    equal = nodes.join(fps, "_fp").where("_set <> _first").select(F.col("_set").alias("_u"), F.col("_first").alias("_v"))
    return linked(fps).unionByName(equal)


def _links(texts: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """Links ``_a, _b`` between nodes that join all candidates of similarity 0.8 or more."""
    placed = nodes.select("_set", F.explode("_bands").alias("_band"))
    firsts = placed.groupBy("_band").agg(F.min("_set").alias("_v"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    banded = placed.join(firsts, "_band").where("_set <> _v").select(F.col("_set").alias("_u"), "_v")
    maybe = components(banded.unionByName(_close(nodes.where("_fp is not null").select("_set", "_fp"))))
    members = maybe.unionByName(maybe.select(F.col("_v").alias("_u"), "_v").distinct())
    members = members.select(F.col("_u").alias("_set"), F.col("_v").alias("_root")).join(nodes.select("_set", "_th"), "_set")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingles(t, shingle).tobytes() for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_set"), b.column("_root"), pa.array(own, pa.binary())], names=["_set", "_root", "_hashes"])

    once = texts.dropDuplicates(["_th"])
    sets = settled(once.join(members, "_th").select("_set", "_root", "_text").mapInArrow(read, "_set long, _root long, _hashes binary"))
    lead = sets.where("_set = _root").select("_root", F.col("_hashes").alias("_lead"))
    asked = sets.where("_set <> _root").join(lead, "_root").mapInArrow(_near_first, "_set long, _root long, _ok boolean")
    asked = settled(asked)

    sizes = sets.groupBy("_root").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("_hashes")).alias("_bytes"))
    cuts = F.greatest(F.ceil(F.col("_n") / TILE), F.ceil(F.col("_bytes") / (TILE_MB * 1e6))).cast("int")
    left = asked.where("not _ok").select("_root").distinct().join(sizes, "_root").select("_root", cuts.alias("_cuts"))
    open_sets = sets.join(left, "_root").join(asked.select("_set", "_ok"), "_set", "left")
    # the first and those near it are one piece already; every pair that is left has a member that is not
    mine = F.pmod(F.xxhash64("_set"), F.col("_cuts")).cast("int")
    dealt = open_sets.withColumn("_ok", F.coalesce("_ok", F.lit(True))).withColumn("_mine", mine)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    tile = F.least("_mine", "_other").cast("long") * F.lit(2**31) + F.greatest("_mine", "_other")
    found = dealt.select("_root", tile.alias("_tile"), "_set", "_ok", "_hashes").groupBy("_root", "_tile").applyInPandas(_tile, "_a long, _b long")
    return found.unionByName(asked.where("_ok").select(F.col("_set").alias("_a"), F.col("_root").alias("_b")))


def near_copies(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's id and ``component_id``: the smallest id that chains of similarity 0.8 or more join.

    The similarity is that of the sets of ``shingle`` words in a row (compared by 64-bit
    hashes); texts are lower-cased (A-Z) and cut into words at ASCII white space.  Fewer
    words than a shingle give one shingle; texts without words (also null) are equal to
    each other and to no others.  Ids as in ``simhash.near_copies``.
    """
    texts = docs.select(id_key(id_col).alias("_id"), text_bytes(text_col).alias("_text")).withColumn("_th", F.xxhash64("_text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingles(t, shingle) for t in b.column("_text").to_pylist()]
            keys = pa.array(np.array([_set_key(x) for x in own], np.uint64).view(np.int64))
            each = pa.array([bands(x).view(np.int64) for x in own], pa.list_(pa.int64()))
            bits = pa.array(np.array([majority(x) for x in own], np.uint64).view(np.int64), mask=np.array([not len(x) for x in own], bool))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_th"), keys, bits, each], names=["_id", "_th", "_set", "_fp", "_bands"])

    own = settled(texts.mapInArrow(of, "_id long, _th long, _set long, _fp long, _bands array<long>"))
    # sets that are equal have equal fingerprints and bands, so any of them will do
    first = [F.first(c).alias(c) for c in ("_fp", "_bands")]
    nodes = settled(own.groupBy("_set").agg(F.min("_id").alias("_first"), F.min("_th").alias("_th"), *first))
    found = settled(_links(texts.select("_th", "_text"), nodes, shingle))
    ends = found.join(nodes.select(F.col("_set").alias("_a"), F.col("_first").alias("_u")), "_a")
    ends = ends.join(nodes.select(F.col("_set").alias("_b"), F.col("_first").alias("_v")), "_b").select("_u", "_v")
    stars = components(ends)
    named = nodes.select("_set", "_first").join(stars, F.col("_first") == F.col("_u"), "left").select("_set", F.coalesce("_v", "_first").alias("_component"))
    return own.select("_id", "_set").join(named, "_set").select(id_back("_id").alias(id_col), id_back("_component").alias("component_id"))


def one_of_each(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those whose component has a smaller id; rows that share an id stay or go together."""
    return without_later(docs, near_copies(docs, shingle, id_col, text_col), id_col)
