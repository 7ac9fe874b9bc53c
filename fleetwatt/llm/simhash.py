"""SimHash near-dedup by anchor points of a covering code.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit of
their upper or of their lower half.  The anchors of a half are the words of a [31, 26]
Hamming code times one free bit: every half lies within one bit (the covering radius) of
an anchor, its home.  Each fingerprint is replicated to every anchor within radius plus
threshold, two bits, of either half: at most 17 anchors a half.  If two halves differ in
one bit or less, each is then found at the other's home, so comparing the fingerprints of
each anchor finds every link, and anchors without a home fingerprint need no look.

Anchors with many fingerprints are cut into tiles that separate tasks compare.  A task
returns a star for each connected piece, never its pairs; stars merge by alternating
large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key, settled, text_bytes

HALF = 32
#: Fingerprints of one anchor that one task compares; anchors with more are cut into tiles.
TILE = 2048
#: Runs up to this size are compared all at once by shifting the sorted column.
SHORT = 32


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """The XXH64 (seed 42) values of all word shingles, repeats included; none for a text without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    last = min(shingle, len(words)) - 1
    spans = zip((ends - size)[: len(words) - last].tolist(), ends[last:].tolist())
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - last)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits of the hashes of all word shingles."""
    return majority(shingle_hashes(text, shingle))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero for none."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        some = h[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_fp`` (the fingerprint as a signed long) of every document."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["_id", "_fp"])

    return docs.select(id_key(id_col).alias("_id"), text_bytes(text_col).alias("_text")).mapInArrow(of, "_id long, _fp long")


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Of 31-bit words whose bit i - 1 is position i: the exclusive or of the set positions."""
    s = np.zeros(len(x), np.int64)
    for i in range(1, HALF):
        s ^= ((x >> (i - 1)) & 1) * i
    return s


def anchors(half: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows, their anchor within two bits, and whether it is their home; 32-bit halves."""
    low, free = half & 0x7FFFFFFF, half >> 31
    s = _syndrome(low)
    every, off = np.arange(len(half)), np.flatnonzero(s)
    home = np.where(s > 0, low ^ np.where(s > 0, 1 << np.maximum(s - 1, 0), 0), low)
    yield every, home | free << 31, True
    yield every, home | (1 - free) << 31, False
    for i in range(1, HALF):
        j = s[off] ^ i
        rows = off[(j > i)]
        yield rows, (low[rows] ^ (1 << (i - 1)) ^ (1 << ((s[rows] ^ i) - 1))) | free[rows] << 31, False


def _replicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy().view(np.uint64)
        for side in (0, 1):
            half = ((fp >> np.uint64(HALF * side)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            for rows, anchor, home in anchors(half):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor | side << HALF), pa.array(fp[rows].view(np.int64)), pa.array(np.full(len(rows), home))],
                    names=["_anchor", "_fp", "_home"],
                )


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's connected piece, for links a - b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _dense_roots(x: np.ndarray, most: int) -> np.ndarray:
    near = np.empty((len(x), len(x)), bool)
    for at in range(0, len(x), 256):
        near[at : at + 256] = np.bitwise_count(x[at : at + 256, None] ^ x[None, :]) <= most
    root = np.arange(len(x))
    while True:
        new = np.array([root[row].min() for row in near])
        np.minimum.at(new, root, new.copy())
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _stars(x: np.ndarray, edges: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links row - smallest row of its piece, for sorted runs that begin at ``edges``."""
    n = len(x)
    sizes = np.diff(np.append(edges, n))
    run = np.repeat(np.arange(len(edges)), sizes)
    root = np.arange(n)
    short = (sizes <= SHORT)[run]
    a, b = [], []
    for shift in range(1, min(SHORT, int(sizes.max(initial=1)))):
        i = np.flatnonzero((run[:-shift] == run[shift:]) & short[:-shift])
        i = i[np.bitwise_count(x[i] ^ x[i + shift]) <= most]
        a.append(i)
        b.append(i + shift)
    if a:
        root = _roots(n, np.concatenate(a), np.concatenate(b))
    for k in np.flatnonzero(sizes > SHORT):
        at = slice(edges[k], edges[k] + sizes[k])
        root[at] = edges[k] + _dense_roots(x[at], most)
    away = np.flatnonzero(root != np.arange(n))
    return x[away], x[root[away]]


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Links ``_a, _b`` between distinct fingerprints that join all within ``most`` bits."""
    if not 0 <= most <= 3:
        raise ValueError("two halves cover at most three differing bits")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            key, tile = batch["_anchor"].to_numpy(), batch["_tile"].to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
            edges = np.concatenate([[0], new])
            done = edges[-1]
            rest = batch.iloc[done:]
            if done:
                yield found(batch["_fp"].to_numpy()[:done], edges[:-1])
        if rest is not None and len(rest):
            yield found(rest["_fp"].to_numpy(), np.array([0]))

    def found(fp: np.ndarray, edges: np.ndarray) -> pd.DataFrame:
        a, b = _stars(fp.view(np.uint64), edges, most)
        return pd.DataFrame({"_a": a.view(np.int64), "_b": b.view(np.int64)}).drop_duplicates()

    placed = fps.select("_fp").mapInArrow(_replicated, "_anchor long, _fp long, _home boolean")
    here = Window.partitionBy("_anchor")
    met = placed.select("_anchor", "_fp", F.count(F.lit(1)).over(here).alias("_n"), F.max("_home").over(here).alias("_any"))
    met = met.where("_n > 1 and _any").withColumn("_cuts", F.ceil(F.col("_n") / TILE).cast("int"))
    mine = F.pmod(F.xxhash64("_fp"), F.col("_cuts")).cast("int")
    tiled = met.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1)))
    tile = F.least("_mine", "_other").cast("long") * F.lit(2**31) + F.greatest("_mine", "_other")
    dealt = tiled.select("_anchor", "_fp", tile.alias("_tile")).repartition("_anchor", "_tile").sortWithinPartitions("_anchor", "_tile")
    return dealt.mapInPandas(compared, "_a long, _b long").distinct()


def linked(fps: DataFrame, most: int = 3) -> DataFrame:
    """The same links as ``_u, _v`` between the ``_first`` of the fingerprints."""
    found = links(fps, most)
    ends = found.join(fps.select(F.col("_fp").alias("_a"), F.col("_first").alias("_u")), "_a")
    return ends.join(fps.select(F.col("_fp").alias("_b"), F.col("_first").alias("_v")), "_b").select("_u", "_v")


def _stable(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``_u, _v``: every linked node but the smallest of its component, and that smallest one.

    Alternates large-star and small-star rounds over a settled edge table until nothing
    moves; the number of rounds grows with the logarithm of the largest component.
    """
    now = settled(edges.select(F.greatest("_u", "_v").alias("_u"), F.least("_u", "_v").alias("_v")).where("_u <> _v").distinct())
    mark = _stable(now)
    while True:
        both = now.unionByName(now.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
        least = both.groupBy("_u").agg(F.min("_v").alias("_m")).select("_u", F.least("_u", "_m").alias("_m"))
        large = both.join(least, "_u").where("_v > _u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct()
        low = large.groupBy("_u").agg(F.min("_v").alias("_m"))
        small = large.join(low, "_u").where("_v <> _m").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        after = settled(small.unionByName(low.select("_u", F.col("_m").alias("_v"))).where("_u <> _v").distinct())
        new = _stable(after)
        if new == mark:
            return after
        now, mark = after, new


def near_copies(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's id, ``fingerprint`` (16 hex digits) and ``component_id``.

    A component holds the documents that chains of fingerprints at ``most`` or fewer
    differing bits join; its id is its smallest document id.  Texts are lower-cased (A-Z)
    and cut into words at ASCII white space; fewer words than a shingle give one shingle,
    none (also a null text) the fingerprint zero, which links like any other.  A null id
    counts as smaller than all and comes back null; rows that share an id give one result
    each.  An empty table gives an empty table.  Other columns are not read.
    """
    own = settled(fingerprints(docs, shingle, id_col, text_col))
    fps = settled(own.groupBy("_fp").agg(F.min("_id").alias("_first")))
    stars = components(linked(fps, most))
    named = fps.join(stars, F.col("_first") == F.col("_u"), "left").select("_fp", F.coalesce("_v", "_first").alias("_component"))
    out = own.join(named, "_fp")
    return out.select(
        id_back("_id").alias(id_col),
        F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        id_back("_component").alias("component_id"),
    )


def without_later(docs: DataFrame, marked: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the ids whose ``component_id`` in ``marked`` is another one."""
    names = docs.columns
    marked = marked.select(id_key(id_col).alias("_gone"), id_key("component_id").alias("_first"))
    gone = marked.where("_gone <> _first").select("_gone").distinct()
    inner = docs.select(id_key(id_col).alias("_id"), *[column(c).alias(f"_c{i}") for i, c in enumerate(names)])
    left = inner.join(gone, F.col("_id") == F.col("_gone"), "left_anti")
    return left.select(*[column(f"_c{i}").alias(c) for i, c in enumerate(names)])


def one_of_each(docs: DataFrame, shingle: int = 3, most: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those whose component has a smaller id.

    Rows that share an id are one document and stay or go together.
    """
    return without_later(docs, near_copies(docs, shingle, most, id_col, text_col), id_col)


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
