"""Exact top-k inner products by MaxScore over shards of the candidates.

Terms are the dimensions.  Within a block of candidates the contribution of a term to a
query lies between two bounds; the difference is the most the term can add.  Terms are
taken by falling gain.  The essential ones are those without which the rest cannot lift
a candidate to the query's k-th best score so far; their postings are traversed for the
whole block, the others are probed, a few at a time, only for candidates that can still
compete.  Shards are searched by separate tasks, blocks of queries against one shard at a
time, and their best lists merge by rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column

K = 20
#: Candidates of a shard, queries of a block, candidates whose bounds are taken together.
SHARD, QUERIES, BLOCK = 8192, 4096, 2048
#: Non-essential terms probed between two cuts of the candidates.
PROBED = 8
_LONG = 2**63


class Index:
    """Postings of one shard: a row of values per term, blocks of columns with their bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.blocks = []
        for at in range(0, len(ids), BLOCK):
            some = order[at : at + BLOCK]
            x = np.ascontiguousarray(vectors[some].T)
            self.blocks.append((ids[some], x, x.min(axis=1), x.max(axis=1)))

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best, ties to smaller ids."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, q.dtype)
        for block_ids, x, low, high in self.blocks:
            if len(ids) < k:
                alive, total = np.arange(len(block_ids)), q @ x
            else:
                alive, total = self._competitive(q, x, low, high, scores[-1])
            if total.dtype == object:
                total = np.clip(total, -_LONG, _LONG - 1)
            mine = block_ids[alive] != own
            ids = np.concatenate([ids, block_ids[alive][mine]])
            scores = np.concatenate([scores, total[mine]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        return ids, scores

    @staticmethod
    def _competitive(q, x, low, high, least) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that reach ``least``, and their scores."""
        a, b = q * low, q * high
        top = np.maximum(a, b)
        order = np.argsort(-(top - np.minimum(a, b)), kind="stable")
        floor = np.minimum(a, b).sum()
        gain = (top - np.minimum(a, b))[order]
        rest = np.concatenate([np.cumsum(gain[::-1])[::-1], gain[:1] * 0])  # rest[i]: gain of the terms from i on
        essential = int(np.argmax(floor + rest < least)) if (floor + rest < least).any() else len(order)
        if essential == 0:
            return np.zeros(0, np.int64), np.zeros(0, q.dtype)
        first = order[:essential]
        total = q[first] @ x[first]
        bound = top[order[essential:]].sum()
        alive = np.flatnonzero(total + bound >= least)
        total = total[alive]
        for at in range(essential, len(order), PROBED):
            if not len(alive):
                break
            terms = order[at : at + PROBED]
            total = total + q[terms] @ (x[np.ix_(terms, alive)] if len(alive) < x.shape[1] else x[terms])
            bound = top[order[at + PROBED :]].sum()
            stay = total + bound >= least
            alive, total = alive[stay], total[stay]
        return alive, total


def _kind(dims: int, largest: float) -> str:
    """A number type in which every sum is exact."""
    bound = dims * largest * largest * 2
    return "float32" if bound < 2**24 else "float64" if bound < 2**53 else "object"


def _numbers(raw: bytes, dims: int, kind: str) -> np.ndarray:
    x = np.frombuffer(raw, np.float64).reshape(-1, dims)
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape) if kind == "object" else x.astype(kind)


def _packed(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """One row per key with its ids and vectors as binary, in that order, short vectors filled with zeros."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(group), dims))
        for i, v in enumerate(group["_v"]):
            x[i, : len(v)] = v
        order = sorted(range(len(group)), key=lambda i: (int(group["_id"].iat[i]), x[i].tobytes()))
        ids, x = group["_id"].to_numpy(np.int64)[order], x[order]
        return pd.DataFrame({key: [group[key].iat[0]], "_ids": [ids.tobytes()], "_x": [x.tobytes()]})

    return rows.groupBy(key).applyInPandas(pack, f"{key} int, _ids binary, _x binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` best candidates of every query row, against all other rows.

    Components x become floor(scale * x), x as double.  Returns ``query_id``, ``rank``
    (from 1), the id and ``score`` (integer inner product), ties to the smaller id; fewer
    rows if there are fewer candidates.  ``is_query`` is a condition on the input row.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component,
    take no part.  A shorter vector counts as filled with zeros.  Rows that share the
    query's id are its own and no candidates; other repeated ids are candidates each, and
    query rows that share an id have ``k`` places each, under that id.
    Scores beyond a long are held at its limits.  An empty table gives an empty table.
    """
    x = column(vector_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.expr("rint(0D)") + F.floor(v.cast("double") * F.lit(float(scale))).cast("double"))
    rows = vectors.where(column(id_col).isNotNull() & x.isNotNull()).where(fine)
    rows = rows.select(column(id_col).cast("long").alias("_id"), whole.alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    size = F.aggregate("_v", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    n, asked, dims, largest = rows.agg(F.count(F.lit(1)), F.count_if("_q"), F.max(F.size("_v")), F.max(size)).first()
    dims = max(1, dims or 0)
    kind = _kind(dims, largest or 0.0)
    shards, groups = max(1, math.ceil(n / SHARD)), max(1, math.ceil(asked / QUERIES))
    spread = F.xxhash64("_id", F.lit(3))
    held = _packed(rows.withColumn("_shard", F.pmod(spread, F.lit(shards)).cast("int")).drop("_q"), "_shard", dims)
    held = held.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asking = rows.where("_q").withColumn("_group", F.pmod(spread, F.lit(groups)).cast("int")).drop("_q")
    asking = _packed(asking, "_group", dims).select("_group", F.col("_ids").alias("_asked"), F.col("_x").alias("_qx"))
    asking = asking.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for group, ids, x, asked_ids, qx in zip(b["_group"], b["_ids"], b["_x"], b["_asked"], b["_qx"]):
                index = Index(np.frombuffer(ids, np.int64), _numbers(x, dims, kind))
                for nth, (own, q) in enumerate(zip(np.frombuffer(asked_ids, np.int64), _numbers(qx, dims, kind))):
                    found, scores = index.search(own, q, k)
                    row = int(group) << 32 | nth  # ids may repeat
                    yield pd.DataFrame({"_row": row, "query_id": own, "vec_id": found, "score": scores.astype(np.int64)})

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, size = [], 0
        for df in search(batches):
            some.append(df)
            size += len(df)
            if size > 50_000:
                yield pd.concat(some, ignore_index=True)
                some, size = [], 0
        if some:
            yield pd.concat(some, ignore_index=True)

    pairs = held.join(asking, ["_shard", "_group"]).select("_group", "_ids", "_x", "_asked", "_qx").repartition(shards * groups)
    each = pairs.mapInPandas(gathered, "_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("_row").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")


def op4_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP4_SQL = """
with e as (
    select vec_id, list_transform(embedding, lambda x : cast(floor(64 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x : x is null or isnan(x) or isinf(x))) = 0
),
q as (select *, row_number() over () as nth from e where vec_id % 20 = 0),
s as (
    select q.nth, q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p : p[1] * p[2])) as bigint) as score
    from q join e c on q.vec_id <> c.vec_id
)
select query_id, cast(row_number() over (partition by nth order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify row_number() over (partition by nth order by score desc, vec_id) <= 20
"""
