"""LM scoring by a weighted backoff automaton of smoothed bigrams.

States are the words seen in training (and the start of a text) above one root.  An arc
h -> w, for a word pair seen in training, weighs the Dirichlet-smoothed probability
(c(hw) + mu * p(w)) / (c(h) + mu); the failure arc of h weighs mu / (c(h) + mu) and leads
to the root, whose arcs are the unigrams p(w) = (c(w) + 1/2) / (N + (V + 1) / 2), one of
them for all unknown words.  One pass from left to right carries the state and adds up
log10 weights.

The automaton is never in one place.  Documents are dealt into blocks; a block sends the
hash of each distinct word and pair it holds, with its training count, to parts, which
add up and answer every block in the order it asked.  The block then holds exactly the
part of the automaton that its texts touch and traverses it, all texts side by side.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, dealt, id_back, id_key, text_bytes

#: White space is in no word, so these stand for the start and the end of a text.
START, END = b" ", b"\n"
#: Weight of the unigrams against the pairs seen after a word.
MU = 100.0
#: Distinct words that a counting task holds before it passes them on.
HELD = 400_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _hashed(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


def _part(keys: np.ndarray, other: np.ndarray, parts: int) -> np.ndarray:
    """A part for each key by bits that the key does not have."""
    return ((_mixed(other * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


class Arcs:
    """The distinct words and pairs of a block, and its texts as a walk over them."""

    def __init__(self, texts: list[bytes]):
        known = {START: 0, END: 1}
        walks = []
        for t in texts:
            words = t.lower().split()
            walks.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        self.tokens = np.fromiter((len(w) + 1 for w in walks), np.int64, len(walks))
        one, two = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.to = np.concatenate([x for w in walks for x in (w, two)])
        self.at = np.concatenate([x for w in walks for x in (one, w)])
        hashes = _hashed(known)
        self.words = len(known)
        pairs, self.arc = np.unique(self.at * self.words + self.to, return_inverse=True)
        left, right = hashes[pairs // self.words], hashes[pairs % self.words]
        self.uni, self.uni_other = hashes, _mixed(hashes)
        self.pair = _mixed(left * np.uint64(0xC2B2AE3D27D4EB4F) + right)
        self.pair_other = _mixed(right * np.uint64(0x165667B19E3779F9) + left)

    def counts(self, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each word (as a token) and pair in the training texts."""
        on = np.repeat(training, self.tokens)
        return np.bincount(self.to[on], minlength=self.words), np.bincount(self.arc[on], minlength=len(self.pair))

    def order(self, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys (words, then pairs) in part order: the order, the sorted keys, rows per part."""
        keys = np.concatenate([self.uni, self.pair])
        part = _part(keys, np.concatenate([self.uni_other, self.pair_other]), parts)
        order = np.argsort(part.astype(np.uint16) if parts <= 2**16 else part, kind="stable")
        return order, keys[order], np.bincount(part, minlength=parts)

    def scores(self, uni: np.ndarray, pair: np.ndarray, total: int, distinct: int, mu: float) -> tuple[np.ndarray, ...]:
        """Known tokens, base score and automaton score of each text, from global counts."""
        p = (uni + 0.5) / (total + 0.5 * (distinct + 1))
        seen = uni.astype(np.float64)
        seen[0] = uni[1]  # every training text starts once and ends once
        root = np.log10(p)
        fail = np.log10(mu / (seen + mu))
        arc = np.zeros(len(pair))
        has = np.flatnonzero(pair)
        first = np.zeros(len(pair), np.int64)
        first[self.arc] = np.arange(len(self.arc))
        h, w = self.at[first[has]], self.to[first[has]]
        arc[has] = np.log10((pair[has] + mu * p[w]) / (seen[h] + mu))
        weight = np.where(pair[self.arc] > 0, arc[self.arc], fail[self.at] + root[self.to])
        begin = np.cumsum(self.tokens) - self.tokens
        return np.add.reduceat(uni[self.to] > 0, begin, dtype=np.int64), np.add.reduceat(root[self.to], begin), np.add.reduceat(weight, begin)


def training_size(texts: DataFrame, parts: int) -> tuple[int, int]:
    """Tokens and distinct tokens, ends included, of the texts in the binary column ``_text``."""

    def sent(words: set[bytes], tokens: int) -> pa.RecordBatch:
        h = _hashed(words)
        part = _part(h, _mixed(h), parts)
        order = np.argsort(part, kind="stable")
        cuts = np.cumsum([0, *np.bincount(part, minlength=parts)])
        rows = [h[order[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()), pa.array(rows, pa.binary()), pa.array([tokens] + [0] * (parts - 1), pa.int64())],
            names=["_part", "_words", "_tokens"],
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tokens = set(), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                mine = t.lower().split()
                words.update(mine)
                words.add(END)
                tokens += len(mine) + 1
            if len(words) > HELD:
                yield sent(words, tokens)
                words, tokens = set(), 0
        if words:
            yield sent(words, tokens)

    def distinct(rows: pd.DataFrame) -> pd.DataFrame:
        every = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["_words"]])
        return pd.DataFrame({"n": [int(rows["_tokens"].sum())], "v": [len(np.unique(every))]})

    per_part = texts.mapInArrow(read, "_part int, _words binary, _tokens long").groupBy("_part").applyInPandas(distinct, "n long, v long")
    n, v = per_part.agg(F.sum("n"), F.sum("v")).first()
    return n or 0, v or 0


def score(
    docs: DataFrame,
    training: str = "training",
    mu: float = MU,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_mb: float = 8.0,
    part_mb: float = 16.0,
) -> DataFrame:
    """log10 probabilities of all texts under the bigrams of those where ``training`` is true.

    Tokens are the lower-cased (A-Z) words and one end.  Returns the id, ``n_tokens``,
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (unigrams
    alone) and ``score`` (the automaton).

    A null or empty text is the end alone.  A null ``training`` counts as false; without
    training texts all tokens are unknown.  A null id comes back null; rows that share an
    id get a row each.  An empty table gives an empty table; other columns are not read.
    """
    narrow = docs.select(id_key(id_col).alias("_id"), column(text_col).alias("_text"), F.coalesce(column(training), F.lit(False)).alias("_on"))
    spread = dealt(narrow, "_id", "_text", block_mb, ("_on",))
    few = 2 * docs.sparkSession.sparkContext.defaultParallelism
    parts = max(few, math.ceil(1.2 * spread.text_bytes / (part_mb * 1e6)))
    total, distinct = training_size(narrow.where("_on").select(text_bytes("_text").alias("_text")), few * math.ceil(parts / few / 8))

    def in_order(block: pd.DataFrame) -> pd.DataFrame:
        return block.sort_values(["_id", "_text"], kind="stable", ignore_index=True)

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        block = in_order(block)
        arcs = Arcs(list(block["_text"]))
        order, keys, rows = arcs.order(parts)
        counts = np.concatenate(arcs.counts(block["_c0"].to_numpy(bool)))[order].astype(np.uint32)
        cuts = np.concatenate([[0], np.cumsum(rows)])
        some = np.flatnonzero(rows)
        return pd.DataFrame(
            {
                "_part": some.astype(np.int32),
                "_block": block["_block"].iat[0],
                "_keys": [keys[cuts[p] : cuts[p + 1]].tobytes() for p in some],
                "_counts": [zlib.compress(counts[cuts[p] : cuts[p + 1]].tobytes(), 1) for p in some],
            }
        )

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(x, np.uint64) for x in part["_keys"]]
        _, at = np.unique(np.concatenate(each), return_inverse=True)
        n = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint32) for x in part["_counts"]])
        sums = np.bincount(at, weights=n).astype(np.int64)[at]
        cuts = np.cumsum([0, *map(len, each)])
        packed = [zlib.compress(sums[a:b].tobytes(), 1) for a, b in zip(cuts, cuts[1:])]
        return pd.DataFrame({"_part": part["_part"], "_block": part["_block"], "_sums": packed})

    def walk(block: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        block = in_order(block)
        arcs = Arcs(list(block["_text"]))
        order, _, rows = arcs.order(parts)
        begin = np.concatenate([[0], np.cumsum(rows)])
        found = np.zeros(len(order), np.int64)
        for p, x in zip(sums["_part"], sums["_sums"]):
            found[order[begin[p] : begin[p + 1]]] = np.frombuffer(zlib.decompress(x), np.int64)
        known, base, model = arcs.scores(found[: arcs.words], found[arcs.words :], total, distinct, mu)
        return pd.DataFrame({"_id": block["_id"], "n_tokens": arcs.tokens, "n_known": known, "base_score": base, "score": model})

    asked = spread.table.groupBy("_block").applyInPandas(ask, "_part int, _block int, _keys binary, _counts binary")
    answered = asked.groupBy("_part").applyInPandas(answer, "_part int, _block int, _sums binary").repartition(spread.count, "_block")
    walked = (
        spread.table.groupBy("_block")
        .cogroup(answered.groupBy("_block"))
        .applyInPandas(walk, "_id long, n_tokens long, n_known long, base_score double, score double")
    )
    return walked.select(
        id_back("_id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    out = score(docs.select("doc_id", "text", (fold != 1).alias("training")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
