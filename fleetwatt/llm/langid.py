"""Language ID in two levels: the family first, then the language within it.

A text's features are the shares of its hashed byte trigrams (lower-cased, whole text).
Linear support vector machines, one versus one, separate the families, and within each
family the languages.  They are fitted on a bounded sample of labelled documents, one
machine per task, and their weights (256 KB each) are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key

DIMS = 1 << 16
#: Labelled documents of each language that the fit sees at most.
SAMPLE = 1500
UNDETERMINED = "und"

#: ISO 639-1 codes by branch.  A language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "finnic": "fi et",
    "indo-aryan": "hi ur bn pa mr gu ne",
    "turkic": "tr az kk uz ky",
}
_LETTER = regex.compile(r"\p{L}")
_FAMILY = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], f"only {lang}")


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text between two spaces, in reading order."""
    a = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    code = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)


def _shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(trigrams(text), return_counts=True)
    return at, (20.0 * n / n.sum()).astype(np.float64)


def fit_svm(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, c: float = 10.0, rounds: int = 15) -> np.ndarray:
    """Weights and, last, the bias of a linear machine with hinge loss, by dual coordinate descent."""
    w, alpha, order = np.zeros(DIMS + 1), np.zeros(len(y)), np.random.default_rng(7)
    # a class with few documents weighs as much as one with many
    limit = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    square = np.array([x @ x + 1 for _, x in rows])
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            at, x = rows[i]
            new = min(max(alpha[i] - (y[i] * (w[at] @ x + w[-1]) - 1) / square[i], 0.0), limit[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * x
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def machines(langs: list[str]) -> list[tuple[str, str, list[str], list[str]]]:
    """Level ("" or a family), the two sides' names, and the languages of each side."""
    by: dict[str, list[str]] = {}
    for lang in sorted(langs):
        by.setdefault(family(lang), []).append(lang)
    out = [("", a, b) for a, b in combinations(sorted(by), 2)]
    sides = [(level, f"{a}|{b}", by[a], by[b]) for level, a, b in out]
    for name, own in sorted(by.items()):
        sides += [(name, f"{a}|{b}", [a], [b]) for a, b in combinations(own, 2)]
    return sides


class Model:
    """The learned languages and the weights of every machine, predicting whole texts."""

    def __init__(self, langs: list[str], weights: dict[tuple[str, str], np.ndarray]):
        self.langs = sorted(langs)
        self.families: dict[str, list[str]] = {}
        for lang in self.langs:
            self.families.setdefault(family(lang), []).append(lang)
        self.keys = sorted(weights)
        table = np.array([weights[k] for k in self.keys], np.float32).reshape(len(self.keys), DIMS + 1)
        self.table, self.bias = np.ascontiguousarray(table[:, :DIMS].T), table[:, DIMS]

    def _shares(self, level: str, names: list[str], margin: np.ndarray) -> dict[str, float]:
        """For each name the mean of its pairwise probabilities, scaled to sum to one."""
        if len(names) == 1:
            return {names[0]: 1.0}
        got = dict.fromkeys(names, 0.0)
        for a, b in combinations(sorted(names), 2):
            p = 1.0 / (1.0 + np.exp(-np.clip(2.0 * margin[self.keys.index((level, f"{a}|{b}"))], -50, 50)))
            got[a] += p
            got[b] += 1.0 - p
        total = sum(got.values())
        return {k: float(v / total) for k, v in got.items()}

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        at = trigrams(text)
        total = np.zeros(len(self.keys))
        for lo in range(0, len(at), 1 << 18):
            total += self.table[at[lo : lo + (1 << 18)]].sum(axis=0, dtype=np.float64)
        margin = 20.0 * total / len(at) + self.bias
        kin = self._shares("", sorted(self.families), margin)
        best = max(sorted(kin), key=kin.get)
        own = self._shares(best, self.families[best], margin)
        lang = max(sorted(own), key=own.get)
        return lang, kin[best] * own[lang]


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Machines from the columns ``_id, _text, _lang``: at most ``sample`` documents of a
    language, those with the smallest hash of their id and text, so the fit has a fixed size.

    Every language with a labelled text that holds a letter is learned, from one document on.  Rows that share id and
    language are a document for each of their texts; equal rows count once.
    """
    labelled = labelled.where(F.col("_text").rlike(r"\p{L}")).withColumn("_hash", F.xxhash64("_text", F.lit(7)))
    counts = {r[0]: r[1] for r in labelled.groupBy("_lang").agg(F.count(F.lit(1))).collect()}
    # hashes below a bound that about twice the sample has; only those are ranked
    drawing = F.xxhash64("_id", "_hash", F.lit(11))
    chance = drawing.cast("double") / F.lit(2.0**64) + 0.5
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("_lang") == lang, F.lit(min(1.0, (2 * sample + 100) / n))).otherwise(share)
    nth = Window.partitionBy("_lang").orderBy(drawing, "_id", "_hash")
    drawn = labelled.select("_id", "_lang", "_hash").where(chance <= share).distinct()
    drawn = drawn.withColumn("_nth", F.row_number().over(nth)).where(F.col("_nth") <= sample)
    langs = list(counts)
    wanted = machines(langs)
    if not wanted:
        return Model(langs, {})
    keys = ["_id", "_lang", "_hash"]
    seen = labelled.join(F.broadcast(drawn.select(*keys)), keys).groupBy(*keys).agg(F.first("_text").alias("_text"))
    sides: dict[str, list[tuple[str, str, int]]] = {}
    for level, name, left, right in wanted:
        for lang in left:
            sides.setdefault(lang, []).append((level, name, 1))
        for lang in right:
            sides.setdefault(lang, []).append((level, name, -1))

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, lang, text in zip(b["_id"], b["_lang"], b["_text"]):
                if lang in sides:
                    at, x = _shares(text)
                    out += [(level, name, side, key, at.tobytes(), x.tobytes()) for level, name, side in sides[lang]]
            yield pd.DataFrame(out, columns=["_level", "_name", "_side", "_id", "_at", "_x"])

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_id", "_at"], ignore_index=True)
        x = [(np.frombuffer(a, np.uint16), np.frombuffer(b, np.float64)) for a, b in zip(rows["_at"], rows["_x"])]
        w = fit_svm(x, rows["_side"].to_numpy(np.float64))
        return pd.DataFrame({"_level": [rows["_level"].iat[0]], "_name": [rows["_name"].iat[0]], "_w": [w.astype(np.float32).tobytes()]})

    sent = seen.select("_id", "_lang", "_text").mapInPandas(send, "_level string, _name string, _side int, _id long, _at binary, _x binary")
    got = sent.groupBy("_level", "_name").applyInPandas(learn, "_level string, _name string, _w binary").collect()
    return Model(langs, {(r[0], r[1]): np.frombuffer(r[2], np.float32) for r in got})


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred`` and ``score`` (0 to 1: the family's share times the language's).

    A null text, one without a letter, or a model without languages gives ``und`` and 0.
    A null id comes back null; rows that share an id get a row each; an empty table gives
    an empty table.  Only the id and the whole text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shared.value.predict(t) for t in b.column(1).to_pylist()]
            lang, score = pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), lang, score], names=["_id", "lang_pred", "score"])

    source = docs.select(id_key(id_col).alias("_id"), column(text_col).alias("_text"))
    return source.mapInArrow(run, "_id long, lang_pred string, score double").select(id_back("_id").alias(id_col), "lang_pred", "score")


def fold(name: str) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(column(name).cast("string"))


def op3_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id") % 5 != 0))
    model = fit(learned.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang")))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id") % 5 == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
