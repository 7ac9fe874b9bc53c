"""Quality rules: line frequency across the documents of a host, beside per-document counts.

Each document is read once: its counts, and the hash and words of every distinct
normalised line (lower-cased A-Z, words joined by one space).  Per host Spark counts the
distinct documents of each line; exact copies of a text count once, so a copied document
is not taken for boilerplate.  A line above the limit goes, and a document that loses
more than half of its words that way is depleted and rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key, settled, text_bytes

SYMBOLS = b"#*$%&|<>"
#: A line is above the limit in more than so many distinct documents of a host ...
MIN_DOCS = 10
#: ... and in more than this share of the host's distinct documents.
MAX_SHARE = 0.001
#: A document is depleted if less than this share of its words is left.
MIN_LEFT = 0.5

_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows that occur twice or more in one text."""
    n = len(words)
    if n <= window:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    key = x[: n + 1 - window]
    for k in range(1, window):
        key = key * len(ids) + x[k : n + 1 - window + k]
        if len(ids) ** (k + 2) > 2**62 and k + 1 < window:
            key = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    same = np.diff(key[order]) == 0
    twice = order[np.append(same, False) | np.append(False, same)]
    edge = np.zeros(n + 1, np.int64)
    edge[twice] += 1
    edge[twice + window] -= 1
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _line_hash(norm: bytes) -> int:
    h = xxhash.xxh64_intdigest(norm)
    return h - (h >> 63 << 64)


def _measured(text: bytes) -> tuple:
    words = text.split()
    with_word = [x for x in text.split(b"\n") if x and not x.isspace()]
    lines: dict[int, int] = {}
    for x in with_word:
        norm = _line(x)
        h = _line_hash(norm)
        lines[h] = lines.get(h, 0) + norm.count(b" ") + 1
    blank = len(text) - sum(map(len, words))
    counts = (
        len(words),
        len(text.decode()) - blank,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(with_word) - len(set(with_word)),
        repeated_words(words),
    )
    return counts, lines


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        each = [_measured(t) for t in b.column(3).to_pylist()]
        counts = [pa.array([c[i] for c, _ in each], pa.int64()) for i in range(5)]
        hashes = pa.array([list(x) for _, x in each], pa.list_(pa.int64()))
        words = pa.array([list(x.values()) for _, x in each], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), *counts, hashes, words],
            names=["_id", "_host", "_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_lines", "_line_words"],
        )


def _text_hash(name: str) -> Column:
    return F.xxhash64(F.coalesce(column(name), F.lit("")))


def _host_hash(name: str) -> Column:
    return F.xxhash64(F.coalesce(column(name).cast("string"), F.lit("")), column(name).isNull())


def verdicts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """Counts and the verdict for every row of ``docs``.

    Returns the id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed`` (under 50 words, or more than half of them in
    repeated 3-word windows), ``kept``, ``n_removed_words``, and for the filter ``_host``,
    ``_text`` and ``_removed`` (hashes of host, text and its lines above the limit).

    A null text has no words and fails.  Rows with a null host form a host of their own.
    Null ids come back null; rows that share an id get a row each.  A document without
    words is not kept.  An empty table gives an empty table; other columns are not read.
    """
    narrow = docs.select(
        id_key(id_col).alias("_id"), _host_hash(host_col).alias("_host"), _text_hash(text_col).alias("_text"), text_bytes(text_col).alias("_bytes")
    )
    schema = f"_id long, _host long, _text long, {_COUNTS}, _lines array<long>, _line_words array<long>"
    read = settled(narrow.mapInArrow(_read, schema).withColumn("_row", F.monotonically_increasing_id()))
    lines = read.select("_row", "_host", "_text", F.explode(F.arrays_zip("_lines", "_line_words")).alias("_x"))
    lines = lines.select("_row", "_host", "_text", F.col("_x._lines").alias("_line"), F.col("_x._line_words").alias("_words"))
    hosts = read.select("_host", "_text").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"))
    often = lines.select("_host", "_line", "_text").distinct().groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_in"))
    often = often.where(F.col("_in") > min_docs).join(hosts, "_host").where(F.col("_in") > max_share * F.col("_docs"))
    lost = lines.join(often.select("_host", "_line"), ["_host", "_line"]).groupBy("_row")
    lost = lost.agg(F.sum("_words").alias("_lost"), F.collect_list("_line").alias("_gone"))
    out = read.drop("_lines", "_line_words").join(lost, "_row", "left").withColumn("_lost", F.coalesce("_lost", F.lit(0)))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("_lost")
    return out.select(
        id_back("_id").alias(id_col),
        *[c.split()[0] for c in _COUNTS.split(", ")],
        failed.alias("base_failed"),
        (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
        F.col("_lost").alias("n_removed_words"),
        "_host",
        "_text",
        F.coalesce("_gone", F.array().cast("array<long>")).alias("_removed"),
    )


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, gone in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if gone:
                drop = set(gone)
                text = "\n".join(x for x in text.split("\n") if _line_hash(_line(x.encode())) not in drop)
            out.append(text)
        rest = list(range(2, b.num_columns))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out, pa.string()), *[b.column(i) for i in rest]], names=["_new", *[b.schema.field(i).name for i in rest]]
        )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **rules) -> DataFrame:
    """The documents that pass, same columns, their text without the lines above the limit.

    Rows that share id, text and host have one verdict; the same id and text under another
    host has its own.
    """
    match = ["_id", "_host", "_text"]
    judged = verdicts(docs, id_col, text_col, host_col, **rules).where("kept")
    judged = judged.select(id_key(id_col).alias("_id"), "_host", "_text", "_removed").dropDuplicates(match)
    names = docs.columns
    keys = [id_key(id_col).alias("_id"), _host_hash(host_col).alias("_host"), _text_hash(text_col).alias("_text")]
    inner = docs.select(*keys, *[column(c).alias(f"_c{i}") for i, c in enumerate(names)])
    joined = inner.join(judged, match).drop(*match)
    body = f"_c{names.index(text_col)}"
    order = [body, "_removed", *[c for c in joined.columns if c not in (body, "_removed")]]
    kinds = {f.name: f.dataType.simpleString() for f in joined.schema}
    cleaned = joined.select(*order).mapInArrow(_without, "_new string, " + ", ".join(f"{c} {kinds[c]}" for c in order[2:]))
    return cleaned.select(*[column("_new" if c == text_col else f"_c{i}").alias(c) for i, c in enumerate(names)])


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return verdicts(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("_host", "_text", "_removed")


OP8_SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
tri as (
    select doc_id, unnest(range(1, len(ws) - 1)) as i,
           unnest(list_transform(range(1, len(ws) - 1), lambda i : array_to_string(ws[i:i + 2], ' '))) as k
    from d where len(ws) >= 3
),
rep as (select doc_id, i from (select *, count(*) over (partition by doc_id, k) as n from tri) where n > 1),
repeated as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest(range(i, i + 3)) as p from rep) group by doc_id),
raw as (select doc_id, source, md5(text) as t, unnest(string_split(text, chr(10))) as line from d),
lines as (
    select doc_id, source, t, line, regexp_extract_all(
        translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as lw
    from raw where regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from lines group by doc_id),
norm as (select doc_id, source, t, array_to_string(lw, ' ') as line, sum(len(lw)) as words from lines group by all),
hosts as (select source, count(distinct t) as docs from (select source, md5(text) as t from d) group by source),
often as (
    select n.source, n.line from norm n join hosts h on n.source is not distinct from h.source
    group by n.source, n.line, h.docs having count(distinct n.t) > 10 and count(distinct n.t) > 0.001 * h.docs
),
lost as (
    select n.doc_id, sum(n.words) as words from norm n join often o on n.source is not distinct from o.source and n.line = o.line group by n.doc_id
),
m as (
    select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(list_sum(list_transform(ws, lambda w : length(w))), 0) as bigint) as word_chars,
           cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
           coalesce(u.n_dup_lines, 0) as n_dup_lines, coalesce(r.n_repeat_words, 0) as n_repeat_words,
           cast(coalesce(l.words, 0) as bigint) as n_removed_words
    from d left join dup u on d.doc_id = u.doc_id left join repeated r on d.doc_id = r.doc_id left join lost l on d.doc_id = l.doc_id
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 2 * (n_words - n_removed_words) >= n_words as kept
from m
"""
