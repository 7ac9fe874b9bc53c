"""Substring dedup: repeated token windows, found by rolling hashes, become removal intervals.

Documents are dealt into blocks of consecutive ids.  Each block computes the Rabin-Karp
hash of every window with one running sum and sends the hashes, packed in reading order,
to parts chosen by a second, independent polynomial.  A part sees every occurrence of
its windows; since blocks, documents and positions are ordered, the first in line is the
earliest, and one bit per window goes back: repeats an earlier one or not.  The block
merges flagged windows into maximal intervals.

Two windows count as equal if both polynomials agree where they are looked at: 64 bits
plus the logarithm of the number of parts, which grows with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, dealt, id_back

_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class _Hashes(dict):
    """word → 64-bit hash, computed on first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _rolling(h: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash of each window of ``window`` values, modulo 2**64."""
    n = len(h)
    up = np.full(n + 1, base, np.uint64)
    up[0] = 1
    down = np.full(n + 1, pow(base, -1, 2**64), np.uint64)
    down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    return _mixed((total[window:] - total[: n + 1 - window]) * down[: n + 1 - window])


def _windows(texts: list[bytes], window: int, parts: int):
    """Word counts, window starts in part order, their hashes, rows per part."""
    known, each = _Hashes(), []
    for t in texts:
        words = t.split()
        each.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    sizes = np.fromiter(map(len, each), np.int64, len(each))
    h = np.concatenate(each)
    del known, each
    n = len(h)
    if n < window:
        return sizes, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(parts, np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)[: n + 1 - window]
    starts = np.flatnonzero(np.arange(window, n + 1) <= ends)
    part = (_rolling(_mixed(h), window, _BASE[1])[starts] >> np.uint64(24)) % np.uint64(parts)
    part = part.astype(np.uint16 if parts <= 2**16 else np.uint32)
    order = np.argsort(part, kind="stable")
    starts = starts[order]
    return sizes, starts, _rolling(h, window, _BASE[0])[starts], np.bincount(part, minlength=parts)


def _in_order(block: pd.DataFrame) -> pd.DataFrame:
    return block.sort_values(["_id", "_text"], kind="stable", ignore_index=True)


def _kept(text: bytes, gone: np.ndarray, layout: bool) -> bytes:
    if not layout:
        return b" ".join(text.split() if not gone.any() else [w for w, g in zip(text.split(), gone.tolist()) if not g])
    if not gone.any():
        return text
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begin = np.flatnonzero(~space & np.append(True, space[:-1]))
    edge = np.zeros(len(raw) + 1, np.int8)
    edge[begin[gone]] += 1
    edge[np.append(begin[1:], len(raw))[gone]] -= 1
    return raw[np.cumsum(edge[:-1], dtype=np.int8) == 0].tobytes()


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    layout: bool = False,
    carry: tuple[str, ...] = (),
    block_mb: float = 8.0,
    part_mb: float = 24.0,
) -> DataFrame:
    """Remove every word covered by a window whose words also start earlier in the corpus.

    Earlier means a smaller id, or an earlier position in the same document; windows are
    judged on the input.  Returns the id, ``n_words``, ``n_removed``, ``spans`` (maximal
    removed intervals as word ``start`` and ``length``), ``kept_text`` (the kept words
    joined by one space, or with ``layout`` the original text without the removed words
    and the white space after them) and the columns named in ``carry``.

    Null and empty texts have no words and stay empty.  A null id counts as earlier than
    every other and comes back null.  Rows that share an id are ordered by text; equal
    ones in input order, which does not change the rows returned.  An empty table gives
    an empty table.  Other columns are not read, whatever their names.
    """
    spread = dealt(docs, id_col, text_col, block_mb, carry)
    parts = max(2 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(spread.text_bytes / (part_mb * 1e6)))

    def send(block: pd.DataFrame) -> pd.DataFrame:
        block = _in_order(block)
        _, _, h, rows = _windows(list(block["_text"]), window, parts)
        cuts = np.concatenate([[0], np.cumsum(rows)])
        some = np.flatnonzero(rows)
        return pd.DataFrame(
            {"_part": some.astype(np.int32), "_block": block["_block"].iat[0], "_hashes": [h[cuts[p] : cuts[p + 1]].tobytes() for p in some]}
        )

    def look(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_block", ignore_index=True)
        each = [np.frombuffer(x, np.uint64) for x in part["_hashes"]]
        h = np.concatenate(each)
        order = np.argsort(h, kind="stable")
        again = np.zeros(len(h), bool)
        inline = h[order]
        again[order[1:]] = inline[1:] == inline[:-1]
        cuts = np.cumsum([0, *map(len, each)])
        return pd.DataFrame(
            {
                "_part": part["_part"],
                "_block": part["_block"],
                "_flags": [np.packbits(again[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])],
            }
        )

    def cut(block: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        block = _in_order(block)
        texts = list(block["_text"])
        sizes, starts, _, rows = _windows(texts, window, parts)
        again = np.zeros(len(starts), bool)
        begin = np.concatenate([[0], np.cumsum(rows)])
        for p, bits in zip(flags["_part"], flags["_flags"]):
            again[begin[p] : begin[p + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(rows[p]))
        edge = np.zeros(int(sizes.sum()) + 1, np.int32)
        edge[starts[again]] += 1
        edge[starts[again] + window] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        at = np.concatenate([[0], np.cumsum(sizes)])
        removed, spans, kept = [], [], []
        for i, text in enumerate(texts):
            mine = gone[at[i] : at[i + 1]]
            change = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            removed.append(int(mine.sum()))
            spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(change[::2], change[1::2])])
            kept.append(_kept(text, mine, layout).decode())
        out = {"_id": block["_id"], "n_words": sizes, "n_removed": removed, "spans": spans, "kept_text": kept}
        return pd.DataFrame(out | {f"_c{i}": block[f"_c{i}"] for i in range(len(carry))})

    fields = {f.name: f.dataType.simpleString() for f in spread.table.schema}
    kinds = "".join(f", _c{i} {fields[f'_c{i}']}" for i in range(len(carry)))
    sent = spread.table.groupBy("_block").applyInPandas(send, "_part int, _block int, _hashes binary")
    found = sent.groupBy("_part").applyInPandas(look, "_part int, _block int, _flags binary").repartition(spread.count, "_block")
    done = (
        spread.table.groupBy("_block")
        .cogroup(found.groupBy("_block"))
        .applyInPandas(cut, "_id long, n_words long, n_removed long, spans array<struct<start:int,length:int>>, kept_text string" + kinds)
    )
    named = [column(f"_c{i}").alias(c) for i, c in enumerate(carry)]
    return done.select(id_back("_id").alias(id_col), "n_words", "n_removed", "spans", "kept_text", *named)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP9_SQL = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (
    select doc_id, i, row_number() over (partition by k order by doc_id, i) as nth
    from (
        select doc_id, unnest(range(1, len(ws) - 18)) as i,
               unnest(list_transform(range(1, len(ws) - 18), lambda i : md5(array_to_string(ws[i:i + 19], ' ')))) as k
        from w where len(ws) >= 20
    )
),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from win where nth > 1),
each_word as (select doc_id, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as word from w),
marked as (select e.doc_id, e.p, e.word, g.p is not null as removed from each_word e left join gone g on e.doc_id = g.doc_id and e.p = g.p),
summed as (
    select doc_id, count(*) filter (where removed) as n_removed, string_agg(word, ' ' order by p) filter (where not removed) as kept
    from marked group by doc_id
)
select w.doc_id, cast(len(w.ws) as bigint) as n_words, coalesce(s.n_removed, 0) as n_removed,
       sha256(coalesce(s.kept, '')) as kept_sha256
from w left join summed s on w.doc_id = s.doc_id
"""
