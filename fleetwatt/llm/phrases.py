"""Phrase collocation mining by Rabin-Karp fingerprints.

Each task numbers the words of its texts and packs them into blocks; blocks are shuffled
once and read by three passes, which do not meet the texts again.  A block hashes every
n-gram of its pieces with a running polynomial (numpy prefix sums) and sends, packed, each
distinct fingerprint with its count and a check, 32 bits of a second polynomial, to a part.
Its block and its place in the block's list are the pointer to its occurrences.  Parts add
up counts and answer each pointer: frequent or not, and whether its block shall show the text.

First words and word pairs are counted, then triples and quadruples, but only those all
of whose pairs are frequent (a phrase is never more frequent than its parts).  A frequent
phrase is shown by the first of its pointers, with its count.  Where checks differ, phrases
share a fingerprint: then every block with it looks at the words themselves and shows what
it has, and Spark adds up by text.  So phrases are taken for one another only if 64 bits of
one polynomial, 32 of another and the part agree.

Scores, the longer phrases that contain a candidate, and the ranks are DataFrame joins
over frequent phrases.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, text_bytes
from fleetwatt.session import materialise

#: Fixed by the contract: ends of pieces, white space within pieces, length and frequency of phrases.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
LEAST = 30
SHARE = 80
SCALE = 2_000_000
TOP = 2000

#: No UTF-8 text has this byte, so it can stand for an end of a piece.
_END = b"\xff"
_TABLE = bytes.maketrans(BREAKS + b"\t", _END * len(BREAKS) + b" ")
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class _Ids(dict):
    """word → number, given on first sight."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Block:
    """Texts as word numbers, gathered in a task until they are a block."""

    def __init__(self) -> None:
        self.known, self.langs = _Ids({_END: 0}), _Ids()
        self.lang: list[int] = []
        self.walks: list[np.ndarray] = []
        self.bytes = 0

    def add(self, lang: str, text: bytes) -> None:
        words = text.lower().translate(_TABLE).replace(_END, b" \xff ").split()
        words.append(_END)
        self.walks.append(np.fromiter(map(self.known.__getitem__, words), np.uint32, len(words)))
        self.lang.append(self.langs[lang])
        self.bytes += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, self.walks), np.int64, len(self.walks))
        packed = [np.array(self.lang, np.uint32).tobytes(), sizes.tobytes(), np.concatenate(self.walks).tobytes(), b" ".join(self.known)]
        arrays = [pa.array([number], pa.int64()), pa.array([list(self.langs)], pa.list_(pa.string())), *[pa.array([x], pa.binary()) for x in packed]]
        return pa.RecordBatch.from_arrays(arrays, names=["_block", "_langs", "_lang", "_sizes", "_at", "_words"])


BLOCK = "_block long, _langs array<string>, _lang binary, _sizes binary, _at binary, _words binary"


class Grams:
    """The words of a block's texts in one line, and the fingerprints of its n-grams."""

    def __init__(self, block: pd.DataFrame, bits: int = 64):
        row = block.iloc[0]
        self.langs, self.words = list(row["_langs"]), row["_words"].split(b" ")
        self.at = np.frombuffer(row["_at"], np.uint32).astype(np.int64)
        self.lang = np.repeat(np.frombuffer(row["_lang"], np.uint32).astype(np.int64), np.frombuffer(row["_sizes"], np.int64))
        self._cut = np.uint64(64 - bits)
        word = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        seed = np.fromiter((xxhash.xxh64_intdigest(x, 1) for x in self.langs), np.uint64, len(self.langs))
        n = len(self.at)
        # prefix polynomial: total[i] = sum of h[j] * base**j over j < i, modulo 2**64
        up = np.full(n + 1, _BASE, np.uint64)
        down = np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        self._down = down
        self._total = np.zeros(n + 1, np.uint64)
        np.cumsum(word[self.at] * up[:n], out=self._total[1:])
        self._other = np.zeros(n + 1, np.uint64)
        np.cumsum(_mixed(word)[self.at] * up[:n], out=self._other[1:])
        self._seed = seed
        # words left until the end of the piece, this one included
        stop = np.flatnonzero(self.at == 0)
        self.left = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(n)

    def starts(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.left >= n)

    def prints(self, n: int, starts: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams that start there, different for each language."""
        h = (self._total[starts + n] - self._total[starts]) * self._down[starts]
        return _mixed(h + self._seed[self.lang[starts]] * np.uint64(2 * n + 1)) >> self._cut

    def checks(self, n: int, starts: np.ndarray) -> np.ndarray:
        """Another 32 bits, never 0."""
        h = (self._other[starts + n] - self._other[starts]) * self._down[starts]
        return (_mixed(h ^ self._seed[self.lang[starts]]) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def distinct(self, n: int, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Sorted distinct fingerprints, their checks (0 where these differ), counts, and starts of first occurrences."""
        keys, first, at, counts = np.unique(self.prints(n, starts), return_index=True, return_inverse=True, return_counts=True)
        each = self.checks(n, starts)
        checks = each[first]
        checks[at[each != checks[at]]] = 0
        return keys, checks, counts, starts[first]

    def vocabulary(self) -> tuple[np.ndarray, np.ndarray]:
        """A start of each (language, word), and its count."""
        starts = self.starts(1)
        first, counts = np.unique(self.lang[starts] * len(self.words) + self.at[starts], return_index=True, return_counts=True)[1:]
        return starts[first], counts

    def frequent(self, n: int, starts: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The starts whose fingerprint is among the sorted ``prints``."""
        if not len(prints):
            return starts[:0]
        mine = self.prints(n, starts)
        found = np.minimum(np.searchsorted(prints, mine), len(prints) - 1)
        return starts[prints[found] == mine]

    def longer(self, n: int, pairs: np.ndarray) -> np.ndarray:
        """Starts of the n-grams all of whose pairs start at ``pairs``."""
        on = np.zeros(len(self.at) + LONGEST, bool)
        on[pairs] = True
        starts = self.starts(n)
        for k in range(n - 1):
            starts = starts[on[starts + k]]
        return starts

    def named(self, n: int, starts: np.ndarray) -> tuple[list[str], list[str]]:
        """Language and text of the n-grams that start there."""
        words = [list(map(self.words.__getitem__, self.at[starts + k].tolist())) for k in range(n)]
        return [self.langs[i] for i in self.lang[starts].tolist()], [b" ".join(x).decode() for x in zip(*words)]

    def by_words(self, n: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A start of each distinct n-gram there, told apart by language and words, and its count."""
        rows = np.stack([self.lang[starts], *(self.at[starts + k] for k in range(n))], axis=1)
        order = np.lexsort(rows.T[::-1])
        rows = rows[order]
        begin = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1))) if len(rows) else order
        return starts[order][begin], np.diff(np.append(begin, len(rows)))


def _by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by part, and where each part begins in it."""
    order = np.argsort(part.astype(np.uint16) if parts <= 2**16 else part, kind="stable")
    return order, np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _packed(parts: int, keys: np.ndarray, checks: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """Part, keys, checks and counts for each part that has some."""
    order, cuts = _by_part(_part(keys, parts), parts)
    keys, checks, counts = keys[order], checks[order], counts[order].astype(np.uint32)
    for p in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[p], cuts[p + 1]
        yield int(p), keys[a:b].tobytes(), checks[a:b].tobytes(), zlib.compress(counts[a:b].tobytes(), 1)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(keys) % np.uint64(parts)).astype(np.int64)


def _answered(answers: pd.DataFrame, n: int, keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the keys that a block sent: whether frequent, whether to show, and the count to show (0: the block's own)."""
    order, cuts = _by_part(_part(keys, parts), parts)
    often, show, sums = np.zeros(len(keys), bool), np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    mine = answers[answers["_n"] == n]
    for p, bits, shown, total in zip(mine["_part"], mine["_often"], mine["_show"], mine["_sums"]):
        at = order[cuts[p] : cuts[p + 1]]
        often[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
        show[at] = np.unpackbits(np.frombuffer(shown, np.uint8), count=len(at)).astype(bool)
        sums[at[show[at]]] = np.frombuffer(total, np.int64)
    return often, show, sums


def phrase_counts(
    docs: DataFrame,
    least: int = LEAST,
    text_col: str = "text",
    lang_col: str = "lang",
    block_mb: float = 8.0,
    part_mb: float = 16.0,
    bits: int = 64,
) -> DataFrame:
    """``lang, n_gram, phrase, f``: exact counts of the words and phrases found ``least`` times or more.

    The row with ``n_gram`` 0 of each language has all its word occurrences in ``f``.

    Null texts are empty, rows without a language count as ``und``, repeated rows count
    each, whatever their ids (which may be null).  Texts without words add nothing.  An
    empty table gives an empty table; other columns are not read.  Fingerprints of fewer
    ``bits`` give the same counts with more to verify.  The rows of each partition must
    come in the same order if it is read again, as those of files do.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("_lang"), text_bytes(text_col).alias("_text"))
    total = narrow.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    few = 2 * spark.sparkContext.defaultParallelism
    blocks, parts = max(few, math.ceil(total / (block_mb * 1e6))), max(few, math.ceil(total / (part_mb * 1e6)))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, Block()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                block.add(lang, text)
                if block.bytes >= block_mb * 1e6:
                    yield block.row(number)
                    number, block = number + 1, Block()
        if block.walks:
            yield block.row(number)

    dealt = narrow.mapInArrow(gather, BLOCK).repartition(blocks, "_block")

    def sent(block: int, n: int, keys: np.ndarray, checks: np.ndarray, counts: np.ndarray) -> list[tuple]:
        return [(p, block, n, *packed) for p, *packed in _packed(parts, keys, checks, counts)]

    def table(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["_part", "_block", "_n", "_keys", "_checks", "_counts"])
        return out.astype({"_part": "int32", "_block": "int64", "_n": "int32"})

    def short(block: pd.DataFrame) -> pd.DataFrame:
        grams, b = Grams(block, bits), int(block["_block"].iat[0])
        starts, counts = grams.vocabulary()
        rows = sent(b, 1, grams.prints(1, starts), grams.checks(1, starts), counts)
        return table(rows + sent(b, 2, *grams.distinct(2, grams.starts(2))[:3]))

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(x, np.uint64) for x in part["_keys"]]
        checks = np.concatenate([np.frombuffer(x, np.uint32) for x in part["_checks"]])
        counts = np.concatenate([np.frombuffer(zlib.decompress(x), np.uint32) for x in part["_counts"]])
        cuts = np.cumsum([0, *map(len, each)])
        keys, first, at = np.unique(np.concatenate(each), return_index=True, return_inverse=True)
        total = np.bincount(at, weights=counts).astype(np.int64)
        often = (total >= least)[at]
        clash = np.zeros(len(keys), bool)
        clash[at[(checks != checks[first][at]) | (checks == 0)]] = True
        show = clash[at]
        show[first] = True
        show &= often
        sums = np.where(clash, 0, total)[at]
        spans = list(zip(cuts, cuts[1:]))
        return pd.DataFrame(
            {
                "_part": part["_part"],
                "_block": part["_block"],
                "_n": part["_n"],
                "_often": [np.packbits(often[a:b]).tobytes() for a, b in spans],
                "_show": [np.packbits(show[a:b]).tobytes() for a, b in spans],
                "_sums": [sums[a:b][show[a:b]].tobytes() for a, b in spans],
            }
        )

    def extend(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams, b = Grams(block, bits), int(block["_block"].iat[0])
        starts, rows = grams.starts(2), []
        keys = np.unique(grams.prints(2, starts))
        pairs = grams.frequent(2, starts, keys[_answered(answers, 2, keys, parts)[0]])
        for n in range(3, LONGEST + 1):
            rows += sent(b, n, *grams.distinct(n, grams.longer(n, pairs))[:3])
        return table(rows)

    def frame(n: int, langs: list[str], texts: list[str], counts) -> pd.DataFrame:
        return pd.DataFrame({"lang": langs, "n_gram": n, "phrase": texts, "f": counts})

    def look(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams, rows = Grams(block, bits), []
        words = np.bincount(grams.lang, weights=grams.at > 0, minlength=len(grams.langs))
        rows.append(frame(0, grams.langs, [""] * len(words), words.astype(np.int64)))
        starts, counts = grams.vocabulary()
        _, show, sums = _answered(answers, 1, grams.prints(1, starts), parts)
        rows.append(frame(1, *grams.named(1, starts[show]), np.where(sums > 0, sums, counts)[show]))
        pairs = starts[:0]
        for n in range(2, LONGEST + 1):
            starts = grams.starts(2) if n == 2 else grams.longer(n, pairs)
            keys, _, _, pointer = grams.distinct(n, starts)
            often, show, sums = _answered(answers, n, keys, parts)
            if n == 2:
                pairs = grams.frequent(2, starts, keys[often])
            clear = show & (sums > 0)
            rows.append(frame(n, *grams.named(n, pointer[clear]), sums[clear]))
            if (clash := show & ~clear).any():
                pointer, counts = grams.by_words(n, grams.frequent(n, starts, keys[clash]))
                rows.append(frame(n, *grams.named(n, pointer), counts))
        return pd.concat(rows).astype({"n_gram": "int32", "f": "int64"})

    message = "_part int, _block long, _n int, _keys binary, _checks binary, _counts binary"

    def asked(rows: DataFrame) -> DataFrame:
        return rows.repartition(parts, "_part").groupBy("_part").applyInPandas(answer, "_part int, _block long, _n int, _often binary, _show binary, _sums binary")

    def beside(answers: DataFrame, step, schema: str) -> DataFrame:
        return dealt.groupBy("_block").cogroup(answers.groupBy("_block")).applyInPandas(step, schema)

    first = asked(dealt.groupBy("_block").applyInPandas(short, message)).repartition(blocks, "_block")
    second = asked(beside(first, extend, message))
    found = beside(first.unionByName(second), look, "lang string, n_gram int, phrase string, f long")
    counted = found.groupBy("lang", "n_gram", "phrase").agg(F.sum("f").alias("f"))
    return counted.where((F.col("f") >= least) | ((F.col("n_gram") == 0) & (F.col("f") > 0)))


def _words(a: int, size: Column | int) -> Column:
    return F.concat_ws(" ", F.slice("_words", a, size))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    share: int = SHARE,
    scale: int = SCALE,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of two to four words of each language by association.

    A phrase found a times is cut after each of its words into parts found l and r times;
    it scores floor(scale * a / (l + r)) at its lowest cut, the first one on ties.  It is
    left out if a longer candidate that contains its words is found in at least ``share``
    percent of its occurrences.  Returns ``lang, rank, phrase, a, l, r, n, score``; ties in
    score go to the larger a, then to the smaller phrase in UTF-8 byte order.

    Nulls, empty and repeated rows: as in ``phrase_counts``.  A language without phrases
    has no rows.
    """
    counts = materialise(phrase_counts(docs, least, text_col, lang_col), "phrase-counts")
    grams = counts.where(F.col("n_gram") > 0)
    phrases = grams.where(F.col("n_gram") > 1).select("lang", "phrase", "n_gram", F.col("f").alias("a"), F.split("phrase", " ").alias("_words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("n_gram") - 1)).alias("_k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "_k", _words(1, F.col("_k")).alias("_first"), F.concat_ws(" ", F.slice("_words", F.col("_k") + 1, F.col("n_gram"))).alias("_rest")
    )
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l")), ["lang", "_first"])
    cuts = cuts.join(grams.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r")), ["lang", "_rest"])
    wide = "decimal(38,0)"
    cuts = cuts.withColumn("score", F.expr(f"cast(cast({scale} as {wide}) * cast(a as decimal(19,0)) as {wide}) div cast(cast(l as {wide}) + r as {wide})"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "_k", "l", "r")).alias("_low")).select("lang", "phrase", "a", "_low.*")

    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n_gram") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("n_gram") - m + 1), lambda i: F.concat_ws(" ", F.slice("_words", i, m))),
        )
    )
    within = phrases.where(F.col("n_gram") > 2).select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("_longer"))
    within = within.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = scored.join(within, ["lang", "phrase"], "left")
    kept = kept.where(F.col("_longer").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("_longer") < F.lit(share).cast("decimal(3,0)") * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    all_words = counts.where(F.col("n_gram") == 0).select("lang", F.col("f").alias("n"))
    named = best.join(all_words, "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
total as (select lang, cast(sum(len(ws)) as bigint) as n from w group by lang having sum(len(ws)) > 0),
grams as (
    select lang, m, array_to_string(ws[i:i + m - 1], ' ') as phrase, count(*) as f
    from (select lang, ws, unnest([1, 2, 3, 4]) as m from w), unnest(range(1, len(ws) - m + 2)) as t(i)
    group by all having count(*) >= 30
),
cand as (select lang, m, phrase, f as a, string_split(phrase, ' ') as ps from grams where m > 1),
cuts as (
    select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, (2000000::hugeint * c.a) // (l.f::hugeint + r.f) as score
    from cand c, unnest(range(1, c.m)) as t(k), grams l, grams r
    where l.lang = c.lang and l.phrase = array_to_string(ps[1:k], ' ') and r.lang = c.lang and r.phrase = array_to_string(ps[k + 1:], ' ')
),
low as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select c.lang, array_to_string(ps[i:i + m2 - 1], ' ') as phrase, max(c.a) as longer
    from (select *, unnest(range(2, m)) as m2 from cand) c, unnest(range(1, c.m - m2 + 2)) as t(i) group by all
),
kept as (
    select x.* from low x left join inside i on x.lang = i.lang and x.phrase = i.phrase where i.longer is null or 100::hugeint * i.longer < 80::hugeint * x.a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, t.n, cast(score as bigint) as score
from kept k join total t on k.lang = t.lang qualify rank <= 2000
"""
