"""Line dedup by a deletion-neighbourhood join.

A line is its words, lower-cased (A-Z) and joined by one space; every line with a word is
judged.  Two lines of eight words or more are near if one word substituted, inserted or
deleted turns one into the other.  Shorter lines, and with them lines of scripts without
spaces, are near if that holds of one character and both have 16 characters or more;
shorter still, they must be equal.  Below, the units of a line are its words or its
characters.  Each candidate line emits itself and its variants with one unit deleted as
hashed keys.  Lines with equal keys are compared by
what they deleted: the same position, or nothing on one side, is one edit.  Only the
earliest line of a key and position matters, so equal keys meet in minimums, not in
pairs; then the texts of a line and the one it would repeat are compared unit by unit.

Candidates are lines that can have a near line at all: one edit leaves one half of the
longer line whole, so only lines that share a half (the first or the last units, for
their own length or one more) with another line emit variants, and only with deletions in
the half that is not shared.

Documents are dealt into blocks of consecutive ids.  A block sends each distinct line,
half or variant once, packed, to parts chosen by bits that the 64-bit keys lack; parts
answer every block in the order it asked.  Blocks and lines are ordered, so the first in
line is the earliest.  What a pass found out about its own block travels to the next as
a note, so halves are hashed once.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, dealt, id_back

#: Shorter lines are left alone; 1 judges every line with a word.
MIN_WORDS = 1
#: From here on one word may differ.
NEAR_WORDS = 8
#: In lines of fewer words one character may differ, from this many characters on.
NEAR_CHARS = 16

_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LOW = 2**64 - 1
_MESSAGE = "_part int, _block int, _a binary, _b binary, _c binary, _d binary"
_NAMES = ["_part", "_block", "_a", "_b", "_c", "_d"]


def _key(data: bytes) -> tuple[int, int]:
    """A 64-bit key and 64 more bits for the part."""
    h = xxhash.xxh3_128_intdigest(data)
    return h & _LOW, h >> 64


def units(line: str, near_words: int, near_chars: int) -> tuple[bool, list[str]]:
    """Whether the units of a line are words, and the units; none if it has no near lines."""
    words = line.split(" ")
    if len(words) >= near_words:
        return True, words
    return False, list(line) if len(line) >= near_chars else []


def halves(own: list[str], by_word: bool) -> list[bytes]:
    """What a line shares with lines one edit away: first and last units, for its own length and for one more."""
    n, out = len(own), []
    mark, gap = ("w", " ") if by_word else ("c", "")
    for longer in (n, n + 1):
        first = (longer - 1) // 2
        out.append(f"{mark}{longer}<{gap.join(own[:first])}".encode())
        out.append(f"{mark}{longer}>{gap.join(own[n - (longer - 1 - first) :])}".encode())
    return out


def variants(own: list[str], by_word: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys, row 0 of the whole line and row i + 1 without unit i, in linear time."""
    n = len(own)
    out = []
    for seed, base in enumerate(_BASE):
        seed += 0 if by_word else len(_BASE)  # a word never counts as a character
        h = np.fromiter((xxhash.xxh64_intdigest(w.encode(), seed) for w in own), np.uint64, n)
        up = np.full(n, base, np.uint64)
        up[0] = 1
        total = np.concatenate([[np.uint64(0)], np.cumsum(h * np.cumprod(up))])
        shorter = total[:-1] + (total[-1] - total[1:]) * np.uint64(pow(base, -1, 2**64))
        out.append(np.concatenate([total[-1:], shorter]))
    return out[0], out[1]


def within_one(a: list[str], b: list[str]) -> bool:
    """At most one unit inserted, deleted or substituted."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i + (len(short) == len(long)) :] == long[i + 1 :]


def _zip(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _unzip(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(x), kind)


class Asked:
    """Keys of one kind in the order they are sent: by part, then in the order given."""

    def __init__(self, keys: np.ndarray, other: np.ndarray, parts: int, offset: int):
        part = ((other >> np.uint64(20)) % np.uint64(parts)).astype(np.uint32)
        self.order = np.argsort(part, kind="stable")
        self.keys, self.offset = keys[self.order], offset
        self.cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])

    def sent(self, block: int, *more: np.ndarray) -> pd.DataFrame:
        some = np.flatnonzero(np.diff(self.cuts))
        at = [slice(self.cuts[p], self.cuts[p + 1]) for p in some]
        cols = {"_part": (some + self.offset).astype(np.int32), "_block": block, "_a": [self.keys[x].tobytes() for x in at]}
        for name, values in zip("bcd", more):
            values = values[self.order]
            cols[f"_{name}"] = [_zip(values[x]) for x in at]
        return pd.DataFrame(cols).reindex(columns=_NAMES)

    def bits(self, answers: pd.DataFrame) -> Iterator[tuple[np.ndarray, pd.Series]]:
        """Of each answered part: the keys (as given) whose bit is set, and the answer."""
        mine = answers[(answers["_part"] >= self.offset) & (answers["_part"] < self.offset + len(self.cuts) - 1)]
        for row in mine.itertuples(index=False):
            a, b = self.cuts[row[0] - self.offset], self.cuts[row[0] - self.offset + 1]
            yield self.order[a:b][np.unpackbits(np.frombuffer(row[2], np.uint8), count=b - a).astype(bool)], row


class Lines:
    """The lines of a block in order, and what each pass asks of the parts."""

    def __init__(self, block: pd.DataFrame, parts: int, min_words: int, near_words: int, near_chars: int):
        self.parts, self.near_words, self.near_chars = parts, near_words, near_chars
        self.number = int(block["_block"].iat[0])
        ids = block["_id"].to_numpy(np.int64)
        nth = block.groupby("_id").cumcount().to_numpy(np.int64)  # rows that share an id
        doc, no, n, self.words = [], [], [], []
        for d, text in enumerate(block["_text"]):
            for i, line in enumerate(text.split(b"\n")):
                words = line.lower().split()
                if len(words) >= min_words and words:
                    doc.append(d)
                    no.append(i)
                    n.append(len(words))
                    self.words.append(b" ".join(words))
        self.doc, self.no, self.n = np.array(doc, np.int64), np.array(no, np.int64), np.array(n, np.int64)
        self.id, self.sub = ids[self.doc], nth[self.doc] << 32 | self.no

    @cached_property
    def same(self) -> np.ndarray:
        """For each line the first of the block that equals it."""
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, i) for i, w in enumerate(self.words)), np.int64, len(self.words))

    @cached_property
    def firsts(self) -> np.ndarray:
        return np.flatnonzero(self.same == np.arange(len(self.words)))

    @cached_property
    def _keys(self) -> np.ndarray:
        return np.array([_key(self.words[i]) for i in self.firsts], np.uint64).reshape(-1, 2)

    @cached_property
    def exact(self) -> Asked:
        return Asked(self._keys[:, 0], self._keys[:, 1], self.parts, 0)

    def _units(self, i: int) -> tuple[bool, list[str]]:
        return units(self.words[i].decode(), self.near_words, self.near_chars)

    def _note(self, at: int, found: np.ndarray) -> pd.DataFrame:
        """Numbers for the block itself; every note has a part of its own."""
        return pd.DataFrame({"_part": [3 * self.parts + 2 * self.number + at], "_block": self.number, "_b": [_zip(found)]}).reindex(columns=_NAMES)

    def _noted(self, answers: pd.DataFrame, at: int) -> np.ndarray:
        mine = answers[answers["_part"] == 3 * self.parts + 2 * self.number + at]
        return _unzip(mine["_b"].iat[0], np.int64)

    def send_halves(self) -> list[pd.DataFrame]:
        """Each distinct half once, with its line's key, or 0 if the block has two lines with it, and
        4 times the line plus its number among the line's halves; a note holds those that the block shares."""
        keys, other, line, slot = [], [], [], []
        for i, own in zip(self.firsts.tolist(), self._keys[:, 0].tolist()):
            by_word, mine = self._units(i)
            for h, half in enumerate(halves(mine, by_word) if mine else ()):
                key, more = _key(half)
                keys.append(key)
                other.append(more)
                line.append(own)
                slot.append(4 * i + h)
        keys, other, line, slot = (np.array(x, k) for x, k in zip((keys, other, line, slot), (np.uint64, np.uint64, np.uint64, np.int64)))
        _, at, half, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        at, lone = np.sort(at), times[half] == 1  # in the order of their lines
        asked = Asked(keys[at], other[at], self.parts, self.parts)
        return [asked.sent(self.number, np.where(lone, line, np.uint64(0))[at], slot[at]), self._note(0, slot[~lone])]

    def earliest(self, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """For each line the place of its first equal."""
        at_id, at_sub = self.id.copy(), self.sub.copy()
        for again, row in self.exact.bits(answers):
            at_id[self.firsts[again]], at_sub[self.firsts[again]] = _unzip(row[3], np.int64), _unzip(row[4], np.int64)
        return at_id[self.same], at_sub[self.same]

    def candidates(self, answers: pd.DataFrame) -> np.ndarray:
        """Lines that are the first of their text and share a half: 16 times the line plus the four halves' bits."""
        told = answers[(answers["_part"] >= self.parts) & (answers["_part"] < 2 * self.parts)]
        slots = np.concatenate([self._noted(answers, 0), *[_unzip(x, np.int64) for x in told["_b"]]])
        bits = np.zeros(len(self.words), np.int64)
        np.bitwise_or.at(bits, slots // 4, 1 << slots % 4)
        for again, _ in self.exact.bits(answers):
            bits[self.firsts[again]] = 0
        return np.flatnonzero(bits) << 4 | bits[bits > 0]

    def send_variants(self, answers: pd.DataFrame) -> list[pd.DataFrame]:
        found = self.candidates(answers)
        asked = self.ask_variants(found)
        return [asked.sent(self.number, self.id[self.key_line], self.sub[self.key_line], self.key_at), self._note(1, found)]

    def ask_variants(self, found: np.ndarray) -> Asked:
        """Each distinct key and deleted position once, of the block's first line that has it."""
        line, at, v1, v2 = [], [], [], []
        for i, bits in zip((found >> 4).tolist(), (found & 15).tolist()):
            own_first, own_last = bits & 1, bits & 2
            by_word, own = self._units(i)
            n = len(own)
            middle = (n - 1) // 2
            low, high = (0 if own_last else middle), (n - 1 if own_first else middle)
            keep = np.arange(low + 1, high + 2) if own_first or own_last else np.zeros(0, np.int64)
            keep = np.concatenate([[0], keep])
            a, b = variants(own, by_word)
            line.append(np.full(len(keep), i))
            at.append(keep)
            v1.append(a[keep])
            v2.append(b[keep])
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        line, at, v1, v2 = cat(line, np.int64), cat(at, np.int64), cat(v1, np.uint64), cat(v2, np.uint64)
        self.asking = line
        order = np.lexsort((line, at, v2, v1))
        changed = np.zeros(len(order), bool)
        changed[:1] = True
        for x in (v1, v2, at):
            changed[1:] |= x[order][1:] != x[order][:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(changed) - 1
        first = order[changed]
        rank = np.argsort(first, kind="stable")  # keys in the order of their first lines
        self.variant = np.argsort(rank)[group]
        self.key_line, self.key_at = line[first[rank]], at[first[rank]]
        return Asked(v1[first[rank]], v2[first[rank]], self.parts, 2 * self.parts)

    def near(self, answers: pd.DataFrame) -> dict[int, tuple[int, int]]:
        """For each candidate the place of the earliest line that shares a key with it, itself included."""
        asked = self.ask_variants(self._noted(answers, 1))
        at_id, at_sub = self.id[self.key_line], self.sub[self.key_line]
        for better, row in asked.bits(answers):
            at_id[better], at_sub[better] = _unzip(row[3], np.int64), _unzip(row[4], np.int64)
        best: dict[int, tuple[int, int]] = {}
        for i, a, b in zip(self.asking.tolist(), at_id[self.variant].tolist(), at_sub[self.variant].tolist()):
            if i not in best or (a, b) < best[i]:
                best[i] = (a, b)
        return best


def _in_order(block: pd.DataFrame) -> pd.DataFrame:
    return block.sort_values(["_id", "_text"], kind="stable", ignore_index=True)


def _answer(part: pd.DataFrame, parts: int) -> pd.DataFrame:
    if part["_part"].iat[0] >= 3 * parts:  # a note that a block sends to itself
        return part
    part = part.sort_values("_block", ignore_index=True)
    each = [np.frombuffer(x, np.uint64) for x in part["_a"]]
    keys = np.concatenate(each)
    kind = int(part["_part"].iat[0]) // parts
    places = [np.arange(len(keys)), np.arange(len(keys))]
    if kind == 0:  # equal lines: the first one
        order = np.argsort(keys, kind="stable")
        start = np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1]))
        best = np.empty(len(keys), np.int64)
        best[order] = np.repeat(order[start], np.diff(np.append(start, len(keys))))
    elif kind == 1:  # halves: another line has it
        line = np.concatenate([_unzip(x, np.uint64) for x in part["_b"]])
        order = np.lexsort((line, keys))
        k, x = keys[order], line[order]
        start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        sizes = np.diff(np.append(start, len(keys)))
        shared = (x[start] == 0) | (x[start] != x[start + sizes - 1])
        hit = np.empty(len(keys), bool)
        hit[order] = np.repeat(shared, sizes)
    else:  # variants: the whole line meets all deletions, a deletion the whole line and those at its position
        at = np.concatenate([_unzip(x, np.int64) for x in part["_d"]])
        order = np.lexsort((at, keys))
        k, x = keys[order], at[order]
        new = np.append(True, k[1:] != k[:-1])
        start, mine = np.flatnonzero(new), np.cumsum(new) - 1
        far = len(keys)
        whole = np.minimum.reduceat(np.where(x == 0, order, far), start)[mine]
        cut = np.minimum.reduceat(np.where(x > 0, order, far), start)[mine]
        new |= np.append(True, x[1:] != x[:-1])
        same = np.minimum.reduceat(order, np.flatnonzero(new))[np.cumsum(new) - 1]
        best = np.empty(len(keys), np.int64)
        best[order] = np.minimum(same, np.where(x == 0, cut, whole))
    if kind != 1:
        places = [np.concatenate([_unzip(x, np.int64) for x in part[c]]) for c in ("_b", "_c")]
        hit = best < np.arange(len(keys))
    cuts = np.cumsum([0, *map(len, each)])
    out = {"_part": part["_part"], "_block": part["_block"]}
    if kind == 1:
        out["_b"] = [_zip(_unzip(x, np.int64)[hit[a:b]]) for x, a, b in zip(part["_c"], cuts, cuts[1:])]
    else:
        out["_a"] = [np.packbits(hit[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
        for c, place in zip("bc", places):
            out[f"_{c}"] = [_zip(place[best[a:b][hit[a:b]]]) for a, b in zip(cuts, cuts[1:])]
    return pd.DataFrame(out).reindex(columns=_NAMES)


def _verifier(near_words: int, near_chars: int):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by place: the line at a place, then the lines that would repeat it."""
        here, first = None, (False, [])
        for b in batches:
            ok = []
            places = zip(b.column("_of_id").to_pylist(), b.column("_of_sub").to_pylist())
            for place, own, text in zip(places, b.column("_own").to_pylist(), b.column("_words").to_pylist()):
                by_word, mine = units(text, near_words, near_chars)
                if own:
                    here, first = place, (by_word, mine)
                ok.append(not own and place == here and by_word == first[0] and within_one(mine, first[1]))
            yield b.select(["_block", "_id", "_sub", "_of_id", "_of_sub"]).filter(pa.array(ok, pa.bool_()))

    return verified


_TOLD = "_block int, _id long, _sub long, _of_id long, _of_sub long"


def _judged(docs: DataFrame, id_col: str, text_col: str, min_words: int, near_words: int, near_chars: int, block_mb: float, part_mb: float, carry, finish, schema: str):
    """``finish(block, lines, first_id, first_sub, near)`` of every block."""
    spread = dealt(docs, id_col, text_col, block_mb, carry)
    parts = max(2 * docs.sparkSession.sparkContext.defaultParallelism, math.ceil(spread.text_bytes / (part_mb * 1e6)))
    blocks = spread.table.groupBy("_block")

    def read(block: pd.DataFrame) -> tuple[pd.DataFrame, Lines]:
        block = _in_order(block)
        return block, Lines(block, parts, min_words, near_words, near_chars)

    def ask(block: pd.DataFrame) -> pd.DataFrame:
        block, lines = read(block)
        return pd.concat([lines.exact.sent(lines.number, lines.id[lines.firsts], lines.sub[lines.firsts]), *lines.send_halves()])

    def ask_more(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block, lines = read(block)
        return pd.concat(lines.send_variants(answers))

    def show(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """The words of each candidate at its own place, and at that of the earlier line it is to be compared with."""
        block, lines = read(block)
        rows = []
        for i, best in lines.near(answers).items():
            place = (int(lines.id[i]), int(lines.sub[i]))
            for at in {place, best}:
                rows.append((block["_block"].iat[0], *place, *at, at == place, lines.words[i].decode()))
        return pd.DataFrame(rows, columns=["_block", "_id", "_sub", "_of_id", "_of_sub", "_own", "_words"])

    def close(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block, lines = read(block)
        told = answers[answers["_part"] < 0]
        near = {(int(r[6]), int(r[7])): (int(r[8]), int(r[9])) for r in told.itertuples(index=False)}
        return finish(block, lines, *lines.earliest(answers), near)

    def by_block(df: DataFrame):
        return df.repartition(spread.count, "_block").groupBy("_block")

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        return _answer(part, parts)

    first = blocks.applyInPandas(ask, _MESSAGE).groupBy("_part").applyInPandas(answer, _MESSAGE)
    second = blocks.cogroup(by_block(first)).applyInPandas(ask_more, _MESSAGE).groupBy("_part").applyInPandas(answer, _MESSAGE)
    shown = blocks.cogroup(by_block(first.unionByName(second))).applyInPandas(show, _TOLD + ", _own boolean, _words string")
    met = shown.repartition("_of_id", "_of_sub").sortWithinPartitions("_of_id", "_of_sub", F.desc("_own"))
    told = met.mapInArrow(_verifier(near_words, near_chars), _TOLD)
    none = F.lit(None).cast("binary")
    told = told.select(F.lit(-1).alias("_part"), "_block", *[none.alias(f"_{c}") for c in "abcd"], "_id", "_sub", "_of_id", "_of_sub")
    plain = first.select("*", *[F.lit(None).cast("long").alias(c) for c in ("_id", "_sub", "_of_id", "_of_sub")])
    return blocks.cogroup(by_block(plain.unionByName(told))).applyInPandas(close, schema), spread


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    near_words: int = NEAR_WORDS,
    near_chars: int = NEAR_CHARS,
    block_mb: float = 8.0,
    part_mb: float = 32.0,
) -> DataFrame:
    """Every line of ``min_words`` words or more, and whether an earlier one repeats it.

    Returns the id, ``line_no`` (from 0, by line feeds), ``n_words``, ``removed``, and
    ``of_id`` and ``of_line``: the first equal line, or for the first of its text the
    earliest near one, or its own place.  From ``near_words`` words on near is one word;
    with fewer words, from ``near_chars`` characters on (of the words joined by a space),
    it is one character; a line is never near one of the other kind.
    Earlier means a smaller id, or a smaller line number in the same document; lines are
    judged on the input.

    Null and empty texts have no lines.  A null id counts as smaller than all and comes
    back null.  Rows that share an id come one after the other, by text; of equal rows the
    second repeats the first.  An empty table gives an empty table.  Other columns are not
    read.
    """

    def finish(block, lines, first_id, first_sub, near):
        own = list(zip(lines.id.tolist(), lines.sub.tolist()))
        of = [(a, b) if (a, b) != p else near.get(p, p) for a, b, p in zip(first_id.tolist(), first_sub.tolist(), own)]
        return pd.DataFrame(
            {
                "_id": lines.id, "line_no": lines.no, "n_words": lines.n, "removed": [x != p for x, p in zip(of, own)],
                "_of": np.array([x[0] for x in of], np.int64), "of_line": np.array([x[1] & 0xFFFFFFFF for x in of], np.int64),
            }
        )

    schema = "_id long, line_no int, n_words int, removed boolean, _of long, of_line int"
    out, _ = _judged(docs, id_col, text_col, min_words, near_words, near_chars, block_mb, part_mb, (), finish, schema)
    return out.select(id_back("_id").alias(id_col), "line_no", "n_words", "removed", id_back("_of").alias("of_id"), "of_line")


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    near_words: int = NEAR_WORDS,
    near_chars: int = NEAR_CHARS,
    block_mb: float = 8.0,
    part_mb: float = 32.0,
) -> DataFrame:
    """The documents, same columns, their texts without the repeated lines; a null text stays null."""
    names = docs.columns
    others = [c for c in names if c not in (id_col, text_col)]
    carry = (column(id_col).isNull(), column(text_col).isNull(), *others)
    held = [f"_c{i}" for i in range(2, len(carry))]

    def finish(block, lines, first_id, first_sub, near):
        gone: dict[int, set[int]] = {}
        for d, no, i, s, a, b in zip(*(x.tolist() for x in (lines.doc, lines.no, lines.id, lines.sub, first_id, first_sub))):
            if (a, b) != (i, s) or (i, s) in near:
                gone.setdefault(d, set()).add(no)
        texts = []
        for d, (text, null) in enumerate(zip(block["_text"], block["_c1"])):
            if d in gone:
                text = b"\n".join(x for n, x in enumerate(text.split(b"\n")) if n not in gone[d])
            texts.append(None if null else text.decode())
        return pd.DataFrame({"_id": block["_id"], "_new": texts, **{c: block[c] for c in held}})

    inner = docs.select(*[c.alias(f"_c{i}") if not isinstance(c, str) else column(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in inner.schema.fields[2:])
    out, _ = _judged(docs, id_col, text_col, min_words, near_words, near_chars, block_mb, part_mb, carry, finish, "_id long, _new string" + kinds)
    where = {id_col: id_back("_id"), text_col: F.col("_new")} | {c: F.col(f"_c{i + 2}") for i, c in enumerate(others)}
    return out.select(*[where[c].alias(c) for c in names])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP7_SQL = r"""
with raw as (
    select doc_id, unnest(range(0, len(ls))) as line_no, unnest(ls) as line
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
),
l as (
    select doc_id, line_no, lw, len(lw) as n, array_to_string(lw, ' ') as k
    from (select *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as lw from raw)
    where len(lw) > 0
),
f as (select k, any_value(lw) as lw, any_value(n) as n, min({'d': doc_id, 'l': line_no}) as first from l group by k),
u as (
    select k, first, n >= 8 as by_word, case when n >= 8 then lw else regexp_extract_all(k, '(?s).') end as us
    from f where n >= 8 or length(k) >= 16
),
v as (
    select k, first, by_word, unnest(range(1, len(us) + 1)) as pos,
           unnest(list_transform(range(1, len(us) + 1), lambda i : md5(array_to_string(list_concat(us[1:i - 1], us[i + 1:]), ' ')))) as cut
    from u
),
w as (select k, first, by_word, md5(array_to_string(us, ' ')) as whole from u),
near as (
    select k, min(first) over (partition by cut, pos, by_word) as m from v
    union all select v.k, w.first as m from v join w on v.cut = w.whole and v.by_word = w.by_word
    union all select w.k, v.first as m from w join v on v.cut = w.whole and v.by_word = w.by_word
),
best as (select k, min(m) as m from (select k, m from near union all select k, first as m from f) group by k)
select doc_id, cast(line_no as int) as line_no, cast(n as int) as n_words, m < place as removed,
       case when first < place then first.d else m.d end as of_id, cast(case when first < place then first.l else m.l end as int) as of_line
from (select l.*, b.m, f.first, {'d': l.doc_id, 'l': l.line_no} as place from l join best b on l.k = b.k join f on l.k = f.k)
"""
