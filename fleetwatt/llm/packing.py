"""Sequence packing: bounded-space online best fit, then a merge of what stayed open.

Each partition reads its documents once, in order, and keeps a fixed number of open
windows.  A document longer than a window fills whole windows; the rest goes to the open
window with the least room that holds it.  If none holds it, the fullest window takes as
much as it has room for and is emitted, full, and the remainder is placed again.  The
windows open at the end are merged across bounded groups of partitions, longest piece
first, without further cuts.  Only pieces are shuffled, never tokens.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key, settled, text_bytes

LENGTH = 2048
OPEN = 64
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Partitions whose open windows one task merges.
MERGED = 32
#: Words whose ids a worker remembers as recent; as many older ones are kept until the next turn.
REMEMBERED = 400_000

#: Fixed value: the pattern of tokenizers that drop white space and keep letters, single digits and signs apart.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIGNS = b".,!?;:"


class WordTokenizer:
    """A tokenizer that cuts at white space before anything else and drops it.

    The ids of a text are then those of its words in a row, and each distinct word is
    tokenized once.  Capital letters A-Z do not matter to it, and signs after a letter or
    digit are tokens of their own, so "word", "Word" and "word," need one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        patterns = [p.get("pattern", {}).get("Regex") for p in (parts["pre_tokenizer"] or {}).get("pretokenizers", [])]
        lowers = [n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])]
        if WORD_PATTERN not in patterns or "Lowercase" not in lowers:
            raise ValueError("only tokenizers of lower-cased words without their white space are read")
        self.inner = Tokenizer.from_file(path)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        out = []
        for at in range(0, len(words), 10_000):
            some = self.inner.encode_batch_fast([w.decode() for w in words[at : at + 10_000]], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in some]
        return out

    @staticmethod
    def _stem(word: bytes) -> bytes:
        """The word without signs at its end, if a letter or digit stands before them."""
        stem = word.rstrip(_SIGNS)
        if stem == word or not stem or not (stem[-1:].isalnum() or stem[-1] > 127 and stem.decode()[-1].isalpha()):
            return word
        return stem

    def _learn(self, new: set[bytes]) -> None:
        known, older = self.recent, self.older
        for w in new:
            if w in older:
                known[w] = older[w]
        new = {w: self._stem(w) for w in new if w not in known}
        wanted = {s for s in new.values() if s not in known} | {w[len(s) :] for w, s in new.items() if s != w and w[len(s) :] not in known}
        wanted = list(wanted)
        known.update(zip(wanted, self._encoded(wanted)))
        for w, s in new.items():
            if s != w:
                known[w] = known[s] + known[w[len(s) :]]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]  # special tokens are not lower-cased
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        known = self.recent
        self._learn({w for words in split for w in words if w not in known})
        return [b"".join(map(self.recent.__getitem__, words)) for words in split]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_ids(texts: list[bytes], path: str = TOKENIZER) -> list[bytes]:
    return _tokenizer(path).ids(texts)


class Windows:
    """Open windows of one partition.  ``place`` returns the windows it closed."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.rooms: list[tuple[int, int]] = []  # of windows in use, least room first
        self.held: dict[int, list[tuple]] = {}
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        self.held[self.made] = []
        return self.made

    def _put(self, window: int, room: int, doc: tuple, start: int, size: int) -> list[list[tuple]]:
        self.held[window].append((doc, start, size, self.length - room))
        if room == size:
            return [self.held.pop(window)]
        insort(self.rooms, (room - size, window))
        return []

    def place(self, doc: tuple, total: int) -> list[list[tuple]]:
        done, at = [], 0
        while total - at >= self.length:
            done.append([(doc, at, self.length, 0)])
            at += self.length
        while at < total:
            size = total - at
            k = bisect_left(self.rooms, (size, 0))
            if k < len(self.rooms):
                room, window = self.rooms.pop(k)
                done += self._put(window, room, doc, at, size)
                break
            if len(self.rooms) < self.most:
                done += self._put(self._new(), self.length, doc, at, size)
                break
            room, window = self.rooms.pop(0)
            done += self._put(window, room, doc, at, room)
            at += room
        return done


_PIECES = "_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, _open int"


def _packer(length: int, most: int, end_id: int, path: str, with_ids: bool):
    names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        kinds = [pa.int64()] * 7 + [pa.int32()] + [pa.list_(pa.int32())] * with_ids
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def row(piece: tuple, sequence: int | None, window: int | None) -> tuple:
        (key, ids), start, size, offset = piece
        mine = ids[4 * start : 4 * (start + size)]
        out = (key, start, size, zlib.crc32(mine), len(ids) // 4, sequence, offset, window)
        return (*out, np.frombuffer(mine, "<u4").astype(np.int32)) if with_ids else out

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sequence, windows = TaskContext.get().partitionId(), 0, Windows(length, most)
        for b in batches:
            keys = b.column(0).to_pylist()
            for lo in range(0, len(keys), 500):
                rows = []
                for key, ids in zip(keys[lo : lo + 500], token_ids(b.column(1).slice(lo, 500).to_pylist(), path)):
                    doc = (key, ids + end)
                    for full in windows.place(doc, len(doc[1]) // 4):
                        rows += [row(p, part << 32 | sequence, None) for p in full]
                        sequence += 1
                yield batch(rows)
        yield batch([row(p, None, part) for pieces in windows.held.values() for p in pieces])

    return pack


def _merger(length: int):
    def merge(left: pd.DataFrame) -> pd.DataFrame:
        """Best fit of the left pieces, longest first, into as few windows as it takes."""
        left = left.sort_values(["length", "_id", "start", "_open"], ascending=[False, True, True, True], ignore_index=True)
        rooms: list[tuple[int, int]] = []
        window, offset, made = [], [], 0
        for size in left["length"]:
            k = bisect_left(rooms, (size, -1))
            room, at = rooms.pop(k) if k < len(rooms) else (length, made)
            made = max(made, at + 1)
            window.append(at)
            offset.append(length - room)
            insort(rooms, (room - size, at))
        group = int(left["_group"].iat[0]) if len(left) else 0
        left["sequence_id"] = (1 << 62) + (group << 32) + np.array(window, np.int64)
        left["offset"] = np.array(offset, np.int64)
        return left.drop(columns=["_group", "_open"])

    return merge


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    open_windows: int = OPEN,
    end_id: int = END_ID,
    tokenizer: str = TOKENIZER,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``length`` tokens.

    Returns per piece the id, ``start`` (ids of the document before it), ``length``,
    ``ids_crc32`` (of its ids as little-endian unsigned 32-bit numbers), ``doc_tokens``
    (ids of the document, ``end_id`` included), ``sequence_id`` and ``offset`` (gapless
    from 0 in each sequence), and with ``with_ids`` the ids.  Sequences that partitions
    close are full; only the last ones of a merged group are not.

    A null or empty text is the end id alone.  A null id comes back null; rows that share
    an id are packed each.  An empty table gives an empty table.  Other columns are not
    read.  ``tokenizer`` is a file path, or a name among the public tokenizer files; it
    must take lower-cased words and drop white space.
    """
    source = docs.select(id_key(id_col).alias("_id"), text_bytes(text_col).alias("_text"))
    schema = _PIECES + (", ids array<int>" if with_ids else "")
    placed = settled(source.mapInArrow(_packer(length, open_windows, end_id, tokenizer, with_ids), schema))
    full = placed.where("_open is null").drop("_open")
    left = placed.where("_open is not null").withColumn("_group", F.floor(F.col("_open") / MERGED))
    final = ", ".join(x for x in schema.split(", ") if not x.startswith("_open"))
    merged = left.groupBy("_group").applyInPandas(_merger(length), final)
    names = [x.split()[0] for x in final.split(", ")][1:]
    return full.unionByName(merged).select(id_back("_id").alias(id_col), *[column(c) for c in names])


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
