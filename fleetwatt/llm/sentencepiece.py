"""SentencePiece encoding and decoding by a shared-prefix forward pass.

A text is cut into marked words (a run of marks and the characters after it); no piece
crosses their borders.  The distinct words of a batch are sorted, which lays out their
trie: each word keeps the forward states of the prefix it shares with the one before and
extends only the rest.  For a BPE model all prefixes of one length are extended together
by array work; long words and unigram models walk the trie depth first.

The state of a prefix is, for a unigram model, the best score of a segmentation and the
start of its last piece (Viterbi).  A BPE model fixes one segmentation of every prefix,
and a piece can follow another exactly if merging the two alone gives those two again;
so the state is the start of the one last piece that fits what its start holds, and the
result equals the merges'.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column, id_back, id_key

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Marked words whose ids a worker remembers as recent (as many older ones are kept until
#: the next turn), and the longest it remembers.
REMEMBERED, LONGEST = 50_000, 48
#: Pairs of pieces whose fit a worker remembers.
PAIRS = 200_000
#: Words whose prefixes are extended together.
TOGETHER = 16_384

NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5


class Table:
    """Numbers kept for pairs of numbers, looked up by arrays."""

    def __init__(self, pairs: dict[tuple[int, int], float], width: int, kind: type):
        keys = np.array([a * width + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.width = width
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(list(pairs.values()), kind)[order], kind(0))

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each pair is there, and its number."""
        key = a.astype(np.int64) * self.width + b
        at = np.searchsorted(self.keys, key)
        return self.keys[at] == key, self.values[at]


class Levels:
    """A BPE model's pieces as numbers, and the walk over all prefixes of one length.

    Number 0 is no piece, 1 a character that is in no piece (such characters never merge,
    so one number stands for all); the pieces and their characters follow.
    """

    def __init__(self, model: Pieces):
        self.model = model
        alphabet = sorted({c for p in model.id for c in p})
        strange = next(c for c in map(chr, range(len(alphabet) + 1)) if c not in set(alphabet))
        self.names = ["", strange, *model.id, *(c for c in alphabet if c not in model.id)]
        number = {p: i for i, p in enumerate(self.names) if i > 1}
        self.size = np.array([len(p) for p in self.names], np.int64)
        self.piece = np.array([-1, -1, *[model.id.get(p, -1) for p in self.names[2:]]], np.int32)
        self.left = np.array([number.get(model.left.get(p), 0) for p in self.names], np.int64)
        self.right = np.array([number.get(model.right.get(p), 0) for p in self.names], np.int64)
        self.made = (self.size == 1) | (self.left > 0)
        self.marks = np.array([p.endswith(MARK) for p in self.names])
        #: when a piece is made: its score, or never undone
        self.score = np.array([model.score[p] if len(p) > 1 else np.inf for p in self.names])
        #: the score of two neighbours' merge
        splits = ((p, number.get(p[:i]), number.get(p[i:])) for p in model.id for i in range(1, len(p)))
        self.across = Table({(a, b): model.score[p] for p, a, b in splits if a and b}, len(self.names), np.float64)
        #: the ends of pieces as a trie read from the last character; node 0 is its root
        char = {c: i for i, c in enumerate(alphabet, 1)}
        node = {end: i for i, end in enumerate(["", *sorted(model.ends, key=len)])}
        self.before = Table({(node[end[1:]], char[end[0]]): i for end, i in node.items() if end}, len(char) + 1, np.int64)
        self.of_node = np.array([number.get(end, 0) for end in node], np.int64)
        self.of_char = np.array([1, *[number[c] for c in char]], np.int64)
        self.char = np.zeros(0x110000, np.int32)
        self.char[[ord(c) for c in char]] = list(char.values())

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Pieces._fit`` of many pairs; an ``a`` of 0 is no piece before."""
        ok = self.made[b]
        after_marks = np.flatnonzero(self.marks[a])
        ok[after_marks] = [self.model._fits(self.names[x], self.names[y]) for x, y in zip(a[after_marks].tolist(), b[after_marks].tolist())]
        at = np.flatnonzero(ok & (a > 0) & ~self.marks[a])
        a, b, least, first = a[at], b[at], np.full(len(at), -np.inf), np.zeros(len(at), bool)
        while len(at):
            there, across = self.across.find(a, b)
            bad = there & ((across > least) | first & (across == least))
            ok[at[bad]] = False
            in_a, in_b = self.score[a], self.score[b]
            undo_a = in_a < in_b
            on = np.flatnonzero(~bad & (undo_a | (in_b < np.inf)))
            at, a, b, undo_a = at[on], a[on], b[on], undo_a[on]
            least, first = np.minimum(in_a, in_b)[on], ~undo_a
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def _fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs, which = np.unique(a * len(self.names) + b, return_inverse=True)
        return self._fit(pairs // len(self.names), pairs % len(self.names))[which]

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of each of the sorted ``words`` as 32-bit numbers."""
        count = len(words)
        length = np.fromiter(map(len, words), np.int64, count)
        deepest = int(length.max())
        inside = np.arange(deepest) < length[:, None]
        chars = np.full((count, deepest), -1, np.int32)
        chars[inside] = self.char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        other = chars[1:] != chars[:-1]
        same = np.append(0, np.where(other.any(axis=1), other.argmax(axis=1), deepest))
        chars = np.ascontiguousarray(chars.T)
        last = np.zeros((deepest + 1, count), np.int64)  # the last piece of each word's prefix of each length
        for end in range(1, deepest + 1):
            own = (length >= end) & (same < end)
            self._step(chars, end, np.flatnonzero(own), last)
            last[end] = last[end, np.maximum.accumulate(np.where(own, np.arange(count), 0))]
        return self._spelled(words, length, last)

    def _step(self, chars: np.ndarray, end: int, todo: np.ndarray, last: np.ndarray) -> None:
        """The last pieces of the prefixes of length ``end`` of the words ``todo``."""
        own, node = todo, np.zeros(len(todo), np.int64)
        for size in range(1, end + 1):
            char = chars[end - size, todo]
            there, node = self.before.find(node, char)
            piece = self.of_char[char] if size == 1 else np.where(there, self.of_node[node], 0)
            some = np.flatnonzero(piece)
            some = some[self._fits(last[end - size, todo[some]], piece[some])]
            last[end, todo[some]] = piece[some]
            there[some] = False
            todo, node = todo[there], node[there]
            if not len(todo):
                break
        if not last[end, own].all():
            raise AssertionError("a prefix has no last piece")

    def _spelled(self, words: list[str], length: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The ids along the last pieces, from each word's end to its start."""
        word, end, steps = np.arange(len(words)), length, []
        total = np.zeros(len(words), np.int64)
        while len(word):
            piece = last[end, word]
            total[word] += 1
            end = end - self.size[piece]
            steps.append((word, piece, end))
            word, end = word[end > 0], end[end > 0]
        after = np.cumsum(total)
        ids, start = np.empty(int(total.sum()), np.int32), np.empty(int(total.sum()), np.int64)
        for k, (word, piece, at) in enumerate(steps, 1):
            ids[after[word] - k], start[after[word] - k] = self.piece[piece], at
        spelled, ends = ids.tobytes(), (4 * after).tolist()
        out = [spelled[i:j] for i, j in zip([0, *ends], ends)]
        for w in np.unique(np.searchsorted(after, np.flatnonzero(ids < 0), side="right")).tolist():
            cuts = [*start[after[w] - total[w] : after[w]].tolist(), len(words[w])]
            out[w] = np.array(self.model.ids([words[w][i:j] for i, j in zip(cuts, cuts[1:])]), np.int32).tobytes()
        return out


class Pieces:
    """A model file's pieces and the two directions over them."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models are read")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or train.treat_whitespace_as_suffix:
            raise ValueError("only models with identity normalisation and a leading mark are read")
        self.bpe = train.model_type == 2
        self.score, self.id, self.bytes, self.out = {}, {}, {}, []
        self.unknown = 0
        for i, p in enumerate(proto.pieces):
            shown = b""
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                shown = bytes([int(p.piece[3:5], 16)])
            elif p.type == NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
                shown = p.piece.replace(MARK, " ").encode()
            elif p.type == UNKNOWN:
                self.unknown, shown = i, train.unk_surface.encode()
            elif p.type != CONTROL:
                raise ValueError(f"piece {p.piece!r} has a type that is not read")
            self.out.append(shown)
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece has a mark after another character")
        self.worst = min(self.score.values(), default=0.0) - 10.0
        #: every end of a piece: a longer end cannot be one if a shorter is not
        self.ends = {p[i:] for p in self.id for i in range(len(p))}
        self.cut = self._words()
        self.left: dict[str, str] = {}
        self.right: dict[str, str] = {}
        self.seen: dict[str, bool] = {}
        if self.bpe:
            self._last_merges()
        self.levels = Levels(self) if self.bpe else None
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _words(self) -> re.Pattern:
        """Cuts a text where no piece can cross: before marks, and around line feeds and
        before signs if no piece has a line feed, or a letter before the sign."""
        inside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        feed = "" if any("\n" in x for x in inside) else "\n"
        letter = r"[^\W\d_]"
        signs = "".join(c for c in ".,!?;:" if not any(x[1] == c and re.match(letter, x[0]) for x in inside))
        if not signs:
            return re.compile(f"{feed or '(?!)'}|{MARK}*[^{MARK}{feed}]+|{MARK}+")
        plain = f"[^{MARK}{feed}{signs}]"
        run = f"(?:{plain}+|(?<!{letter})[{signs}])"
        most = f"{MARK}*{plain}++(?![{signs}])"  # no sign follows: the same as the runs, and faster
        return re.compile(f"{most}|{feed or '(?!)'}|{MARK}*{run}+|[{signs}]{run}*|{MARK}+")

    def merged(self, chars: list[str], until: int = 1) -> list[str]:
        """Merge neighbours, best score and then leftmost first, until none is a piece or ``until`` are left."""
        chars = list(chars)
        while len(chars) > until:
            best, at = None, -1
            for i in range(len(chars) - 1):
                s = self.score.get(chars[i] + chars[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            chars[at : at + 2] = [chars[at] + chars[at + 1]]
        return chars

    def _last_merges(self) -> None:
        """The two parts that the last merge of each piece joins.  A piece that merging its
        own characters does not give has none, and never stands in a BPE segmentation."""
        for p in self.id:
            if len(p) > 1 and len(parts := self.merged(list(p), until=2)) == 2 and parts[0] + parts[1] == p:
                self.left[p], self.right[p] = parts

    def _fit(self, a: str, b: str) -> bool:
        """Whether merging ``a + b`` gives the two pieces: undo the later of their last
        merges, and again for the parts at the seam; until both are characters no merge
        across the seam may come before the merge undone last."""
        if not a:
            return len(b) == 1 or b in self.left
        if a[-1] == MARK:
            return self.merged(list(a + b)) == [a, b]  # runs of marks have equal scores
        if len(b) > 1 and b not in self.left:
            return False
        score, least = self.score, -np.inf
        first = False  # a merge across the seam that is as good comes first: it is further left
        in_a = score[a] if len(a) > 1 else np.inf
        in_b = score[b] if len(b) > 1 else np.inf
        while True:
            across = score.get(a + b)
            if across is not None and (across > least or first and across == least):
                return False
            if in_a < in_b:
                least, first, a = in_a, False, self.right[a]
                in_a = score[a] if len(a) > 1 else np.inf
            elif in_b < np.inf:
                least, first, b = in_b, True, self.left[b]
                in_b = score[b] if len(b) > 1 else np.inf
            else:
                return True

    def _fits(self, a: str, b: str) -> bool:
        pair = a + "\0" + b
        ok = self.seen.get(pair)
        if ok is None:
            if len(self.seen) > PAIRS:
                self.seen.clear()
            ok = self.seen[pair] = self._fit(a, b)
        return ok

    def _step_bpe(self, word: str, end: int, last: list[int], best: list[float]) -> None:
        """The start of the last piece of ``word[:end]``."""
        for start in range(end - 1, -1, -1):
            piece = word[start:end]
            if start < end - 1 and piece not in self.ends:
                break
            if (start == end - 1 or piece in self.score) and self._fits(word[last[start] : start], piece):
                last.append(start)
                best.append(0.0)
                return
        raise AssertionError("a prefix has no last piece")

    def _step_unigram(self, word: str, end: int, last: list[int], best: list[float]) -> None:
        """The start of the last piece of the best segmentation of ``word[:end]``."""
        top, at = -np.inf, end - 1
        for start in range(end - 1, -1, -1):
            s = self.score.get(word[start:end])
            if s is None:
                if start < end - 1:
                    if word[start:end] not in self.ends:
                        break
                    continue
                s = self.worst
            if best[start] + s >= top:
                top, at = best[start] + s, start
        last.append(at)
        best.append(top)

    def segment(self, words: list[str]) -> Iterator[list[str]]:
        """Pieces of each of the sorted ``words``, sharing the states of common prefixes."""
        step = self._step_bpe if self.bpe else self._step_unigram
        before, last, best = "", [0], [0.0]
        for word in words:
            same = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], best[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                step(word, end, last, best)
            out, at = [], len(word)
            while at:
                out.append(word[last[at] : at])
                at = last[at]
            yield out[::-1]
            before = word

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        split = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        known, older = self.recent, self.older
        new: set[str] = set()
        for words in split:
            new.update(filterfalse(known.__contains__, words))
        known.update((w, older[w]) for w in new if w in older)
        new = sorted(new - known.keys())
        long = [w for w in new if len(w) > LONGEST]
        deep = long if self.levels else new
        known.update((w, np.array(self.ids(p), np.int32).tobytes()) for w, p in zip(deep, self.segment(deep)))
        if self.levels:
            short = [w for w in new if len(w) <= LONGEST]
            for lo in range(0, len(short), TOGETHER):
                known.update(zip(some := short[lo : lo + TOGETHER], self.levels.ids(some)))
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in long:
            del known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") and (not ids or self.out[ids[0]][:1] == b" ") else text


@lru_cache(maxsize=2)
def pieces(path: str = MODEL) -> Pieces:
    if not os.path.isabs(path):
        import public_tokenizers

        path = public_tokenizers.path(path)
    with open(path, "rb") as f:
        return Pieces(f.read())


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's id and the ``ids`` of its whole text.

    A null or empty text has no ids.  A null id comes back null; rows that share an id
    give a row each.  An empty table gives an empty table.  Other columns are not read.
    ``model`` is a file path, or a name among the public tokenizer files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                some = pieces(model).encode(b.column(1).slice(lo, 250).to_pylist())
                ends = np.cumsum([0, *map(len, some)]) // 4
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(some), np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, 250), lists], names=["_id", "ids"])

    source = docs.select(id_key(id_col).alias("_id"), F.coalesce(column(text_col), F.lit("")).alias("_text"))
    return source.mapInArrow(run, "_id long, ids array<int>").select(id_back("_id").alias(id_col), "ids")


def decode(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The table with the text of its ids; null ids give null, no ids the empty text.

    Inverse of ``encode`` but for the mark itself, which reads back as a space.  A column
    that is already named ``out_col`` is replaced.
    """
    names = [c for c in encoded.columns if c != out_col]
    inner = encoded.select(*[column(c).alias(f"_c{i}") for i, c in enumerate(names)])
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            back = pieces(model)
            for lo in range(0, b.num_rows, 100):
                some = b.slice(lo, 100)
                lists = some.column(at)  # as array slices: to_pylist() makes an object of every id first
                ids, cuts = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
                text = [back.decode(ids[i:j].tolist()) if there else None for i, j, there in zip(cuts, cuts[1:], lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(text, pa.string())], names=[*b.schema.names, "_new"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema)
    done = inner.mapInArrow(run, kinds + ", _new string")
    return done.select(*[column(f"_c{i}").alias(c) for i, c in enumerate(names)], F.col("_new").alias(out_col))


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they read back as its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    back = decode(encode(docs.select("doc_id", "text")))
    return back.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.crc32("decoded").alias("decoded_crc32"))
