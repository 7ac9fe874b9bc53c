"""SentencePiece against the library, packing against exact reconstruction."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

import odd
from fleetwatt.llm import packing
from fleetwatt.llm import sentencepiece as pieces


def _model() -> bytes:
    with open(public_tokenizers.path(pieces.MODEL), "rb") as f:
        return f.read()


def _odd_texts(n: int = 1500) -> list[str]:
    rng = random.Random(3)
    letters = " \t\n▁abcdefgthe01éß中文\U0001f600\x00ع  "
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return some + [" " * k + "the" + " " * k for k in range(40)] + [" " * k for k in range(40)]


def test_bpe_ids_are_the_librarys():
    texts = _odd_texts() + [t for r in odd.rows() if (t := r[1])]
    lib = sentencepiece.SentencePieceProcessor(model_proto=_model())
    got = [np.frombuffer(x, np.int32).tolist() for x in pieces.Pieces(_model()).encode(texts)]
    assert got == lib.encode(texts)
    assert [pieces.pieces().decode(x) for x in got] == lib.decode(got)


def test_unigram_scores_are_the_librarys():
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(_model())
    proto.trainer_spec.model_type = 1
    rng = random.Random(5)
    score = {}
    for p in proto.pieces:
        if p.type == 1:
            p.score = -rng.uniform(3, 14)
        score[p.piece] = p.score
    raw = proto.SerializeToString()
    texts = _odd_texts(400)
    lib = sentencepiece.SentencePieceProcessor(model_proto=raw).encode(texts, out_type=str)
    own = pieces.Pieces(raw)
    names = [p.piece for p in proto.pieces]
    same = 0
    for want, got in zip(lib, own.encode(texts)):
        got = [names[i] for i in np.frombuffer(got, np.int32)]
        same += got == want
        assert abs(sum(score[p] for p in got) - sum(score[p] for p in want)) < 1e-2
    assert same > 0.95 * len(texts)  # the rest are ties


def test_shared_prefixes_change_nothing():
    own = pieces.Pieces(_model())
    some = sorted({"▁" + odd.prose(random.Random(i), 1) * 3 for i in range(300)} | {"▁the", "▁then", "▁thener", "▁thenerat"})
    together = list(own.segment(some))
    assert together == [next(own.segment([w])) for w in some]
    assert together == [own.merged(list(w)) for w in some]


def test_short_words_take_no_step_of_their_own(monkeypatch):
    """Prefixes of one length are extended together: only words beyond ``LONGEST`` are walked one by one."""
    rng = random.Random(11)
    names = [p for p in pieces.pieces().id if pieces.MARK not in p and "\n" not in p]
    strange = ["\x00", "\U0001f9ff", "\ue000"]
    words = ["".join(rng.choices(names, k=rng.randint(1, 9))) + rng.choice(strange) * (i % 5 == 0) for i in range(30_000)]
    words = [w for w in words if len(w) < pieces.LONGEST - 4]
    texts = [" " * (i % 4) + " ".join(words[i : i + 50]) for i in range(0, len(words), 50)]
    long = ["".join(words[i : i + 20]) for i in range(0, 400, 20)]
    want = sentencepiece.SentencePieceProcessor(model_proto=_model()).encode(texts + long)
    steps = []
    step = pieces.Pieces._step_bpe
    monkeypatch.setattr(pieces.Pieces, "_step_bpe", lambda self, word, *a: steps.append(word) or step(self, word, *a))
    own = pieces.Pieces(_model())
    got = [np.frombuffer(x, np.int32).tolist() for x in own.encode(texts)]
    assert not steps and len(own.recent) > pieces.TOGETHER
    got += [np.frombuffer(x, np.int32).tolist() for x in own.encode(long)]
    assert got == want and all(len(w) > pieces.LONGEST for w in steps)


def test_fits_by_arrays_are_the_fits():
    own, rng = pieces.Pieces(_model()), np.random.default_rng(13)
    names = own.levels.names
    a, b = rng.integers(0, len(names), 40_000), rng.integers(1, len(names), 40_000)
    b[own.levels.marks[b]] = 1  # a mark never comes behind another character
    common = rng.random(40_000) < 0.5  # short pieces, whose merges are pieces more often
    short = np.flatnonzero((own.levels.size < 4) & (own.levels.size > 0) & ~own.levels.marks)
    a[common], b[common] = rng.choice(short, common.sum()), rng.choice(short, common.sum())
    some = [own._fit(names[x], names[y]) for x, y in zip(a.tolist(), b.tolist())]
    assert own.levels._fits(a, b).tolist() == some and 1000 < sum(some) < 39_000


def test_decode_reads_every_list_of_a_batch(spark):
    lists = [None if i % 7 == 0 else [] if i % 5 == 0 else [260 + i, 300 + i % 90] for i in range(1000)]
    table = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>").coalesce(1)
    want = {i: None if x is None else pieces.pieces().decode(x) for i, x in enumerate(lists)}
    assert {r.doc_id: r.decoded for r in pieces.decode(table).collect()} == want


def test_encode_and_decode_tables(spark):
    docs = odd.table(spark)
    got = pieces.decode(pieces.encode(docs)).collect()
    lib = sentencepiece.SentencePieceProcessor(model_proto=_model())
    want = sorted((str(r[0]), tuple(lib.encode(r[1] or ""))) for r in odd.rows())
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in got) == want
    texts = sorted((r[1] or "").replace("▁", " ") for r in odd.rows())
    assert sorted(r.decoded for r in got) == texts
    assert pieces.encode(odd.empty(spark)).count() == 0
    some = spark.createDataFrame([(1, None, "old"), (2, [], "old")], "doc_id long, ids array<int>, decoded string")
    assert [(r.doc_id, r.decoded) for r in pieces.decode(some).orderBy("doc_id").collect()] == [(1, None), (2, "")]


def _check_packing(rows, texts: list[tuple], length: int) -> float:
    """Every id in one piece, offsets without a gap; the filled share."""
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    ids = [(key, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for key, t in texts]
    want, got, windows = sorted((str(k), x, p) for k, v in ids for p, x in enumerate(v)), [], {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got += [(str(r.doc_id), x, r.start + k) for k, x in enumerate(r.ids)]
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(got) == want
    for pieces_in in windows.values():
        at = 0
        for offset, size in sorted(pieces_in):
            assert offset == at
            at += size
        assert at <= length
    return len(want) / (length * max(1, len(windows)))


def test_packing_odd_table(spark):
    docs = odd.table(spark)
    texts = [(r[0], r[1]) for r in odd.rows()]
    for length, most in ((2048, 64), (64, 2)):
        rows = packing.pack(docs, length, most, with_ids=True).collect()
        filled = _check_packing(rows, texts, length)
        assert filled > 0.97, (length, filled)
    totals = {len(r.ids) for r in rows}
    assert max(totals) == 64
    assert packing.pack(odd.empty(spark)).count() == 0


def test_open_windows_are_bounded_and_full():
    rng = random.Random(9)
    windows, total, closed = packing.Windows(100, 4), 0, 0
    for _ in range(2000):
        size = rng.randint(1, 250)
        total += size
        for full in windows.place(("d", b""), size):
            assert sum(p[2] for p in full) == 100
            closed += 1
        assert len(windows.held) <= 4
    assert total == 100 * closed + sum(p[2] for w in windows.held.values() for p in w)
