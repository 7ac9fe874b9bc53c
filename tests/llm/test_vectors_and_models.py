"""Top-k search, language ID and LM scoring."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import odd
from fleetwatt.llm import langid, lm, topk

SF = "/root/testdata/sf0.001"


def _clipped(s: int) -> int:
    return max(-(2**63), min(2**63 - 1, s))


def _brute_top(vectors: dict, queries, k: int) -> set:
    out = set()
    for q in queries:
        scored = []
        for c, v in vectors.items():
            if c != q:
                n = min(len(v), len(vectors[q]))
                scored.append((-_clipped(sum(a * b for a, b in zip(vectors[q][:n], v[:n]))), c))
        out |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(sorted(scored)[:k])}
    return out


def _floors(v) -> list[int]:
    return [math.floor(64 * x) for x in v]


def test_topk_ties_nulls_and_lengths(spark, monkeypatch):
    rng = random.Random(4)
    data = {i: [rng.uniform(-1, 1) for _ in range(12)] for i in range(300)}
    for i in range(100, 130):
        data[i] = data[100]  # one group of equal vectors
    data[150] = [0.0] * 12
    data[151] = [0.5, -0.5]
    bad = [(400, None), (420, [1.0, None]), (440, [float("nan")]), (460, [float("inf")]), (None, [1.0])]
    rows = [(k, v) for k, v in data.items()] + bad
    table = spark.createDataFrame([(k, v, 1, "x", 2) for k, v in rows], "vec_id long, embedding array<double>, _id int, _v string, score int")
    want = _brute_top({k: _floors(v) for k, v in data.items()}, [k for k in data if k % 20 == 0], 20)
    for shard, queries, block in ((8192, 4096, 2048), (64, 4, 16)):
        monkeypatch.setattr(topk, "SHARD", shard)
        monkeypatch.setattr(topk, "QUERIES", queries)
        monkeypatch.setattr(topk, "BLOCK", block)
        got = topk.top_k(table, F.col("vec_id") % 20 == 0).collect()
        assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    assert topk.top_k(table.where("vec_id in (0, 5, 7)"), F.col("vec_id") % 20 == 0).count() == 2
    assert topk.top_k(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_query_rows_that_share_an_id(spark):
    """Each query row has its own places, equal rows too; rows of the same id are no candidates."""
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(1, 60) if i % 20]
    asked = [(20, [rng.uniform(-1, 1) for _ in range(6)]) for _ in range(2)]
    asked.append(asked[0])
    table = spark.createDataFrame(rows + asked, "vec_id long, embedding array<double>").repartition(3)
    want = []
    for _, q in asked:
        want += [(20, r, c, s) for _, r, c, s in _brute_top({i: _floors(v) for i, v in rows} | {20: _floors(q)}, [20], 5)]
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(table, F.col("vec_id") % 20 == 0, k=5).collect()]
    assert sorted(got) == sorted(want) and len(got) == 15


def test_topk_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.floor(64 * rng.normal(0, 0.12, (4000, 32))).astype(np.float32)
    index = topk.Index(np.arange(4000), x)
    for q in (0, 17, 399):
        ids, scores = index.search(q, x[q], 20)
        full = x @ x[q]
        full[q] = -np.inf
        want = np.lexsort((np.arange(4000), -full))[:20]
        assert ids.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
        _, block, low, high = index.blocks[1]
        alive, _ = index._competitive(x[q], block, low, high, scores[-1])
        assert len(alive) < 100


def test_topk_huge_components(spark):
    data = {i: [float(10**7 * (i % 7)), -(2.0**31) * i] for i in range(41)}
    table = spark.createDataFrame(list(data.items()), "vec_id long, embedding array<double>")
    got = topk.top_k(table, F.col("vec_id") % 20 == 0).collect()
    want = _brute_top({k: _floors(v) for k, v in data.items()}, [0, 20, 40], 20)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


def test_langid_held_out_accuracy(spark):
    got = langid.op3_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_langid_odd_table(spark):
    docs = odd.table(spark)
    model = langid.Model([], {})
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, model).collect()} == {("und", 0.0)}
    rng = random.Random(2)
    said = {"en": "the of and wh th", "de": "der und sch ich ei", "fr": "le de eau que ou", "xx": "qo zu ka vo pi"}
    made = [(i, " ".join(rng.choice(said[k].split()) for _ in range(40)), k) for k in said for i in range(30)]
    made = [(n, t, k) for n, (_, t, k) in enumerate(made)]
    model = langid.fit(spark.createDataFrame(made, "_id long, _text string, _lang string"))
    assert model.langs == ["de", "en", "fr", "xx"] and len(model.keys) == 4  # three families, one pair in one of them
    assert all(model.predict(t)[0] == k for _, t, k in made)
    got = {str(r.doc_id): r for r in langid.predict(docs, model).collect()}
    by = {str(r[0]): r[1] for r in odd.rows()}
    assert len(got) == len(by)
    for key, text in by.items():
        if not text or not text.strip():
            assert got[key].lang_pred == "und"
    assert langid.predict(odd.empty(spark), model).count() == 0
    only = langid.fit(spark.createDataFrame([(i, "a b", "en") for i in range(9)], "_id long, _text string, _lang string"))
    assert only.predict("some text") == ("en", 1.0) and only.predict("12 34") == ("und", 0.0)


def test_langid_learns_every_language_and_counts_copies_once(spark):
    rng = random.Random(5)
    said = {"en": "the of and wh th", "de": "der und sch ich ei", "zz": "qo zu ka vo pi"}
    made = [(k, " ".join(rng.choice(said[k].split()) for _ in range(40)), k) for k in said for _ in range(2 if k == "zz" else 40)]
    rows = [(n, t, k) for n, (_, t, k) in enumerate(made)] + [(500, "12 34", "nn"), (501, "", "mm")]
    schema = "_id long, _text string, _lang string"
    once = langid.fit(spark.createDataFrame(rows, schema).repartition(4))
    assert once.langs == ["de", "en", "zz"]  # two documents are enough; texts without a letter teach nothing
    assert all(once.predict(t)[0] == k for _, t, k in rows[:-2])
    copies = langid.fit(spark.createDataFrame(rows + [rows[3]] * 60, schema).repartition(4))
    assert copies.keys == once.keys and (copies.table == once.table).all()
    shared = langid.fit(spark.createDataFrame([(1, t, k) for _, t, k in rows], schema), sample=20)
    assert shared.langs == once.langs and all(shared.predict(t)[0] == k for _, t, k in rows[:-2])


def _walk(tokens: list[list], training: list[bool], mu: float) -> list[tuple]:
    """The automaton, one token at a time, from plain counts."""
    uni, pair = Counter(), Counter()
    starts = sum(training)
    for t, on in zip(tokens, training):
        if on:
            uni.update(t)
            pair.update(zip([None, *t], t))
    n, v = sum(uni.values()), len(uni)
    out = []
    for t in tokens:
        state, base, total = None, 0.0, 0.0
        for w in t:
            p = (uni[w] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            held = starts if state is None else uni[state]
            if pair[(state, w)]:
                total += math.log10((pair[(state, w)] + mu * p) / (held + mu))
            else:  # the failure arc to the root
                total += math.log10(mu / (held + mu)) + math.log10(p)
            state = w
        out.append((len(t), sum(uni[w] > 0 for w in t), n, round(base, 6), round(total, 6)))
    return out


def _tokens(text) -> list[str]:
    return [*odd.words(odd.lowered(text)), "\n"]


def test_lm_scores_equal_the_plain_walk(spark):
    docs = odd.table(spark)
    on = [bool(r[0] is not None and r[0] % 3) for r in odd.rows()]
    given = docs.withColumn("training", F.col("doc_id") % 3 != 0)
    for mu, mb in ((100.0, 8.0), (3.0, 0.02)):
        got = lm.score(given, mu=mu, block_mb=mb, part_mb=mb).collect()
        want = _walk([_tokens(r[1]) for r in odd.rows()], on, mu)
        have = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got]
        for a, b in zip(sorted(have), sorted((str(r[0]), *w) for r, w in zip(odd.rows(), want))):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-6) and math.isclose(a[5], b[5], rel_tol=1e-6), (a, b)
    none = lm.score(docs.withColumn("training", F.lit(None).cast("boolean"))).collect()
    assert len(none) == len(on) and all(r.train_tokens == 0 and r.n_known == 0 for r in none)
    assert lm.score(odd.empty(spark).withColumn("training", F.lit(True))).count() == 0


def test_lm_probabilities_sum_to_one(spark):
    """Over all words that can follow, unknown ones as one class."""
    arcs = lm.Arcs([b"a b a c", b"a b", b"z"])
    uni, pair = arcs.counts(np.array([True, True, False]))
    total, distinct, mu = int(uni.sum()), int((uni > 0).sum()), 5.0
    p = (uni + 0.5) / (total + 0.5 * (distinct + 1))
    held = {b"a": 3, b"b": 2, b"c": 1}
    for state, n in held.items():
        k = {w: i for i, w in enumerate([b" ", b"\n", b"a", b"b", b"c", b"z"])}[state]
        mass = sum(pair[arcs.arc[i]] for i in {int(np.flatnonzero(arcs.arc == a)[0]) for a in set(arcs.arc[arcs.at == k])})
        known = sum(float(p[w]) for w in range(1, 5))
        unknown = 0.5 / (total + 0.5 * (distinct + 1))
        assert math.isclose((mass + mu * (known + unknown)) / (n + mu), 1.0)


def test_lm_model_beats_the_base_on_held_out_texts(spark):
    got = [r for r in lm.op10_lm_scoring(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
