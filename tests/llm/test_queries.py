"""The registered queries against their SQL, and every stage of the pipeline against plain references."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
import odd
from fleetwatt.llm import registry
from fleetwatt.session import configure, shared_path
from oracle import connect, run
from test_dedup import _near_groups, plain_lines, plain_quality, plain_repeats
from test_tokens import _check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    problem, rows, _, _ = run(spark, con, name, SF, registry.QUERIES, registry.ORACLES)
    assert problem is None, problem
    assert rows > 0


def test_pipeline_stages(spark):
    configure(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = shared_path(spark, name)
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    assert all(t.columns == columns for t in tables[:-1])
    rows = [t.collect() for t in tables]
    assert all(r.n_chars == len(r.text) for t in rows[1:-1] for r in t)

    want = plain_quality([(r.doc_id, r.text, r.source) for r in rows[0]], 10, 0.001)
    assert {(r.doc_id, r.text) for r in rows[1]} == {(i, w[8]) for (i, _, _), w in want.items() if w[6]}

    lines = plain_lines([(r.doc_id, r.text) for r in rows[1]])
    for r, after in zip(sorted(rows[1]), sorted(rows[2])):
        left = [x for n, x in enumerate(r.text.split("\n")) if lines.get((r.doc_id, r.text, n), (r.doc_id, n)) == (r.doc_id, n)]
        assert (after.doc_id, after.text) == (r.doc_id, "\n".join(left))

    judged = sorted(rows[2])
    sets = _near_groups([r.text for r in judged])
    assert sorted(r.doc_id for r in rows[3]) == [r.doc_id for i, r in enumerate(judged) if sets.find(i) == i]

    before = sorted(rows[3])
    gone = plain_repeats([(r.doc_id, r.text) for r in before])
    after = sorted(rows[4])
    assert [(r.doc_id, r.lang, r.source) for r in after] == [(r.doc_id, r.lang, r.source) for r in before]
    for r, a, x in zip(before, after, gone):
        assert odd.words(a.text) == [w for w, g in zip(odd.words(r.text), x) if not g]
        assert any(x) or a.text == r.text

    assert _check_packing(rows[5], [(r.doc_id, r.text) for r in rows[4]], 2048) > 0.98


def test_pipeline_query(spark):
    got = corpus_pipeline.run(spark, SF)
    pieces = [(r.doc_id, r.start, r.length) for r in got.collect()]
    assert max(Counter(pieces).values()) == 1 and got.columns[:3] == ["doc_id", "start", "length"]
