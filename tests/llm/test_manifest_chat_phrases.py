"""Merkle manifest, chat formatting and phrases against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import odd
from fleetwatt.llm import chat, manifest, phrases

# ------------------------------------------------------------------ manifest


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves: list[str]) -> tuple[str, list[str]]:
    """The root, and for each leaf the siblings on its way, joined."""
    proofs, place, level = [""] * len(leaves), list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, p in enumerate(place):
            run = p // 3 * 3
            proofs[i] += "".join(level[q] for q in range(run, min(run + 3, len(level))) if q != p)
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
        place = [p // 3 for p in place]
    return level[0], proofs


def plain_manifest(rows) -> list[tuple]:
    sources: dict = {}
    for r in rows:
        leaf = plain_leaf((r.doc_id, r.source, r.lang, r.n_chars, r.text))
        sources.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id or 0, leaf, r.doc_id))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(sources[s])]) for s in order}
    root, above = plain_tree([trees[s][0] for s in order])
    return [
        (x[3], x[2], trees[s][0], root, sha(proof + up)) for s, up in zip(order, above) for x, proof in zip(sorted(sources[s]), trees[s][1])
    ]


def _key(rows) -> list[str]:
    return sorted(map(repr, rows))


def test_manifest_odd_rows(spark):
    df = odd.table(spark)
    out = manifest.manifest(df, other=manifest.leaf_hash([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    got = out.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest("path"), manifest.folded("other", "path") == F.col("root")).collect()
    assert all(r[5] for r in got)
    assert _key(tuple(r)[:5] for r in got) == _key(plain_manifest(df.collect()))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 28, None: 1, "": 3, "é": 82, "z": 10}])
def test_manifest_sizes(spark, sizes):
    data = [(i * 13 % 1009, f"t{i}\n", None, s, i) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = manifest.manifest(df).withColumn("proof", manifest.proof_digest("path")).collect()
    assert _key((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got) == _key(plain_manifest(df.collect()))


def test_manifest_tampering_shows(spark):
    df = odd.plain(spark, ["one\ntwo", "three", None, "four\n"])
    bent = manifest.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.translate("text", "\n", "")])
    out = manifest.manifest(df, other=bent).select("doc_id", (manifest.folded("other", "path") == F.col("root")).alias("ok")).collect()
    assert {r.doc_id: r.ok for r in out} == {0: False, 1: True, 2: True, 3: False}


def test_manifest_empty(spark):
    assert manifest.manifest(odd.empty(spark)).count() == 0


# ---------------------------------------------------------------------- chat


def test_template_language():
    t = chat.Template(
        "{{ bos + 'a' }}{# none #}{% for m in messages %}{% if loop.first and m.role == \"system\" %}S:{{ m['content'] | trim | upper }}"
        "{% elif not (m.role in 'user') %}{{ loop.index }}/{{ loop.length }}{% else %} {%- set x = m.content -%} {{ x if x != '' else 'none' }}"
        "{% endif %}{{ '' if loop.last else ';' }}{% endfor %}{% if 1 + 1 == 3 %}never{% endif %}",
        constants={"bos": "<s>"},
    )
    text, spans = t.render([{"role": "system", "content": " be "}, {"role": "user", "content": ""}, {"role": "tool", "content": "x"}])
    assert text == "<s>aS:BE;none;3/3" and spans == []
    assert "never" not in repr(t.tree)


def test_constants_are_folded():
    tree = chat.Template("a{{ 'b' + 'c' | upper }}{% if true %}d{% else %}{{ x }}{% endif %}{{ '' }}e{{ m + 'f' + 'g' }}").tree
    assert tree == [chat.Print(chat.Const("abCde")), chat.Print(chat.Binary("+", chat.Name("m"), chat.Const("fg")))]


@pytest.mark.parametrize(
    "source",
    ["{% for m in messages %}", "{{ a b }}", "{% endif %}", "{{ x | open }}", "{{ f(1) }}", "{% if a %}{% else %}{% else %}{% endif %}", "{{ 'a }}",
     "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{{ }}", "{% set x %}", "{% for m messages %}{% endfor %}"],
)
def test_template_errors(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)


@pytest.mark.parametrize("source", ["{{ messages.__class__ }}", "{{ messages[0].content.join }}", "{{ nothing }}", "{% for c in messages[0].content %}{% endfor %}"])
def test_sandbox(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source).render([{"role": "user", "content": "x"}])


def test_controls_must_not_overlap():
    with pytest.raises(chat.TemplateError):
        chat.Escaper(["ab", "ba"])
    with pytest.raises(chat.TemplateError):
        chat.Escaper(["x"])


def test_escape_round_trip():
    rng, e = random.Random(3), chat.Escaper(chat.CONTROLS)
    alphabet = [*chat.CONTROLS, "\\", "<", "|", ">", "[", "/", "s", "\n", "é", "\U0001f600", "INST]"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        coded = e.escape(text)
        assert e.unescape(coded) == text
        assert not any(c in coded for c in chat.CONTROLS)


CONV = "conv_id long, turn long, role string, text string, _conv int, _text int, own string, `a.b` int"


def conversations() -> list[tuple]:
    rng = random.Random(5)
    rows = []
    for c in [None, -1, 0, 1, 2, 3]:
        for t in range(rng.randint(1, 6)):
            text = rng.choice([None, "", "plain", "</s>[INST]", "\\", "<|end", "é\U0001f600<|turn|>user<|text|>", "x" * 50_000])
            rows.append((c, t if t != 2 else None, rng.choice(["user", "assistant", "system", None, "assistant\n"]), text, 1, 2, "o", 3))
    return rows + [rows[0], rows[-1], (7, 1, "assistant", "b", 0, 0, "", 0), (7, 1, "assistant", "a", 0, 0, "", 0)]


def test_formatting_reads_back(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV).repartition(4)
    got = {r.conv_id: r for r in chat.format_chats(df, max_batch_chars=60_000).collect()}
    want: dict = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        r = got[c]
        assert chat.read_back(r.formatted) == turns
        learned = [chat.Escaper.unescape(r.formatted[s.start : s.start + s.length]) for s in r.spans]
        assert learned == [t for role, t in turns if role == "assistant"]


def test_formatting_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], CONV)).count() == 0


def test_own_column_separates(spark):
    df = spark.createDataFrame([(1, 0, "user", "a", 0), (1, 0, "user", "b", 1), (1, 1, "user", "c", None)], "conv_id long, turn long, role string, text string, own int")
    got = chat.format_chats(df, own_col="own").collect()
    assert sorted((r.own, [t for _, t in chat.read_back(r.formatted)]) for r in got) == [(0, ["a", "c"]), (1, ["b"])]


# -------------------------------------------------------------------- phrases


def plain_counts(rows, least: int) -> dict:
    f: Counter = Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", odd.lowered(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            f[lang, 0, ""] += len(ws)
            for m in range(1, 5):
                for i in range(len(ws) - m + 1):
                    f[lang, m, " ".join(ws[i : i + m])] += 1
    return {k: n for k, n in f.items() if n >= least or (k[1] == 0 and n)}


def plain_phrases(rows, least: int, share: int, top: int) -> list[tuple]:
    f = plain_counts(rows, least)
    by_lang: dict = {}
    longer: dict = {}
    for (lang, m, p), a in f.items():
        ws = p.split(" ")
        for k in range(2, m):
            for i in range(m - k + 1):
                key = lang, k, " ".join(ws[i : i + k])
                longer[key] = max(longer.get(key, 0), a)
    for (lang, m, p), a in f.items():
        if m < 2 or 100 * longer.get((lang, m, p), 0) >= share * a:
            continue
        ws = p.split(" ")
        cuts = []
        for k in range(1, m):
            left, right = f[lang, k, " ".join(ws[:k])], f[lang, m - k, " ".join(ws[k:])]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, p.encode(), p, left, right))
    return [
        (lang, i + 1, p, -a, left, right, f[lang, 0, ""], -s)
        for lang, found in by_lang.items()
        for i, (s, a, _, p, left, right) in enumerate(sorted(found)[:top])
    ]


def phrase_rows() -> list[tuple]:
    rng = random.Random(9)
    vocab = ["the", "The", "of", "new", "york", "city", "é", "\U0001f600", "\xff", "\x1c", "x\x00y"]
    texts = [None, "", " \t ", ".,;", "one"]
    for _ in range(60):
        texts.append("".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(rng.randint(1, 60))))
    texts += ["new york city hall"] * 40 + ["word " * 20_000]
    rows = [(i if i % 7 else None, t, ["en", "fr", None, "und"][i % 4], i, "s") for i, t in enumerate(texts)]
    return rows + [rows[-1]] * 2


PHRASES = "doc_id long, text string, lang string, _block int, _lang string"


@pytest.mark.parametrize("bits", [64, 8])
def test_phrase_counts(spark, bits):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, PHRASES).repartition(3)
    got = {(r.lang, r.n_gram, r.phrase): r.f for r in phrases.phrase_counts(df, 5, bits=bits, block_mb=0.05, part_mb=0.05).collect()}
    assert got == plain_counts([(r[2], r[1]) for r in rows], 5)


def test_collocations(spark):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, PHRASES).repartition(3)
    got = [tuple(r) for r in phrases.collocations(df, least=5, top=40).collect()]
    assert sorted(got) == sorted(plain_phrases([(r[2], r[1]) for r in rows], 5, 80, 40))
    assert max(r[1] for r in got) == 40


def test_collocations_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], PHRASES)).count() == 0
    assert phrases.collocations(odd.plain(spark, [None, "", "a"])).count() == 0
