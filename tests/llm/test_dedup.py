"""SimHash, sharding, line dedup, quality rules and substring dedup against plain references."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
import odd
from fleetwatt.llm import jaccard, line_dedup, quality, sharding, simhash, substring_dedup

NO_ID = -(2**63)


def _key(i):
    return NO_ID if i is None else i


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# SimHash


def _plain_fingerprint(text) -> int:
    w = odd.words(odd.lowered(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_plain_one():
    for r in odd.rows():
        if len(r[1] or "") < 20_000:
            assert simhash.fingerprint((r[1] or "").encode()) == _plain_fingerprint(r[1])


def test_near_copies_odd_table(spark):
    docs, rows = odd.table(spark), odd.rows()
    fp = [(_key(r[0]), simhash.fingerprint((r[1] or "").encode())) for r in rows]
    sets = Sets([f for _, f in fp])
    each = sorted(set(sets.up))
    for i, a in enumerate(each):
        for b in each[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    first = {}
    for key, f in fp:
        root = sets.find(f)
        first[root] = min(first.get(root, key), key)
    # a document of several rows joins what each of them links to only through its texts
    want = Counter((key, f"{f:016x}", first[sets.find(f)]) for key, f in fp)
    got = Counter((_key(r.doc_id), r.fingerprint, _key(r.component_id)) for r in simhash.near_copies(docs).collect())
    assert got == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    gone = {key for key, _, c in want if key != c}
    assert Counter(_key(r.doc_id) for r in kept.collect()) == Counter(_key(r[0]) for r in rows if _key(r[0]) not in gone)
    assert simhash.near_copies(odd.empty(spark)).count() == 0


def _signed(x: int) -> int:
    return x - (x >> 63 << 64)


@pytest.mark.parametrize("tile", [2048, 16])
def test_links_find_every_close_pair(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng, pool = random.Random(1), set()
    for _ in range(15):
        center = rng.getrandbits(64)
        for _ in range(80):
            x = center
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            pool.add(x)
    pool = sorted(pool)
    want = Sets(pool)
    for i, a in enumerate(pool):
        for b in pool[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                want.join(a, b)
    fps = spark.createDataFrame([(_signed(x),) for x in pool], "_fp long")
    found = simhash.links(fps).collect()
    got = Sets(pool)
    for r in found:
        got.join(r[0] % 2**64, r[1] % 2**64)
    assert {x: got.find(x) for x in pool} == {x: want.find(x) for x in pool}


def test_anchors_cover():
    """Halves one bit apart: each is at the other's home."""
    rng = np.random.default_rng(2)
    half = rng.integers(0, 2**32, 300)
    other = half ^ (1 << rng.integers(0, 32, 300))
    home = {int(r): int(a) for rows, at, is_home in simhash.anchors(half) if is_home for r, a in zip(rows, at)}
    seen = defaultdict(set)
    for rows, at, _ in simhash.anchors(other):
        for r, a in zip(rows, at):
            seen[int(r)].add(int(a))
            assert (int(a) ^ int(other[r])).bit_count() <= 2
    assert all(home[i] in seen[i] for i in range(300)) and max(map(len, seen.values())) <= 17


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7)], "_u long, _v long")
    got = {(r[0], r[1]) for r in simhash.components(edges).collect()}
    assert got == {(i, 0) for i in range(1, 61)} | {(101, 100)}


# near copies of the pipeline


def _five(text) -> frozenset:
    w = odd.words(odd.lowered(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _near_groups(texts: list) -> Sets:
    sets, own = Sets(range(len(texts))), [_five(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if own[i] == own[j] or 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
                sets.join(i, j)
    return sets


@pytest.mark.parametrize("tile", [2048, 3])
def test_pipeline_near_copies_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(31)
    texts = ["", None, " ", "one two", "One  two", "one two three"]
    for _ in range(12):  # a base and copies with 0 to 12 words of 300 changed, around similarity 0.8
        base = [f"w{rng.randrange(3000)}" for _ in range(300)]
        for changed in (0, 1, 3, 5, 6, 7, 8, 12):
            copy = list(base)
            for k in rng.sample(range(300), changed):
                copy[k] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    chain = [f"c{i}" for i in range(400)]  # each is near the next, the ends are not near each other
    texts += [" ".join(chain[k : k + 200]) for k in range(0, 200, 15)]
    rng.shuffle(texts)
    sets = _near_groups(texts)
    want = sorted(i for i in range(len(texts)) if sets.find(i) == i)
    got = corpus_pipeline.near_dedup(spark, odd.plain(spark, texts), "")
    assert sorted(r.doc_id for r in got.collect()) == want


def test_pipeline_near_copies_by_fingerprints_alone(spark, monkeypatch):
    """Fingerprints within three bits make candidates, also where no band would; the similarity decides."""
    monkeypatch.setattr(jaccard, "bands", lambda own: np.zeros(0, np.uint64))
    rng, texts = random.Random(5), ["", None, "one"]
    for _ in range(6):
        base = [f"w{rng.randrange(3000)}" for _ in range(1000)]
        texts += [" ".join(base), " ".join([*base, "more"]), " ".join([*base, *base])]
    own = [_five(t) for t in texts]
    bits = [simhash.majority(np.array([xxhash.xxh64_intdigest(" ".join(s), 42) for s in x], np.uint64)) for x in own]
    sets = Sets(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            close = own[i] and own[j] and (bits[i] ^ bits[j]).bit_count() <= 3
            if own[i] == own[j] or close and 5 * len(own[i] & own[j]) >= 4 * len(own[i] | own[j]):
                sets.join(i, j)
    want = [i for i in range(len(texts)) if sets.find(i) == i]
    assert len(want) <= 10
    got = corpus_pipeline.near_dedup(spark, odd.plain(spark, texts), "")
    assert sorted(r.doc_id for r in got.collect()) == want


def test_jaccard_odd_table(spark):
    got = jaccard.near_copies(odd.table(spark)).collect()
    assert sorted(_key(r.doc_id) for r in got) == sorted(_key(r[0]) for r in odd.rows())
    assert jaccard.one_of_each(odd.table(spark)).columns == odd.table(spark).columns
    assert jaccard.near_copies(odd.empty(spark)).count() == 0


# sharding


def _check_shards(rows, texts: list[tuple], shards: int) -> None:
    counts, slots = Counter(r.shard for r in rows), defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    held = [counts.get(s, 0) for s in range(shards)]
    assert max(held) - min(held) <= 1 and sum(held) == len(texts)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((_key(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((_key(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def _cut(rows, which: str) -> int:
    """Links of a star per group of equal texts that lie between shards."""
    groups = defaultdict(list)
    for r in rows:
        groups[r.text_crc32, r.size].append(r[which])
    return sum(len(v) - max(Counter(v).values()) for v in groups.values())


def test_sharding_odd_table(spark):
    _check_shards(sharding.shards_of(odd.table(spark), 5).collect(), [(r[0], r[1]) for r in odd.rows()], 5)
    _check_shards(sharding.shards_of(odd.table(spark)).collect(), [(r[0], r[1]) for r in odd.rows()], 24)
    assert sharding.shards_of(odd.empty(spark)).count() == 0


def test_sharding_keeps_linked_documents_together(spark):
    rng = random.Random(8)
    texts = [f"group {i // 3}" for i in range(300)] + ["hot"] * 500 + [odd.prose(rng, 6) + str(i) for i in range(700)]
    rows = sharding.shards_of(odd.plain(spark, texts), 6).collect()
    _check_shards(rows, list(enumerate(texts)), 6)
    hot = Counter(r.shard for r in rows if r.linked == 500)
    assert sum(n for _, n in hot.most_common(2)) > 400  # two shards hold 500 documents
    small = [r for r in rows if r.linked == 3]
    assert _cut(small, "shard") <= 0.1 * _cut(small, "start_shard")


def test_sharding_gathers_a_group_of_many_shards(spark):
    rng = random.Random(9)
    texts = ["hot"] * 2400 + [f"pair {i // 2}" for i in range(1200)] + [odd.prose(rng, 6) + str(i) for i in range(3600)]
    rows = sharding.shards_of(odd.plain(spark, texts), 24).collect()
    _check_shards(rows, list(enumerate(texts)), 24)
    hot = Counter(r.shard for r in rows if r.linked == 2400)  # 300 documents a shard
    assert sum(n for _, n in hot.most_common(8)) > 0.8 * 2400
    pairs = [r for r in rows if r.linked == 2]
    assert _cut(pairs, "shard") <= 0.1 * _cut(pairs, "start_shard")


# line dedup


def _edits(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _near(v: tuple, w: tuple) -> bool:
    """One word apart, or, of lines of fewer than eight words and at least 16 characters, one character."""
    if len(v) >= 8 and len(w) >= 8:
        return abs(len(v) - len(w)) <= 1 and _edits(list(v), list(w)) <= 1
    a, b = " ".join(v), " ".join(w)
    return max(len(v), len(w)) < 8 and min(len(a), len(b)) >= 16 and abs(len(a) - len(b)) <= 1 and _edits(list(a), list(b)) <= 1


def plain_lines(rows: list[tuple]) -> dict:
    """(id, text, line) → the earliest place of an equal or near line; rows are (id, text)."""
    found = []
    for i, t in sorted(set(rows), key=lambda r: _key(r[0])):
        for n, line in enumerate((t or "").split("\n")):
            w = tuple(odd.words(odd.lowered(line)))
            if w:
                found.append((_key(i), n, t, w))
    out = {}
    for i, n, t, w in found:
        equal = min((j, m) for j, m, _, v in found if v == w)
        best = equal
        if equal == (i, n):
            for j, m, _, v in found:
                if (j, m) < best and _near(v, w):
                    best = (j, m)
        out[i, t, n] = best
    return out


def _distinct_ids() -> list[tuple]:
    seen, out = set(), []
    for r in odd.rows():
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def test_line_dedup_odd_table(spark):
    rows = [(*r[:1], r[1] if len(r[1] or "") < 20_000 else r[1][:3000], *r[2:]) for r in _distinct_ids()]
    docs = spark.createDataFrame(rows, odd.SCHEMA).repartition(3)
    want = plain_lines([(r[0], r[1]) for r in rows])
    got = {(_key(r.doc_id), r.line_no): (r.removed, (_key(r.of_id), r.of_line)) for r in line_dedup.repeated_lines(docs).collect()}
    assert got == {(i, n): (best < (i, n), best) for (i, _, n), best in want.items()}
    assert sum(x for x, _ in got.values()) > 10
    kept = line_dedup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    for r in kept.collect():
        text = next(t[1] for t in rows if t[0] == r.doc_id)
        left = [x for n, x in enumerate((text or "").split("\n")) if not got.get((_key(r.doc_id), n), (False,))[0]]
        assert (r.text or "") == "\n".join(left) and (r.text is None) == (text is None)
    assert line_dedup.repeated_lines(odd.empty(spark)).count() == 0


def test_rows_that_share_an_id(spark):
    """Texts of one id come in order; the second of two equal rows repeats the first."""
    line, other = "a b c d e f g h i j", "k l m n"
    docs = spark.createDataFrame([(4, line), (4, line), (4, other + "\n" + line), (2, None)], "doc_id long, text string")
    got = sorted((r.line_no, r.n_words, r.removed, r.of_id, r.of_line) for r in line_dedup.repeated_lines(docs).collect())
    assert got == [(0, 4, False, 4, 0), (0, 10, False, 4, 0), (0, 10, True, 4, 0), (1, 10, True, 4, 0)]
    assert sorted(str(r.text) for r in line_dedup.drop_repeated_lines(docs).collect()) == sorted(["None", line, "", other])
    places = line_dedup.repeated_lines(odd.table(spark)).count()
    assert places == sum(len(odd.words(x)) > 0 for r in odd.rows() for x in (r[1] or "").split("\n"))


def test_short_lines_and_scripts_without_spaces(spark):
    """No line is too short to be judged; one character counts where one word is too much or cannot be told."""
    script = "今天的天气非常好我们一起去公园散步吧明天见"
    texts = [
        f"Read more\nAdvertisement\n{script}\nsubscribe to our newsletter\na b c d e f g h",
        f"ADVERTISEMENT\nread  more\n{script}\nsubscribe to our newsletters\na b c d e f g",
        f"Read mode\n{script[:9]}{script[10:]}\nsubscribe to your newsletter\nsubscribe to his newsletter\na b c d e f g x",
        f"{script[:5]}山{script[6:]}\nread more\n\n \nx",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = odd.plain(spark, texts)
    want = {(i, n): best for (i, _, n), best in plain_lines(rows).items()}
    got = {(r.doc_id, r.line_no): (r.of_id, r.of_line) for r in line_dedup.repeated_lines(docs, block_mb=0.00001, part_mb=0.00001).collect()}
    assert got == want
    kept = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert kept[1] == "a b c d e f g"  # seven words: another kind, and under 16 characters
    assert kept[2] == "Read mode\nsubscribe to his newsletter"
    assert kept[3] == "\n \nx"


def test_small_blocks_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = line_dedup.repeated_lines(docs).collect()
    assert sorted(line_dedup.repeated_lines(docs, block_mb=0.01, part_mb=0.01).collect()) == sorted(once)


def test_variants_are_deletions():
    rng = random.Random(3)
    for n in (1, 2, 9, 40):
        w = [odd.prose(rng, 1) for _ in range(n)]
        v1, v2 = line_dedup.variants(w)
        for i in range(n):
            if n > 1:
                a, b = line_dedup.variants(w[:i] + w[i + 1 :])
                assert (int(v1[i + 1]), int(v2[i + 1])) == (int(a[0]), int(b[0]))


def test_within_one_is_edit_distance():
    rng = random.Random(6)
    for _ in range(3000):
        a = [rng.choice("xy") for _ in range(rng.randint(0, 6))]
        b = [rng.choice("xy") for _ in range(rng.randint(0, 6))]
        assert line_dedup.within_one(a, b) == (_edits(a, b) <= 1)


# quality rules


def plain_quality(rows: list[tuple], min_docs: int, share: float) -> dict:
    """(id, text, host) → counts and verdict; rows are (id, text, host)."""
    docs, held = defaultdict(set), defaultdict(set)
    norm = lambda line: " ".join(odd.words(odd.lowered(line)))
    for _, t, host in rows:
        held[host].add(t or "")
        for line in (t or "").split("\n"):
            docs[host, norm(line)].add(t or "")
    often = {k for k, v in docs.items() if k[1] and len(v) > min_docs and len(v) > share * len(held[k[0]])}
    out = {}
    for i, t, host in rows:
        text = t or ""
        w = odd.words(text)
        lines = [x for x in text.split("\n") if odd.words(x)]
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        rep = {p for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lost = sum(len(odd.words(x)) for x in lines if (host, norm(x)) in often)
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        counts = (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(rep))
        left = "\n".join(x for x in text.split("\n") if (host, norm(x)) not in often)
        out[_key(i), text, host] = (*counts, failed, not failed and 2 * (len(w) - lost) >= len(w), lost, left)
    return out


@pytest.mark.parametrize("limits", [(10, 0.001), (0, 0.2)])
def test_quality_odd_table(spark, limits):
    docs, rows = odd.table(spark), odd.rows()
    want = plain_quality([(r[0], r[1], r[3]) for r in rows], *limits)
    got = quality.verdicts(docs, min_docs=limits[0], max_share=limits[1]).drop("_host", "_text", "_removed").collect()
    each = [want[_key(r[0]), r[1] or "", r[3]] for r in rows]
    assert Counter(tuple(r)[1:] for r in got) == Counter(w[:8] for w in each)
    kept = quality.keep_good(docs, min_docs=limits[0], max_share=limits[1])
    assert kept.columns == docs.columns
    left = Counter((_key(r[0]), w[8]) for r, w in zip(rows, each) if w[6])
    assert Counter((_key(r.doc_id), r.text) for r in kept.collect()) == left and left
    assert quality.verdicts(odd.empty(spark)).count() == 0


def test_boilerplate_goes_and_depleted_documents_too(spark):
    rng = random.Random(12)
    line = odd.prose(rng, 40)
    texts = [f"{odd.prose(rng, 55)}\n{line}" for _ in range(15)] + [f"{odd.prose(rng, 12)}\n{line}" for _ in range(15)]
    texts += [odd.prose(rng, 60)] * 30  # copies are no boilerplate
    kept = {r.doc_id: r.text for r in quality.keep_good(odd.plain(spark, texts)).collect()}
    assert set(kept) == set(range(15)) | set(range(30, 60))
    assert all(kept[i] == texts[i].split("\n")[0] for i in range(15)) and kept[30] == texts[30]


# substring dedup


def plain_repeats(rows: list[tuple], window: int = 20) -> list[list[bool]]:
    """For each (id, text), in the given order, the words that go."""
    order = sorted(range(len(rows)), key=lambda k: (_key(rows[k][0]), (rows[k][1] or "").encode()))
    seen, out = set(), [[] for _ in rows]
    for k in order:
        w = odd.words(rows[k][1])
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            x = tuple(w[i : i + window])
            if x in seen:
                gone[i : i + window] = [True] * window
            seen.add(x)
        out[k] = gone
    return out


@pytest.mark.parametrize("block_mb", [8.0, 0.02])
def test_substrings_odd_table(spark, block_mb):
    docs, rows = odd.table(spark), odd.rows()
    plain = plain_repeats([(r[0], r[1]) for r in rows])
    kept = [" ".join(w for w, g in zip(odd.words(r[1]), x) if not g) for r, x in zip(rows, plain)]
    got = substring_dedup.remove_repeats(docs, block_mb=block_mb, part_mb=block_mb).collect()
    want = Counter((_key(r[0]), len(x), sum(x), k) for r, x, k in zip(rows, plain, kept))
    assert Counter((_key(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in got)
    assert any(r.n_removed >= 45 for r in got)
    laid = substring_dedup.remove_repeats(docs, layout=True, carry=("a.b", "source"), block_mb=block_mb, part_mb=block_mb)
    assert laid.columns[-2:] == ["a.b", "source"]
    texts = {(_key(r[0]), r[7]): (r[1] or "", k, sum(x)) for r, x, k in zip(rows, plain, kept)}
    for r in laid.collect():
        text, k, n = texts[_key(r.doc_id), r["a.b"]]
        assert " ".join(odd.words(r.kept_text)) == k and (n or r.kept_text == text)
    assert substring_dedup.remove_repeats(odd.empty(spark)).count() == 0


def test_substring_digest(spark):
    got = substring_dedup.op9_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    plain = plain_repeats(rows)
    want = {i: hashlib.sha256(" ".join(w for w, g in zip(odd.words(t), x) if not g).encode()).hexdigest() for (i, t), x in zip(rows, plain)}
    assert {r.doc_id: r.kept_sha256 for r in got} == want


def test_a_verdict_holds_for_its_host_only(spark):
    """One id and text under two hosts: where most of its lines are boilerplate it goes, under the other it stays whole."""
    rng = random.Random(4)
    common = [odd.prose(rng, 30) for _ in range(3)]
    shared = "\n".join([*common, odd.prose(rng, 20)])
    rows = [(100 + i, "\n".join([*common, odd.prose(rng, 120)]), "en", "a", 1) for i in range(12)]
    rows += [(7, shared, "en", "a", 1), (7, shared, "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.source, r.text) for r in quality.keep_good(df).where("doc_id = 7").collect()]
    assert kept == [("b", shared)]
