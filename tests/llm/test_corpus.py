"""Operators over whole collections against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedhour.llm import mixing, near_duplicates, neighbours, queries, repeats, urls
from bedhour.llm.components import components

SPACES = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# Near duplicates


def shingle_set(text, size):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_brute_force(odd, documents, size):
    for docs in (odd, documents):
        rows = [(r.doc_id, shingle_set(r.text, size)) for r in docs.collect()]
        groups = Groups()
        for i, (a, x) in enumerate(rows):
            for b, y in rows[i + 1 :]:
                if x and y and a is not None and b is not None and 100 * len(x & y) >= 80 * len(x | y):
                    groups.join(a, b)
        got = near_duplicates.near_duplicates(docs, size).collect()
        expected = Counter()
        for doc_id, x in rows:
            root = None if doc_id is None else groups.find(doc_id)
            expected[(doc_id, len(x), root, doc_id == root)] += 1
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == expected


def test_chains_and_buckets_of_several_components(spark):
    """Many near copies of one text that drift apart, so that buckets hold
    documents which the smallest one is not linked with."""
    r = random.Random(4)
    text = [f"w{r.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        for _ in range(2):
            text[r.randrange(120)] = f"w{r.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = Groups()
    sets = [shingle_set(t, 2) for _, t in rows]
    for i in range(60):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                groups.join(i, j)
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(docs, 2).collect()}
    assert got == {i: groups.find(i) for i in range(60)}


@pytest.mark.parametrize("block", [8, 16, 2000])
def test_blocks_compare_all_members(spark, block):
    """One bucket of many components: the links found join what brute force joins."""
    r = np.random.default_rng(2)
    base = r.integers(0, 2**62, 60).astype(np.uint64)
    sets = []
    for _ in range(90):
        own = base.copy()
        n = int(r.choice([2, 4, 8, 30]))
        own[r.choice(60, n, replace=False)] = r.integers(0, 2**62, n).astype(np.uint64)
        sets.append(np.unique(own))
    rows, groups = [], Groups()
    for i, x in enumerate(sets):
        least = near_duplicates.minima(x)
        keys = np.arange(near_duplicates.BANDS, dtype=np.int64) * 1000 + i
        keys[3] = 7  # the only band all share
        packed = (least & 255).astype(np.uint8).tobytes() + keys.tobytes()
        rows.append((7, i, i // 3, bytearray(packed), bytearray(x.tobytes())))
        groups.join(i, 3 * (i // 3))
    members = spark.createDataFrame(rows, "key long, node long, root long, packed binary, shingles binary")
    joined = Groups(groups)
    for i in range(90):
        for j in range(i):
            if near_duplicates.similar(sets[i], sets[j], 80):
                joined.join(i, j)
    found = near_duplicates.links_across(members, 0.5, 80, block).collect()
    assert len({groups.find(i) for i in range(90)}) > len({joined.find(i) for i in range(90)}) > 1
    for u, v in found:
        assert near_duplicates.similar(sets[u], sets[v], 80)
        groups.join(u, v)
    assert [groups.find(i) for i in range(90)] == [joined.find(i) for i in range(90)]


def test_one_document_of_each_group_stays(odd, no_rows):
    kept = near_duplicates.keep_one(odd, 5)
    assert kept.columns == odd.columns
    verdicts = near_duplicates.near_duplicates(odd, 5).collect()
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == {r.doc_id for r in verdicts if r.kept}
    assert all(n == 1 for i, n in ids.items() if i is not None)
    assert near_duplicates.keep_one(no_rows).count() == 0
    assert near_duplicates.near_duplicates(no_rows).count() == 0


def test_rows_of_one_id_and_names_that_clash(spark):
    rows = [(1, "one two three four five six", 77, 5), (1, "one two three four five six", 77, 6), (1, "another text of the same id", 77, 7),
            (2, "something quite different from the rest", 77, 8), (None, "one two three four five six", 77, 9), (None, None, 77, 9), (3, None, 77, 1), (3, None, 77, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _nth int, _gone int").withColumn("_row", F.lit(1)).withColumn("_again", F.lit(2))
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns and {r._nth for r in kept.collect()} == {77}
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter({(i, t): 1 for i, t, *_ in rows})


def test_components(spark):
    r = random.Random(8)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    pairs += [(900, i) for i in range(901, 990)]
    groups = Groups()
    for a, b in pairs:
        groups.join(a, b)
    got = {r.u: r.v for r in components(spark.createDataFrame(pairs, "a long, b long")).df.collect()}
    assert got == {x: groups.find(x) for x in groups if groups.find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).df.count() == 0


# Urls


def test_urls_of_nothing_and_very_long_ones(spark):
    long = "a" * 300_000
    rows = [(1, f"http://{long}.example.com/de/{long}"), (2, f"https://{long}.org/x?{long}"), (3, f"{long}://spam.org/{long}#"), (4, long)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("spam.org",)], "host string")
    got = {r.page_id: r for r in urls.judge_urls(pages, listed).collect()}
    assert [got[i].verdict for i in (1, 2, 3, 4)] == ["block", "allow", "block", "allow"]
    assert (got[1].rule, len(got[1].host), len(got[1].path), got[3].path) == ("example.com/de/", 300_012, 300_004, f"/{long}")
    assert urls.judge_urls(pages.limit(0), listed).count() == 0
    assert urls.judge_urls(pages, listed.limit(0)).where("verdict = 'block'").count() == 1


def test_urls_against_brute_force(spark):
    given = [
        "http://A.Example.COM/de/x?y#z", "https://m.example.net/en/1", "http://example.net/fr/", "ftp://net/x", "https://x.org/fr/a",
        "https://x.org/en", "nothing", "", None, "http://badexample.net/en/", "http://spam.org/q", "http://spam.org/fr/q", "a://b://c/d",
        "http://notspam.example.com", "HTTP://x.com?/a", "http://spam.org/q", "http://casino.de\n/x",
    ]
    pages = spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(given)] + [(None, None, None, None)],
                                  "page_id long, url string, host string, verdict string")
    listed = spark.createDataFrame([("spam.org",), ("casino.de\n",), ("not-in-corpus",)], "host string")
    got = {r.page_id: r for r in urls.judge_urls(pages, listed).collect()}
    for i, url in [*enumerate(given), (None, None)]:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fits = [
            (len(h), len(p), h + p, v)
            for h, p, v in urls.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule, verdict = max(fits)[2:] if fits else (None, "block" if host in ("spam.org", "casino.de\n") else "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)


@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 0.97, 1.0])
def test_cascade_is_exact(spark, share):
    keys = np.random.default_rng(6).integers(-(2**62), 2**62, 4000)
    universe = spark.createDataFrame([(int(k),) for k in keys], "key long")
    n = int(len(keys) * share)
    levels = urls.cascade(universe.union(universe), universe.limit(0) if not n else spark.createDataFrame([(int(k),) for k in keys[:n]], "key long"))
    found = urls.member(levels, keys.astype(np.int64).view(np.uint64))
    assert found[:n].all() and not found[n:].any()


def test_cascade_has_a_size_limit(spark):
    universe = spark.range(5000).select(F.xxhash64("id").alias("key"))
    with pytest.raises(ValueError, match="split the list"):
        urls.cascade(universe, universe.where("key > 0"), most_bytes=100)


# Mixing


def targets(sizes, weights, epochs=3):
    """Rounds of sharing until none is above its cap."""
    total = float(sum(sizes.values()))
    capped = {}
    while True:
        open_ = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] >= epochs * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: float(epochs * sizes[s]) for s in above}


def test_mixing(odd, documents, no_rows):
    for docs in (odd, documents):
        rows = docs.collect()
        sizes = defaultdict(int)
        for r in rows:
            sizes[r.source] += len(words(r.text))
        names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
        expected = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
        got = mixing.mix(docs).collect()
        assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter(
            (r.doc_id, len(words(r.text)), sizes[r.source]) for r in rows
        )
        taken, largest = Counter(), Counter()
        for r in got:
            source = r.row.source
            assert r.target == pytest.approx(expected[source])
            assert 0 <= r.copies <= 3
            taken[source] += r.copies * r.size
            largest[source] = max(largest[source], r.size)
        for source in names:
            assert abs(taken[source] - expected[source]) <= 2 * largest[source]
        again = Counter((r.doc_id, r.size, r.copies) for r in mixing.mix(docs.repartition(5)).collect())
        assert again == Counter((r.doc_id, r.size, r.copies) for r in got)
        copies = mixing.copies(docs)
        assert copies.columns == docs.columns
        assert copies.count() == sum(r.copies for r in got)
    assert mixing.mix(no_rows).count() == 0
    assert mixing.copies(no_rows).count() == 0


# Neighbours


def brute_nearest(vectors, k):
    ids = np.array(list(vectors))
    points = np.array([vectors[i] for i in ids])
    out = {}
    for i, v in vectors.items():
        if i % 20 == 0:
            scores = points @ np.array(v)
            out[i] = sorted((-round(s, 9), j) for s, j in zip(scores, ids.tolist(), strict=True) if j != i)[:k]
    return out


def test_nearest_is_exact_with_factor_one(spark):
    r = np.random.default_rng(9)
    vectors = {i: r.normal(size=6).tolist() for i in range(700)}
    for i in range(100, 400):
        vectors[i] = vectors[100]  # one very common vector
    odd = [(None, vectors[0]), (1001, None), (1002, []), (1003, [0.0] * 6), (1004, [None] * 6), (1005, [float("nan")] * 6),
           (1006, [float("inf")] * 6), (1007, [1.0, 2.0]), (0, vectors[0])]
    rows = spark.createDataFrame([(i, v, "x") for i, v in [*vectors.items(), *odd]], "vec_id long, embedding array<double>, rank string")
    got = neighbours.nearest(rows, rows.where("vec_id % 20 = 0"), 20, factor=1.0, shard_rows=200, block_rows=10).collect()
    expected = brute_nearest(vectors, 20)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        assert r["rank"] == len(found[r.query_id]) + 1
        found[r.query_id].append((-round(r.score, 9), r.vec_id))
    assert found == expected


def test_nearest_of_few_or_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], kind)
    got = neighbours.nearest(few, few.where("vec_id = 0"), 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.nearest(few.limit(0), few, 20).count() == 0
    assert neighbours.nearest(few, few.limit(0), 20).count() == 0


def test_recall_of_the_query(spark):
    got = defaultdict(set)
    for r in queries.op7_neighbours(spark, "/root/testdata/sf0.01").collect():
        got[r.query_id].add(r.vec_id)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    expected = brute_nearest({r.vec_id: r.embedding for r in table}, 20)
    assert got.keys() == expected.keys()
    assert np.mean([len(got[i] & {j for _, j in e}) / len(e) for i, e in expected.items()]) >= 0.95


# Repeats


def brute_repeats(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in raw for i in range(len(d) - length + 1))
    out = []
    for d in raw:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(d)]
        left = bytes(np.frombuffer(d, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(d) else 0
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("most_members", [repeats.MOST_MEMBERS, 2])
def test_repeats_against_brute_force(odd, documents, most_members):
    for docs in (odd, documents):
        rows = docs.collect()
        expected = Counter((r.doc_id, *b) for r, b in zip(rows, brute_repeats([r.text for r in rows]), strict=True))
        got = repeats.remove_repeats(docs, 200, most_members).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_short_repeats_of_few_letters(spark):
    """Every kind of overlap: texts of two letters and short windows."""
    r = random.Random(3)
    texts = ["".join(r.choice("ab") for _ in range(r.randrange(0, 90))) for _ in range(60)] + ["ab" * 60, "a" * 100]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = {i: b for i, b in enumerate(brute_repeats(texts, 40))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs, 40).collect()}
    assert got == expected


def test_maximal_repeats_of_one_anchor():
    gram = b"g" * repeats.GRAM
    members = [(3, b"xyz" + gram + b"12345"), (3, b"ayz" + gram + b"12399"), (2, b"qz" + gram + b"12345")]
    assert repeats.maximal_repeats(members, repeats.GRAM + 5) == [(2, repeats.GRAM + 5), (2, repeats.GRAM + 3), (1, repeats.GRAM + 5)]


def test_repeats_of_no_rows(no_rows):
    assert repeats.remove_repeats(no_rows).count() == 0
