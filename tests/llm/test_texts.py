"""Operators on single texts against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from bedhour.llm import counts, licenses, packing, quality, queries, secrets

SPACES = "[\x20\x09-\x0d]+"


def words(text):
    return [w for w in re.split(SPACES, text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def by_row(rows, columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


# Packing


def check_pieces(rows, pieces, capacity=2048):
    made = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    expected = Counter()
    ids = {}
    for doc_id, text, *_ in rows:
        n = made.encode(text or "", add_special_tokens=False).ids + [1]
        ids.setdefault(doc_id, []).append(n)
        expected[doc_id] += len(n)
    found = Counter()
    for p in pieces:
        found[p.doc_id] += p.length
        assert any(
            len(x) == p.doc_tokens
            and zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32
            for x in ids[p.doc_id]
        )
    assert found == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end and n > 0
            end += n
        assert end <= capacity and (end == capacity or end & (end - 1) == 0)


def test_pieces_hold_every_id_once(odd):
    rows = odd.collect()
    check_pieces(rows, packing.pack(odd, queries.tokenizer_definition()).collect())
    check_pieces(rows, packing.pack(odd, queries.tokenizer_definition(), group_tokens=500).collect())


def test_pieces_of_documents(documents):
    check_pieces(documents.collect(), packing.pack(documents, queries.tokenizer_definition()).collect())


def test_cost_is_balanced():
    costs = packing.Costs()
    lengths = [900, 800, 700, 600, 500, 400, 300, 200, 100, 96, 50, 4] * 20
    pieces = packing.pack_group(lengths, 2048, costs)
    total = Counter()
    for _, _, n, sequence, _ in pieces:
        total[sequence] += costs.of(n)
    full = [c for s, c in total.items() if sum(p[2] for p in pieces if p[3] == s) == 2048]
    assert max(full) < 1.25 * min(full)


def test_no_rows(no_rows):
    definition = queries.tokenizer_definition()
    assert packing.pack(no_rows, definition).count() == 0
    assert counts.token_counts(no_rows, [("▁a", -1.0)]).count() == 0
    assert licenses.license_digest(licenses.scan_licenses(no_rows)).count() == 0
    assert quality.judge(no_rows).count() == 0
    assert quality.keep_good(no_rows).count() == 0
    assert secrets.find_secrets(no_rows).count() == 0
    assert secrets.redact(no_rows).count() == 0


# Token counts


@pytest.fixture(scope="module")
def pieces():
    return counts.model_pieces(queries.tokenizer_file("piece_bpe_32k.model"))


def test_token_counts_equal_the_unigram_tokenizer(odd, pieces):
    with_unknown = [("<unk>", min(s for _, s in pieces)), *pieces]
    made = Tokenizer(models.Unigram(with_unknown, 0, False))
    got = counts.token_counts(odd, pieces, byte_fallback=False).collect()
    expected = Counter(
        (r.doc_id, len(words(r.text)), sum(len(made.encode("▁" + w).ids) for w in words(r.text))) for r in odd.collect()
    )
    assert by_row(got, ("doc_id", "n_words", "n_tokens")) == expected


def test_ties_and_unknown_letters():
    # Two ways of equal sum: the piece that starts first stays.
    made = counts.Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)], True)
    reference = Tokenizer(models.Unigram([("<unk>", -2.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0)], 0, False))
    for word in ("ab", "aab", "abab", "ba"):
        assert made.count("▁" + word) == made.counts([word.encode()])[0] == len(reference.encode("▁" + word).ids)
    # The mark, then an unknown letter of three bytes.
    assert made.count("▁漢") == 1 + 3
    assert counts.Counter([("▁", -1.0)], False).count("▁漢漢") == 2


# Licences


def test_base_phrases_against_brute_force(odd, documents):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for docs in (odd, documents):
        got = licenses.license_digest(licenses.scan_licenses(docs)).collect()
        expected = Counter()
        for r in docs.collect():
            w = word.findall(lower(r.text))
            places = [
                (i, label)
                for phrase, label in licenses.BASE_PHRASES.items()
                for i in range(len(w))
                if w[i : i + len(phrase.split())] == phrase.split()
            ]
            starts = [i for i, _ in places]
            expected[
                (r.doc_id, len(w), len(places), min(starts, default=None), max(starts, default=None),
                 ",".join(sorted({label for _, label in places})))
            ] += 1
        assert by_row(got, ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == expected
        for r in got:
            assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
            assert 0.0 <= r.score <= 1.0


def test_headers_need_their_phrase(spark):
    texts = [
        "licensed under the apache license version 2 0",
        "Licensed, under the Apache-License (version 2.0) now",
        "licensed under the apache server version 2 0",  # high cover, no key phrase
        "apache license",  # key phrase, low cover
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_digest(licenses.scan_licenses(docs)).collect()}
    assert got == {0: "apache-2.0", 1: "apache-2.0", 2: "", 3: ""}


def test_headers_lacking_a_word_are_found_whatever_the_corpus_holds(spark):
    texts = [
        "Licensed under the Apache License, Version 1.0",
        "Licensed under CC BY-NC 3.0",
        "Redistribution and use in source and binary forms, with or without modification, are allowed",
        "licensed under the cc by",
    ]
    expected = {0: "apache-2.0", 1: "cc-by,cc-by-nc", 2: "bsd", 3: "cc-by"}
    for more in ([], ["version 2 0 and 4 0 are permitted"], ["apache"] * 9 + ["by nc source"] * 9):
        docs = spark.createDataFrame(list(enumerate(texts + more)), "doc_id long, text string")
        got = {r.doc_id: r.labels for r in licenses.license_digest(licenses.scan_licenses(docs)).collect()}
        assert {i: got[i] for i in expected} == expected


def test_templates_without_phrases_against_brute_force(spark):
    header = "a b c d e a b f g h".split()
    found = licenses.templates({}, ((" ".join(header), (), "x"),))
    r = np.random.default_rng(4)
    texts = []
    for _ in range(60):
        w = list(header)
        for at in r.choice(10, r.integers(0, 5), replace=False):
            w[at] = str(r.choice(list("abcdz")))
        texts.append(["z"] * int(r.integers(3)) + w)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in licenses.scan_licenses(docs, found).collect():
        w = texts[row.doc_id]
        covers = {s: sum(0 <= s + i < len(w) and w[s + i] == h for i, h in enumerate(header)) for s in range(-9, len(w))}
        assert sorted((m["first"], m["cover"]) for m in row.matches) == [(s, n / 10) for s, n in covers.items() if n >= 8]


# Quality


def rule_figures(text):
    text = text or ""
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    repeated = set()
    for i in range(len(w) - 2):
        if grams[tuple(w[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(repeated)


def test_rules_against_brute_force(odd, documents):
    for docs in (odd, documents):
        got = quality.judge(docs).collect()
        expected = Counter()
        for r in docs.collect():
            figures = rule_figures(r.text)
            expected[(r.doc_id, *figures, figures[0] < 50 or 100 * figures[4] > 50 * figures[0])] += 1
        assert by_row(got, ("doc_id", *quality.FIGURES, "base_failed")) == expected
        assert not any(r.kept and r.base_failed for r in got)


@pytest.mark.parametrize("own", [True, False])
def test_perplexity_against_brute_force(spark, own):
    size = quality.ORDER
    texts = ["abracadabra abracadabra", "abcabcabd", "", None, "xyz", "ABRA cadabra " * 5, "abracadabra abracadabra", "cadabr"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    data = [lower(t).encode() for t in texts]
    tables = [Counter(g for d in data for g in {d[i : i + size] for i in range(len(d) - size + 1)})]
    for n in range(size - 1, 0, -1):
        tables.append(Counter(g[-n:] for g in tables[-1]))

    def discounts(table):
        n1, n2, n3, n4 = (sum(c == i for c in table.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        limits = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
        return [min(max(k - (k + 1) * y * b / a if a else k * y, 0.0), k) for k, a, b in limits]

    cuts = [discounts(t) for t in tables]

    def chance(gram, gone):
        """``gone`` is 1 where the count rests on the text that is left out."""
        if not gram:
            return 1 / 256
        table, cut = tables[size - len(gram)], cuts[size - len(gram)]
        d = lambda c: cut[min(c, 3) - 1] if c > 0 else 0.0
        near = {g: c - gone * (g == gram) for g, c in table.items() if g[:-1] == gram[:-1]}
        total = sum(near.values())
        c = near.get(gram, 0)
        below = chance(gram[1:], gone if c <= 0 else 0)
        if total <= 0:
            return below
        weight = min(max(sum(map(d, near.values())) / total, 1e-6), 1.0)
        return (c - d(c)) / total + weight * below

    got = {r.doc_id: r.log2_perplexity for r in quality.score(docs, quality.train(docs), own).collect()}
    for i, d in enumerate(data):
        if len(d) < size:
            assert got[i] is None
        else:
            bits = [-np.log2(max(chance(d[j : j + size], int(own)), 1e-9)) for j in range(len(d) - size + 1)]
            assert got[i] == pytest.approx(np.mean(bits), rel=1e-3)


def test_texts_are_counted_once_per_gram():
    r = np.random.default_rng(2)
    texts = ["".join(r.choice(list("ab"), 12)) for _ in range(500)]
    data, starts = quality.text_bytes(pa.array(texts))
    grams, n = quality._texts_per_gram(data, starts)
    want = Counter(g for t in texts for g in {t[i : i + quality.ORDER] for i in range(12 - quality.ORDER + 1)})
    assert dict(zip(grams.tolist(), n.tolist(), strict=True)) == {int.from_bytes(g.encode(), "big"): c for g, c in want.items()}
    many = quality.text_bytes(pa.array(["", "xyzxyzxyz"] * 40_000))
    grams, n = quality._texts_per_gram(*many)
    assert n.tolist() == [40_000] * 3


def test_extra_columns_do_not_clash(spark, documents):
    wide = documents.limit(60).withColumn("_rejected", F.lit(1)).withColumn("_rejected_", F.lit(2))
    assert quality.keep_good(wide).columns == wide.columns


def test_kept_rows_keep_their_columns(odd):
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    good = by_row(quality.judge(odd).where("kept").collect(), ("doc_id",))
    assert by_row(kept.collect(), ("doc_id",)) == good


def test_documents_that_are_noise_leave_the_band(spark, documents):
    r = np.random.default_rng(3)
    noise = ["".join(map(chr, r.integers(33, 127, 900))).replace("z", " z ") for _ in range(3)]
    noise = [" ".join(t[i : i + 7] for i in range(0, len(t), 7)) for t in noise]
    docs = documents.where("lang = 'en'").select("doc_id", "text", "lang").union(
        spark.createDataFrame([(10_000 + i, t, "en") for i, t in enumerate(noise)], "doc_id long, text string, lang string")
    )
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert not any(kept[10_000 + i] for i in range(3))


# Secrets


def brute_spans(text):
    text = text or ""
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [("assign", *m.span()) for m in re.finditer(assign, text, re.I | re.A) if len(m.group(2)) >= 12]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_secrets_against_brute_force(odd, documents):
    for docs in (odd, documents):
        got = secrets.find_secrets(docs).collect()
        expected = Counter()
        for r in docs.collect():
            spans = brute_spans(r.text)
            kinds = [s[0] for s in spans]
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            expected[
                (r.doc_id, *[kinds.count(k) for k in ("assign", "access", "hex")], hashlib.sha256(joined.encode()).hexdigest())
            ] += 1
        assert by_row(got, ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")) == expected


def test_models_part_random_strings_from_identifiers():
    """Held-out accuracy."""
    r = np.random.default_rng(5)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))
    random = ["".join(r.choice(letters, 28)) for _ in range(600)]
    parts = "get set user name file path open close read write index value table count reader config server".split()
    ordinary = ["_".join(r.choice(parts, 5)) for _ in range(600)]
    logs = secrets.pair_logs(random[:400]) - secrets.pair_logs(ordinary[:400])
    assert np.mean([secrets.ratio(w, logs) >= 0.3 for w in random[400:]]) > 0.95
    assert np.mean([secrets.ratio(w, logs) >= 0.3 for w in ordinary[400:]]) < 0.02


def test_commonest_kind_does_not_decide_what_is_random(spark):
    """Held-out strings of each kind, with pools of nearly one kind."""
    r = np.random.default_rng(8)
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    string = lambda letters, n: "".join(r.choice(list(letters), n))
    parts = "get set user name file path open close read write index value table count reader config server".split()
    ordinary = lambda: "_".join(r.choice(parts, 4))
    pools = [lambda: string("0123456789abcdef", 40), lambda: string(digits, 16), lambda: "AKIA" + string(upper + digits, 16)]
    for pool in pools:
        texts = [f"{pool() if i % 100 else 'token=' + string(lower + upper + digits, 28)} {ordinary()} {ordinary()}" for i in range(2000)]
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        logs = secrets.train(docs)
        for letters in (lower + upper + digits, lower + upper + digits + "+/", lower + upper + digits + "-_"):
            assert np.mean([secrets.ratio(string(letters, 28), logs) >= 0.3 for _ in range(300)]) > 0.95
        assert np.mean([secrets.ratio(ordinary(), logs) >= 0.3 for _ in range(300)]) < 0.02


def test_redaction(odd):
    assert secrets.redact(odd).columns == odd.columns
    before = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    after = {r.doc_id: r for r in secrets.redact(odd).collect() if r.doc_id is not None}
    for i, text in before.items():
        if text is None:
            assert after[i].text is None
        else:
            assert not brute_spans(after[i].text) and after[i].n_chars == len(after[i].text)
            if not brute_spans(text) and "9fQ2z" not in text:
                assert after[i].text == text


def test_unseen_grams_back_off_and_large_tables_are_joined(spark, monkeypatch):
    schema = "doc_id long, text string, lang string"
    pair, word = "vjh4", "l=^8l=^8"
    docs = spark.createDataFrame([(0, pair * 9, "en")], schema)
    strange = spark.createDataFrame([(0, word, "en")], schema)
    model = quality.train(docs)
    # Nothing of it was seen; only the lowest order has a (back-off) weight.
    [weight] = [r.mass / r.total for r in model.levels[0].contexts.df.collect()]
    [got] = quality.score(strange, model).collect()
    assert got.log2_perplexity == pytest.approx(-np.log2(max(weight / 256, 1e-9)), rel=1e-3)

    texts = [(i, " ".join(f"w{(i * k) % 37}x{k % 11}" for k in range(60)), "en") for i in range(20)] + [(None, None, None)]
    docs = spark.createDataFrame(texts, schema)
    figures = lambda: sorted((str(r.doc_id), r.log2_perplexity) for r in quality.judge(docs).collect())
    whole = figures()
    monkeypatch.setattr(quality, "MODEL_ENTRIES", 50)
    joined = figures()
    assert [x[0] for x in joined] == [x[0] for x in whole]
    assert [x[1] for x in joined[:-1]] == pytest.approx([x[1] for x in whole[:-1]], rel=1e-4) and joined[-1][1] is None


def ordered_texts(n, seed=7, length=200):
    """Texts whose words follow one another by a rule: each word has few followers."""
    r = np.random.default_rng(seed)
    vocabulary = ["".join(r.choice(list("bdklmnrst")) + r.choice(list("aeiou")) for _ in range(3)) for _ in range(800)]
    follow = r.integers(0, 800, (800, 4))
    texts = []
    for _ in range(n):
        at, said = int(r.integers(800)), []
        for _ in range(length):
            said.append(vocabulary[at])
            at = int(follow[at, r.integers(4)]) if r.random() < 0.9 else int(r.integers(800))
        texts.append(said)
    return texts


def test_shuffled_words_leave_the_band(spark):
    texts = ordered_texts(400)
    r = np.random.default_rng(9)
    rows = [(i, " ".join(t), "en") for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(r.permutation(t)), "en") for i, t in enumerate(texts[:20])]
    # The same in a script of three-byte letters without blanks.
    letters = {w: chr(0x4E00 + i) for i, w in enumerate(sorted({w for t in texts for w in t}))}
    wide = [[letters[w] for w in t] for t in texts]
    blanks = lambda t: " ".join("".join(t[i : i + 3]) for i in range(0, len(t), 3))
    rows += [(2000 + i, blanks(t), "zh") for i, t in enumerate(wide)]
    rows += [(3000 + i, blanks(r.permutation(t)), "zh") for i, t in enumerate(wide[:20])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {x.doc_id: x.kept for x in quality.judge(docs).collect()}
    assert not any(kept[k + i] for k in (1000, 3000) for i in range(20))
    assert sum(kept[k + i] for k in (0, 2000) for i in range(400)) >= 790
