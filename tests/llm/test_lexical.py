"""Ranked search, personal data and alignment against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from bedhour.llm import alignment, personal, queries, search
from conftest import frame, odd_rows, prose


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def key(row):
    return tuple((v is None, v or 0) for v in row)


# Search


def best_by_hand(docs, items, k):
    held = [(i, Counter(re.findall(search.TERM, lower(t)))) for i, t in docs]
    n = sum(1 for _, c in held if c)
    size = sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    rows = []
    for item, text in items:
        scored = []
        for doc, c in held:
            m = 50 + (50 * c.total() * n) // max(size, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 20 * m))
                for w in set(re.findall(search.TERM, lower(text)))
                if c[w]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        rows += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=key)


ITEMS = [(1, "the River and stone"), (2, "river, STONE and light"), (2, "of the river and stone under light"), (3, None), (4, "zzqq"),
         (5, ""), (None, "été the été"), (6, "copper of the stone")]


@pytest.mark.parametrize("plan_terms", [search.PLAN_TERMS, 4])
def test_search_equals_brute_force(spark, odd, plan_terms):
    items = spark.createDataFrame([(*i, 7, "x") for i in ITEMS], "item_id long, text string, rank int, words string")
    got = sorted((tuple(r) for r in search.search(odd, items, 5, plan_terms).collect()), key=key)
    assert got == best_by_hand([r[:2] for r in odd_rows()], ITEMS, 5)


def test_search_over_many_batches_keeps_ties_by_id(spark, monkeypatch):
    rows = [(i * 7 % 3001, "alpha beta" if i % 3 else "beta") for i in range(3001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "alpha"), (2, "beta alpha")], "item_id long, text string")
    got = sorted(tuple(r) for r in search.search(docs, items, 50).collect())
    assert got == best_by_hand(rows, [(1, "alpha"), (2, "beta alpha")], 50)


def test_search_of_nothing(spark, no_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.search(no_rows, items).count() == 0
    assert search.search(no_rows, items.limit(0)).count() == 0


def test_terms_in_parts(monkeypatch):
    text = lower(prose(5, 500) + " été x" * 40)
    monkeypatch.setattr(search, "PART", 16)
    assert [w.decode() for part in search.terms_of(text.encode()) for w in part] == re.findall(search.TERM, text)


def test_shared_sets_save_additions():
    r = np.random.default_rng(3)
    common = [list(range(20)), list(range(10, 30)), list(range(40, 55))]
    items = [sorted({*common[i % 3], *r.integers(60, 400, 5).tolist()}) for i in range(60)]
    plan = search.share(items, 400)
    assert plan.additions() < sum(len(i) - 1 for i in items) / 2
    values = {t: r.integers(0, 100, 7) for t in range(0, 400, 2)}
    for item, total in zip(items, plan.totals(dict(values)), strict=True):
        assert (total == sum(values[t] for t in item if t in values)).all()


# Personal data


def spans_by_hand(text):
    """The stated patterns, as they are."""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        odd, even = digits[-1::-2], digits[-2::-2]
        if 16 <= len(digits) <= 19 and (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0:
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            spans.append(("phone", *m.span()))
    return spans


ODD_TEXTS = [
    "a@b.c_d@e.f x@y z@@q.r .@a.b a@-.- é@x.yy mail=me.you+1@host-2.example.com.",
    "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255 1.2.3 .1.2.3.4 0000000255.1.1.1 256.1.1.1 1.2.3.4567",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111 1111 1111 4539578763621486 5 x",
    "+1 (017) 555-7713 +1234567 +12345678 + 123 +1.2.3.4.5.6.7.8 +49 30 1234567890123456 ++49(30)12-34-56.",
    "😀 +49 (30) 123456 é 10.0.0.1 😀 a.b@c.de",
]


def test_base_spans_equal_the_stated_patterns():
    r = np.random.default_rng(5)
    letters = list("ab1 2.3-4@+(5)_67\n89é00")
    texts = ODD_TEXTS + ["".join(r.choice(letters, 60)) for _ in range(3000)]
    for text in texts:
        assert [(personal.KINDS[k], a, b) for k, a, b in personal.base_spans(text)] == spans_by_hand(text), text


def test_base_spans_of_very_long_runs():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "@" * 200_000 + "a@b.c", "+1" + " " * 300_000, "a@" * 200_000):
        assert len(personal.base_spans(text)) < 200_000


def planted():
    """An address that stands with one rare name in varied places, a card that
    does so in copies of one document only, and documents without either."""
    rows = []
    for i in range(6):
        rows.append((i, f"{prose(100 + i, 30)} {prose(200 + i, 3)} Quillfeather wrote ada.q@mail.example.org {prose(300 + i, 30)}"))
    rows += [(10 + i, prose(1, 20) + " Zanzibarian 4111 1111 1111 1111 " + prose(2, 20)) for i in range(40)]
    rows += [(60 + i, f"{prose(400 + i, 60)} wrote 10.0.0.{i}") for i in range(40)]
    rows.append((110, prose(7, 30) + " quillFeather " + prose(8, 10)))
    return rows


def test_terms_that_disclose(spark):
    docs = spark.createDataFrame(planted(), "doc_id long, text string").repartition(5)
    found = {r["term"]: r["disclosure"] for r in personal.disclosing_terms(docs).collect()}
    n, both, df = 87, 6, 7
    assert found.keys() == {"quillfeather"}
    assert math.isclose(found["quillfeather"], math.log2(both * n / (both * df)) / math.log2(n / both))
    rows = {r.doc_id: r for r in personal.personal_digest(personal.find_personal(docs)).collect()}
    texts = dict(planted())
    for i, text in texts.items():
        base = spans_by_hand(text)
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert rows[i].base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in personal.KINDS[:4]] == [sum(b[0] == k for b in base) for k in personal.KINDS[:4]]
        name = re.search("quillfeather", text, re.IGNORECASE)
        added = [f"general:{name.start()}:{name.end()}"] if name else []
        assert rows[i].spans == ",".join([digest] * bool(base) + added)
    strict = {r.doc_id: r.text for r in personal.sanitise(docs, remove=0.9).collect()}
    mild = {r.doc_id: r.text for r in personal.sanitise(docs).collect()}
    assert "Quillfeather" not in strict[0] and "[EMAIL]" in strict[0] and "[NAME]" not in strict[0]
    assert "[NAME] wrote [EMAIL]" in mild[0] and "[WORD]" in mild[110] and "Zanzibarian [CARD]" in mild[10]
    assert mild[60] == texts[60].replace("10.0.0.0", "[IP]")


def test_personal_in_slices_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(planted(), "doc_id long, text string").repartition(3)
    thresholds = {"generalise": 0.3, "least_contexts": 2.0}
    whole = sorted(map(tuple, personal.personal_digest(personal.find_personal(docs, **thresholds)).collect()))
    monkeypatch.setattr(personal, "SLICE_TERMS", 1)
    parts = sorted(map(tuple, personal.personal_digest(personal.find_personal(docs, **thresholds)).collect()))
    assert whole == parts and any("general" in r[-1] for r in whole)


def test_personal_odd_rows(spark, odd, no_rows):
    rows = personal.personal_digest(personal.find_personal(odd)).collect()
    want = Counter((i, ",".join(f"{k}:{a}:{b}" for k, a, b in spans_by_hand(t or ""))) for i, t, *_ in odd_rows())
    assert Counter((r.doc_id, r.spans) for r in rows) == want
    clean = personal.sanitise(odd.withColumnRenamed("u", "_spans"))
    assert clean.columns == [*odd.columns[:-1], "_spans"] and clean.count() == odd.count()
    assert personal.find_personal(no_rows).count() == 0 and personal.sanitise(no_rows).count() == 0


# Alignment


@pytest.fixture(scope="module")
def files():
    with open(queries.tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        return queries.tokenizer_definition(), f.read()


def aligned_by_hand(rows, definition, model):
    a_file, b_file = Tokenizer.from_str(definition), sentencepiece.SentencePieceProcessor(model_proto=model)
    a_file.encode_special_tokens = True
    letters = alignment.byte_of_letter()
    found, counts = [], Counter()
    for doc, text in rows:
        a = a_file.encode(" " + (text or ""), add_special_tokens=False).ids
        b = b_file.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a_file.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(b_file.id_to_piece(i)[3:5], 16)]) if b_file.is_byte(i) else b_file.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((doc, [], [], [], ""))
            continue
        ends_a, ends_b = (np.cumsum(list(map(len, x))).tolist() for x in (bytes_a, bytes_b))
        groups, links, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            at_a, at_b = to_a, to_b
        counts.update(links)
        found.append((doc, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (d, len(a), len(b), len(x), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), h)
            for d, a, b, x, h in found
        ),
        key=key,
    )


def test_alignment_equals_brute_force(spark, odd, documents, files):
    rows = [r[:2] for r in odd_rows()] + [(500, "a▁b"), (501, "<s> </s> <unk> <0x41> 日本\x00語 　 ﬁ"), (502, " "), (503, "\n\n  x\t")]
    rows += [tuple(r) for r in documents.select("doc_id", "text").where("doc_id < 40").collect()]
    docs = frame(spark, [(*r, None, None) for r in rows])
    got = sorted((tuple(r) for r in alignment.alignment_figures(docs, *files).collect()), key=key)
    assert got == aligned_by_hand(rows, *files)


def test_alignment_by_parts_and_stretches(monkeypatch, files):
    work = alignment.Aligner(*files)
    text = prose(3, 4000) + " été 日本 <|endoftext|>\n x  y \x1d z it's  'll \u2009 . ,a " + prose(4, 3000)
    whole = work.align(text)
    monkeypatch.setattr(alignment, "PART", 300)
    for one, other in zip(whole, work.align(text), strict=True):
        assert np.array_equal(one, other)
    ends = [np.cumsum(size[ids]) for ids, size in zip(whole, work.sizes, strict=False)]
    for one, other in zip(whole[2:], alignment.common_cuts(*ends, stretch=7), strict=True):
        assert np.array_equal(one, other)


@pytest.mark.parametrize("cached", [400_000, 3])
def test_remembered_words_give_the_whole(monkeypatch, files, cached):
    monkeypatch.setattr(alignment, "CACHED", cached)
    work = alignment.Aligner(*files)
    texts = [t for _, t, *_ in odd_rows()] + ["a▁b c", "x a▁b", " lead x ", "日本語é" * 900 + " x", "x y\x85z \u3000 q  r "]
    for _ in range(2):
        for text, words in zip(texts, work.figures(texts), strict=True):
            found = work.align(text)
            assert b";".join(w[2] for w in words) == work.groups_text(*found)
            assert b"".join(w[3] for w in words) == work.links(*found).tobytes()
            assert (sum(w[0] for w in words), sum(w[1] for w in words)) == (len(found[0]), len(found[1]))
    assert all(len(w) <= alignment.KEPT for w in work.known)


def test_alignment_of_nothing_and_groups(spark, no_rows, odd, files):
    assert alignment.alignment_figures(no_rows, *files).count() == 0
    for r in alignment.align(odd, *files).collect():
        assert len(r.a_cuts) == len(r.b_cuts)
        assert not r.a_ids or (r.a_cuts[-1], r.b_cuts[-1]) == (len(r.a_ids), len(r.b_ids))
