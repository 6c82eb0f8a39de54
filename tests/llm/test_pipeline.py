"""The pipeline, stage by stage, and the registration of the queries."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

import corpus_pipeline
import __spark_entry__ as entry
from bedhour.llm import common, packing, quality, queries


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages_work_on_what_is_kept(spark, documents, tmp_path):
    docs = documents
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if i < 4:
            assert out.columns == documents.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs)
    good, unique, clean, mixed, packed = seen
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert ids(good) < ids(documents) and ids(unique) < ids(good)
    assert ids(clean) == ids(unique) and ids(mixed) <= ids(clean)
    assert not any(re.search("[0-9a-f]{16,}", r.text) for r in clean.collect())
    assert ids(packed) == ids(mixed)
    tokens = Counter()
    for r in packed.collect():
        tokens[r.doc_id] += r.length
    each = {r.doc_id: r.doc_tokens for r in packed.collect()}
    copies = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert all(tokens[i] == copies[i] * each[i] for i in copies)


def test_run_is_the_stages_in_a_row(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.length <= 2048 for r in rows)


def test_queries_take_whole_tables(spark):
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    for name in ("op2_licenses", "op5_mixing", "op9_secrets", "op10_token_counts", "op12_personal", "op13_alignment"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() == n


def test_memory_is_given_back_at_the_end_of_a_task(monkeypatch):
    """Once per task, after its last batch, and also if the task stops early."""
    seen = []
    monkeypatch.setattr(common, "release", lambda: seen.append("release"))
    run = common.released(lambda batches: (b + 1 for b in batches))
    for out in run(iter([1, 2])):
        seen.append(out)
    assert seen == [2, 3, "release"]
    part = run(iter([1, 2]))
    next(part)
    part.close()
    assert seen == [2, 3, "release", "release"]


def test_counting_grams_holds_little(spark, monkeypatch):
    """Whatever a task counts, it holds no more than 2^21 grams and a batch's."""
    held = []
    monkeypatch.setattr(quality, "in_tasks", lambda df, run, schema: held.append(run) or df.selectExpr("0L as gram", "0L as n"))
    monkeypatch.setattr(quality, "added_up", lambda g, c, f=quality.added_up: held.append(len(g)) or f(g, c))

    class Docs:
        def select(self, *_):
            return self

        def transform(self, run, *args):
            return run(self, *args)

        def selectExpr(self, *_):
            return self

        def groupBy(self, *_):
            return self

        agg = groupBy

    quality.count_grams(Docs())
    rng = random.Random(1)
    texts = ["".join(chr(33 + rng.randrange(90)) for _ in range(100_000)) for _ in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5])], ["text"]) for i in range(0, 60, 5)]
    n = sum(b.num_rows for b in held[0](iter(batches)))
    assert n > 5_000_000 and max(held[1:]) < (1 << 21) + (1 << 20)


def counting_task(monkeypatch):
    """What a task of ``count_grams`` runs."""
    found = []
    monkeypatch.setattr(quality, "in_tasks", lambda df, run, schema: found.append(run) or df)
    with monkeypatch.context() as patch:
        patch.setattr(quality, "F", type("AnyColumn", (), {"__getattr__": lambda c, _: lambda *_: c})())
        any_frame = type("AnyFrame", (), {"__getattr__": lambda d, _: lambda *_: d, "transform": lambda d, f, *a: f(d, *a)})
        quality.count_grams(any_frame())
    return found[0]


def counted(task, texts, rows):
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + rows], pa.string())], ["text"]) for i in range(0, len(texts), rows)]
    total = Counter()
    for batch in task(iter(batches)):
        for gram, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total[gram.to_bytes(quality.ORDER, "big")] += n
    return total


def test_counting_grams_takes_little_memory(monkeypatch):
    """Arrays of a task that counts the grams of 8 MB of random letters."""
    task = counting_task(monkeypatch)
    letters = np.random.default_rng(3).integers(33, 126, 8_000_000, np.uint8).tobytes().decode()
    column = pa.array([letters[i : i + 2_000] for i in range(0, len(letters), 2_000)])
    batches = [pa.RecordBatch.from_arrays([column[i : i + 1_000]], ["text"]) for i in range(0, len(column), 1_000)]
    tracemalloc.start()
    try:
        n = sum(batch.num_rows for batch in task(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 7_000_000 and peak < 120e6


def test_counts_of_more_texts_than_their_bits_hold(monkeypatch):
    """A gram of every text, over many batches and in one batch; with nulls,
    texts without a gram, and bytes over 127."""
    task = counting_task(monkeypatch)
    texts = ["Common", None, "five5", ""] * 50_000 + ["\U0010ffff\U0010fffe common common"] * 20_000
    expected = Counter()
    for text, n in Counter(texts).items():
        data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
        for gram in {data[i : i + quality.ORDER] for i in range(len(data) - quality.ORDER + 1)}:
            expected[gram] += n
    assert expected[b"common"] == 70_000
    for rows in (1_000, len(texts)):
        assert counted(task, texts, rows) == expected
    assert counted(task, [], 1) == counted(task, [None, "", "five5"], 2) == Counter()


def test_a_worker_lets_go_what_another_stage_kept(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "release", lambda: seen.append("release"))
    monkeypatch.setattr(common, "_kept_by", [])
    monkeypatch.setattr(packing, "Encoder", lambda definition: object())
    common.begin_task(1)
    seen.clear()
    first = packing.encoder("a")
    common.begin_task(1)
    assert packing.encoder("a") is first and not seen
    common.begin_task(2)
    assert not packing._encoders and seen == ["release"]
    common.begin_task(3)
    assert seen == ["release"]
    assert packing.encoder("a") is not first
    packing._encoders.clear()
