"""Operator 8: remove long strings that occur more than once, by the interval tree
of an enhanced suffix array.

A suffix array of all texts would be many times their size. Here only anchors
are sorted: in every window of ``length`` bytes the ``GRAM``-byte string of least
hash is one (the leftmost of equals). Equal windows have the same anchor at the
same place, so every repeated window is found at the anchors that occur twice.

1. Anchors of all texts, counted by hash; those of one place only are dropped.
2. For the others, the bytes around: everything a window over the anchor can
   cover. Equal surroundings are counted, so a passage that very many documents
   share is one row in its group.
3. Per anchor, the different surroundings are sorted from the anchor on (the
   suffix array), with the common prefixes of neighbours; a stack scan gives the
   tree of common-prefix intervals, deepest first. In each interval the members'
   left sides are compared: where left extensions differ, members with longer
   common ones stay together, and a member's longest is the maximal repeat it
   has there. Every member of an interval is an occurrence, not only neighbours.
4. An anchor with more than ``most_members`` different surroundings (many texts
   that share a passage's edge) is not sorted in one task: its windows are
   hashed and counted by Spark instead, which finds the same repeats.
5. The spans of a text are merged and its bytes cut.

Exact copies of a text are all removed, and only one of them goes through the
steps. A text is known by its 64-bit hash.

Defined results: a null text is empty; texts under ``length`` bytes lose
nothing; rows stay as they are, null ids included; repeated rows are copies of
each other; further columns are ignored; no rows give no rows. The bytes that
are left may end in the middle of a UTF-8 letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, apart, in_tasks, prefix_sums, row_chunks, substring_hashes, text_bytes

GRAM = 32
MOST_MEMBERS = 100_000
LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def anchor_places(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the anchors of several texts are, and their hashes."""
    width = length - GRAM + 1
    windows = len(data) - length + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = substring_hashes(sums, at, at + GRAM)
    # Least value and leftmost place of blocks of 1, 2, 4 ... grams, up to the width.
    value, place, span = grams, at, 1

    def merged(value: np.ndarray, place: np.ndarray, shift: int):
        a, b = value[:-shift], value[shift:]
        first = a <= b
        return np.where(first, a, b), np.where(first, place[:-shift], place[shift:])

    while span * 2 <= width:
        value, place = merged(value, place, span)
        span *= 2
    if span < width:
        value, place = merged(value, place, width - span)
    row = np.searchsorted(starts, np.arange(windows), side="right") - 1
    whole = np.arange(windows) + length <= starts[row + 1]
    chosen = place[:windows][whole]
    if not len(chosen):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
    chosen = np.unique(chosen)
    return chosen, grams[chosen]


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, key, pos, gram`` of every anchor of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(2))
            for first, last in row_chunks(starts):
                begins = starts[first : last + 1] - starts[first]
                pos, gram = anchor_places(data[starts[first] : starts[last]], begins, length)
                row = np.searchsorted(begins, pos, side="right") - 1
                part = batch.slice(first, last - first)
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(taken),
                        part.column(1).take(taken),
                        pa.array((pos - begins[row]).astype(np.int32)),
                        pa.array(gram.view(np.int64)),
                    ],
                    ["doc_id", "key", "pos", "gram"],
                )

    long_enough = _texts(docs).where(F.octet_length("text") >= length)
    return long_enough.transform(in_tasks, run, "doc_id long, key long, pos int, gram long")


def surroundings(docs: DataFrame, wanted: Stage, length: int) -> DataFrame:
    """``gram, before, around, key, pos``: for each wanted anchor the bytes any
    window over it can cover, ``before`` of them in front of it."""
    left = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                spots = batch.column(2)[i].values
                pos = spots.field("pos").to_numpy(zero_copy_only=False)
                before = np.minimum(pos, left).astype(np.int32)
                around = [raw[p - b : p + length] for p, b in zip(pos.tolist(), before.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        spots.field("gram"),
                        pa.array(before),
                        pa.array(around, pa.binary()),
                        pa.array(np.full(len(pos), batch.column(0)[i].as_py())),
                        pa.array(pos.astype(np.int32)),
                    ],
                    ["gram", "before", "around", "key", "pos"],
                )

    # One of a text's copies, the one of smallest id, is enough.
    picked = wanted.df.select(F.col("key").alias("_key"), "one", "spots")
    texts = _texts(docs)
    one = texts.join(picked, (texts["key"] == F.col("_key")) & texts["doc_id"].eqNullSafe(F.col("one")))
    return one.select("key", "text", "spots").transform(in_tasks, run, "gram long, before int, around binary, key long, pos int")


def _common(a: int, b: int, most: int, width: int) -> int:
    """Equal leading bytes of two strings held as integers of ``width`` bytes."""
    return min(most, width - ((a ^ b).bit_length() + 7) // 8)


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """The common-prefix intervals (depth, first, last) of a sorted list whose
    neighbours i and i + 1 share ``common[i]`` bytes; inner ones come first."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            inner, first = stack.pop()
            yield inner, first, i
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))


def maximal_repeats(members: list[tuple[int, bytes]], length: int) -> list[tuple[int, int]]:
    """For each of an anchor's different surroundings (bytes in front, bytes), how
    far before and behind the anchor its repeats of ``length`` bytes or more
    reach; (0, 0) if it has none."""
    width = length
    right = [m[b:] for b, m in members]
    left = [m[:b][::-1] for b, m in members]
    right_n = [int.from_bytes(r.ljust(width, b"\0")) for r in right]
    left_n = [int.from_bytes(s.ljust(width, b"\0")) for s in left]
    order = sorted(range(len(members)), key=right.__getitem__)
    common = [
        _common(right_n[a], right_n[b], min(len(right[a]), len(right[b])), width)
        for a, b in zip(order, order[1:], strict=False)
    ]
    reach = [(0, 0)] * len(members)
    known_left = [-1] * len(members)
    for depth, first, last in intervals(common):
        if depth < GRAM:
            continue
        inside = sorted(order[first : last + 1], key=left.__getitem__)
        shared = [
            _common(left_n[a], left_n[b], min(len(left[a]), len(left[b])), width)
            for a, b in zip(inside, inside[1:], strict=False)
        ]
        for i, member in enumerate(inside):
            longest = max(shared[i - 1] if i else 0, shared[i] if i < len(shared) else 0)
            if longest > known_left[member]:
                known_left[member] = longest
                if longest + depth >= length:
                    before, behind = reach[member]
                    reach[member] = (max(before, longest), max(behind, depth))
    return reach


def sorted_groups(contexts: DataFrame, length: int) -> DataFrame:
    """``gram, context, before, behind`` from ``gram, context, front, around,
    many``, each anchor's rows in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []
        held: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                found = maximal_repeats([(r[2], r[3]) for r in held], length)
            else:
                found = [(0, 0)]
            for r, (before, behind) in zip(held, found, strict=True):
                if r[4]:
                    before, behind = r[2], len(r[3]) - r[2]
                if before + behind >= length:
                    out.append((r[0], r[1], before, behind))

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["gram", "context", "before", "behind"]
            )

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][0] != r[0]:
                    close()
                    held = []
                held.append(r)
            yield made()
            out = []
        if held:
            close()
        yield made()

    dealt = contexts.repartition("gram").sortWithinPartitions("gram")
    return dealt.transform(in_tasks, run, "gram long, context long, before int, behind int")


def counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many surroundings: each window over the
    anchor by its hash, those of two surroundings or more by counting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data = np.frombuffer(r[3], np.uint8)
                start = np.arange(max(0, min(len(data) - length, r[2]) + 1))
                hashes = substring_hashes(prefix_sums(data), start, start + length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(start), r[0])),
                        pa.array(np.full(len(start), r[1])),
                        pa.array((r[2] - start).astype(np.int32)),
                        pa.array(hashes.view(np.int64)),
                    ],
                    ["gram", "context", "front", "window"],
                )

    windows = Stage(contexts.transform(in_tasks, run, "gram long, context long, front int, window long"), "repeat-windows")
    twice = (
        windows.df.groupBy("gram", "front", "window")
        .agg(F.min("context").alias("a"), F.max("context").alias("b"))
        .where("a != b")
        .select("gram", "front", apart(F.col("window")).alias("window"))
    )
    return (
        windows.df.join(twice, ["gram", "front", "window"], "left_semi")
        .groupBy("gram", "context")
        .agg(F.max("front").alias("before"), (F.lit(length) - F.min("front")).cast("int").alias("behind"))
    )


def repeated_spans(docs: DataFrame, length: int = 200, most_members: int = MOST_MEMBERS) -> Stage:
    """``key, spans``: the repeated byte ranges (begin, end) of each text that has
    any; they may overlap."""
    found = Stage(anchors(docs, length), "repeat-anchors")
    place = F.xxhash64("key", "pos")
    twice = (
        found.df.groupBy("gram")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .where("a != b")
        .select(apart(F.col("gram")).alias("gram"))
    )
    wanted = Stage(
        found.df.join(twice, "gram", "left_semi")
        .groupBy("key")
        .agg(F.collect_set(F.struct("pos", "gram")).alias("spots"), F.min("doc_id").alias("one")),
        "repeat-wanted",
    )
    found.drop()
    context = F.xxhash64("gram", "before", "around")
    around = Stage(surroundings(docs, wanted, length).withColumn("context", context), "repeat-around")
    contexts = Stage(
        around.df.groupBy("gram", "context", F.col("before").alias("front"), "around")
        .agg(F.min(place).alias("a"), F.max(place).alias("b"))
        .select("gram", "context", "front", "around", (F.col("a") != F.col("b")).alias("many")),
        "repeat-contexts",
    )
    hot = Stage(contexts.df.groupBy("gram").count().where(F.col("count") > most_members).select("gram"), "repeat-hot")
    if hot.df.isEmpty():
        reach = sorted_groups(contexts.df, length)
    else:
        reach = sorted_groups(contexts.df.join(hot.small(), "gram", "left_anti"), length)
        wide = contexts.df.join(hot.small(), "gram", "left_semi")
        full = wide.where("many").select(
            "gram", "context", F.col("front").alias("before"), (F.length("around") - F.col("front")).alias("behind")
        )
        reach = reach.union(full).union(counted_windows(wide, length))
    reaches = Stage(
        reach.groupBy("gram", "context").agg(F.max("before").alias("before"), F.max("behind").alias("behind")),
        "repeat-reach",
    )
    inner = around.df.select("gram", "context", "key", "pos").join(reaches.df, ["gram", "context"]).select(
        "key", F.struct((F.col("pos") - F.col("before")).alias("begin"), (F.col("pos") + F.col("behind")).alias("end")).alias("span")
    )
    copies = (
        docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .select(F.xxhash64("text").alias("key"), F.octet_length("text").alias("n"))
        .where(F.col("n") >= length)
        .groupBy("key", "n")
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > 1)
        .select("key", F.struct(F.lit(0).alias("begin"), F.col("n").cast("int").alias("end")).alias("span"))
    )
    spans = Stage(inner.union(copies).groupBy("key").agg(F.collect_set("span").alias("spans")), "repeat-spans")
    for stage in (wanted, around, contexts, hot, reaches):
        stage.drop()
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, most_members: int = MOST_MEMBERS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (bytes) per row."""
    spans = repeated_spans(docs, length, most_members)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode()
                cut = merged([(s["begin"], s["end"]) for s in found.as_py() or ()])
                kept, done = [], 0
                for begin, end in cut:
                    kept.append(raw[done:begin])
                    done = end
                left = b"".join([*kept, raw[done:]])
                rows.append((len(raw), len(raw) - len(left), len(cut), hashlib.sha256(left).hexdigest(), left))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names
            )

    found = spans.df.withColumnRenamed("key", "_key")
    texts = _texts(docs)
    joined = texts.join(found, texts["key"] == F.col("_key"), "left").select("doc_id", "text", "spans")
    kinds = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.transform(in_tasks, run, kinds)
