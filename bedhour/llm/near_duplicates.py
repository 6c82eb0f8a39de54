"""Operator 3: near-duplicate documents by MinHash.

1. A task reads whole texts and makes each one's set of word shingles, its size
   and fingerprint, ``BANDS * ROWS`` universal hash minima, a key per band of
   minima, and a signature of one byte per minimum.
2. Documents with equal sets form a class; only its smallest id goes on.
3. In every band bucket, each class is paired with the smallest class. Pairs
   whose signatures agree enough are confirmed on the full sets. A large group
   of near copies thus costs one pair per member, not all pairs.
4. Components of the confirmed pairs. In buckets that still hold several
   components, members of different ones are compared too, by signature and then
   on the full sets, inside the task: blocks of bounded size meet there, and only
   links that join components leave it.
5. Components of all confirmed links, by alternating large-star and small-star.

With 40 bands of 5 minima, a pair of similarity 0.8 shares no bucket with
probability 1.3e-7; its signature falls under ``least_agreement`` with 1e-9.

Defined results: words end at blanks, tabs and line ends, A-Z lower-cased; with
fewer words than a shingle has, the whole text is one shingle; a null or empty
text has an empty set and is linked with nothing; a null id takes no part (its
component is null, it is kept); rows of one id are one document that has the
links of all its rows; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    BROADCAST_BYTES,
    LOWER,
    MIX_1,
    MIX_2,
    Stage,
    apart,
    mix,
    in_tasks,
    prefix_sums,
    row_chunks,
    substring_hashes,
    text_bytes,
    word_spans,
)
from .components import components

BANDS, ROWS = 40, 5
BLOCK = 2_000
BLOCK_BYTES = 16 << 20
_random = np.random.default_rng(20240607)
FACTORS = (_random.integers(0, 1 << 32, BANDS * ROWS, np.uint64) | np.uint64(1)).astype(np.uint32)
TERMS = _random.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data = LOWER[data]
    begin, end, row = word_spans(data, starts)
    word = substring_hashes(prefix_sums(data), begin, end)
    counts = np.bincount(row, minlength=len(starts) - 1)
    first = np.cumsum(counts) - counts
    rolled = word.copy()
    for i in range(1, size):
        rolled = mix(rolled[: len(word) - i] * MIX_1 + word[i:])
    sets = []
    for at, n in zip(first.tolist(), counts.tolist(), strict=True):
        if n >= size:
            sets.append(np.unique(rolled[at : at + n - size + 1]))
        elif n:
            whole = word[at : at + 1]
            for i in range(1, n):
                whole = mix(whole * MIX_2 + word[at + i : at + i + 1])
            sets.append(whole ^ np.uint64(n))
        else:
            sets.append(word[:0])
    return sets


def minima(shingles: np.ndarray, block: int = 1 << 14) -> np.ndarray:
    """Smallest value of each universal hash ``a * x + b`` over a set."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), block):
        part = FACTORS[:, None] * values[None, at : at + block]
        part += TERMS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, keys, packed`` per row: ``packed`` is
    the signature and the band keys as bytes; no keys for an empty set."""
    names = ["doc_id", "n_shingles", "set_a", "set_b", "keys", "packed"]
    band = mix(np.arange(1, BANDS + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            for first, last in row_chunks(starts):
                sets = shingle_sets(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], size)
                least = np.stack([minima(s) for s in sets])
                keys = np.repeat(band[None, :], len(sets), axis=0)
                for i in range(ROWS):
                    keys = mix(keys * MIX_1 + least[:, i::ROWS].astype(np.uint64))
                fingerprints = [(s.sum(dtype=np.uint64), mix(s).sum(dtype=np.uint64)) for s in sets]
                full = np.array([len(s) > 0 for s in sets])
                # The upper byte of a minimum is nearly always 0: keep a mixed one.
                small = (mix(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([a for a, _ in fingerprints], np.uint64).view(np.int64)),
                        pa.array(np.array([b for _, b in fingerprints], np.uint64).view(np.int64)),
                        pa.array(
                            [k if f else [] for k, f in zip(keys.view(np.int64), full, strict=True)], pa.list_(pa.int64())
                        ),
                        pa.array([a.tobytes() + b.tobytes() for a, b in zip(small, keys, strict=True)], pa.binary()),
                    ],
                    names,
                )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>, packed binary"
    return picked.transform(in_tasks, run, kinds)


def full_sets(docs: DataFrame, nodes: Stage, size: int) -> DataFrame:
    """``node, shingles`` (sorted 64-bit hashes as bytes) of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            for first, last in row_chunks(starts):
                sets = shingle_sets(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first], size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "shingles"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    return texts.join(nodes.small(), "node", "left_semi").transform(in_tasks, run, "node long, shingles binary")


def agreeing(pairs: DataFrame, signatures: DataFrame, least_agreement: float) -> DataFrame:
    """Pairs ``u, v`` whose signatures agree in that share of bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3)
            )
            keep = (a == b).mean(axis=1) >= least_agreement if batch.num_rows else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep))

    a = signatures.select(F.col("node").alias("u"), F.col("signature").alias("a"))
    b = signatures.select(F.col("node").alias("v"), F.col("signature").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").transform(in_tasks, run, "u long, v long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """``100 * common >= percent * all`` for two sorted sets; not for empty ones."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with ``100 * common >= percent * all`` on the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").transform(in_tasks, run, "u long, v long")


class Cell:
    """Rows of one bucket that meet in one task: two of its blocks."""

    def __init__(self, rows: list[tuple]):
        key, self.low, self.high = rows[0][0], rows[0][6], rows[0][7]
        self.node, root, self.own = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 5))
        # Local components, joined as links are found.
        self.label = np.unique(root, return_inverse=True)[1]
        packed = [np.frombuffer(r[3], np.uint8) for r in rows]
        self.signature = np.stack([p[: BANDS * ROWS] for p in packed])
        self.keys = np.stack([p[BANDS * ROWS :].view(np.int64) for p in packed])
        self.band = (self.keys == key).argmax(axis=1)
        self.sets = [np.frombuffer(r[4], np.uint64) for r in rows]

    def links(self, least_agreement: float, percent: int) -> list[tuple[int, int]]:
        """Links that join components, found on the full sets. Pairs that agree
        by signature are tested, best first, and only in the first band they
        share; pairs of one component are not."""
        found = []
        most = np.bincount(self.label).argmax()
        other = np.flatnonzero(self.label != most)
        done = np.zeros(len(self.node), bool)
        for i in other:
            meets = self.own == (self.high if self.own[i] == self.low else self.low)
            meets &= ~done
            meets[i] = False
            done[i] = True
            near = np.flatnonzero(meets & (self.label != self.label[i]))
            if not len(near):
                continue
            agree = (self.signature[near] == self.signature[i]).mean(axis=1)
            first = (self.keys[near] == self.keys[i]).argmax(axis=1) == self.band[i]
            keep = (agree >= least_agreement) & first
            for j in near[keep][np.argsort(-agree[keep], kind="stable")]:
                if self.label[j] != self.label[i] and similar(self.sets[i], self.sets[j], percent):
                    found.append((int(self.node[i]), int(self.node[j])))
                    self.label[self.label == self.label[j]] = self.label[i]
        return found


def links_across(members: DataFrame, least_agreement: float, percent: int, block: int = BLOCK) -> DataFrame:
    """Links ``u, v`` between members of one bucket that are in different
    components.

    ``members``: ``key, node, root, packed`` (signature and band keys),
    ``shingles``. A bucket's rows are dealt to blocks of bounded rows and bytes,
    and every two blocks meet in one cell; cells are read one after the other
    from sorted rows. No pair leaves its cell but those that join components.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.length("shingles")).alias("bytes"))
    n_blocks = F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / BLOCK_BYTES)).cast("int")
    sizes = sizes.select(apart(F.col("key")).alias("key"), n_blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (
        members.join(sizes, "key")
        .select("key", "node", "root", "packed", "shingles", own.alias("own"), other.alias("other"))
        .select(
            "key", "node", "root", "packed", "shingles", "own",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared(rows: list[tuple]) -> pa.RecordBatch:
            pairs = Cell(rows).links(least_agreement, percent) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["u", "v"]
            )

        held: list[tuple] = []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (r[0], r[6], r[7]) != (held[0][0], held[0][6], held[0][7]):
                    yield compared(held)
                    held = []
                held.append(r)
        if held:
            yield compared(held)

    return (
        cells.repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .transform(in_tasks, run, "u long, v long")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, least_agreement: float | None = None
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``
    (``doc_id, text``)."""
    if least_agreement is None:
        # Six standard deviations of the agreement at the least similarity.
        p = percent / 100
        least_agreement = p - 6 * (p * (1 - p) / (BANDS * ROWS)) ** 0.5
    sketches = Stage(sketch(docs, shingle), "near-sketches")
    same = ["n_shingles", "set_a", "set_b"]
    named = sketches.df.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = Stage(
        named.groupBy(*same).agg(F.min("doc_id").alias("node"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n"),
        "near-classes",
    )
    # One row of each class goes on: its smallest id.
    class_rows = classes.df.select(*[F.col(c).alias(f"_{c}") for c in same], "node")
    in_class = [F.col(c) == F.col(f"_{c}") for c in same]
    nodes = named.join(F.broadcast(class_rows) if classes.bytes() <= BROADCAST_BYTES else class_rows, in_class, "left").where(
        F.col("node").isNull() | (F.col("node") == F.col("doc_id"))
    )
    nodes = Stage(nodes.select(F.col("doc_id").alias("node"), "keys", "packed"), "near-nodes")
    signatures = nodes.df.select("node", F.substring("packed", 1, BANDS * ROWS).alias("signature"))
    keyed = nodes.df.select("node", F.explode("keys").alias("key"))
    centers = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("n")).where(F.col("n") > 1)
    centers = centers.select(apart(F.col("key")).alias("key"), "center", "n")
    buckets = Stage(keyed.join(centers, "key").select("key", "node", "center", "n"), "near-buckets")

    stars = buckets.df.where(F.col("node") != F.col("center")).select(F.col("node").alias("u"), F.col("center").alias("v"))
    near = Stage(agreeing(stars.distinct(), signatures, least_agreement), "near-pairs")
    # Classes are linked by their members too: rows of one id may be in several.
    members_of = Stage(
        named.join(class_rows, in_class)
        .where(F.col("doc_id") != F.col("node"))
        .select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
        .distinct(),
        "near-members",
    )
    links = [members_of, _confirm(docs, near, shingle, percent)]
    stars_of = components(links[0].df.union(links[1].df))

    # Buckets that the first components leave apart; pairs with the center are done.
    roots = stars_of.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    rest = buckets.df.where((F.col("n") > 2) & (F.col("node") != F.col("center")))
    rest = rest.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    open_keys = rest.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b")
    open_keys = open_keys.select(apart(F.col("key")).alias("key"))
    members = Stage(rest.join(open_keys, "key", "left_semi"), "near-open")
    if not members.df.isEmpty():
        ends = Stage(members.df.select("node").distinct(), "near-ends")
        sets = Stage(full_sets(docs, ends, shingle), "near-sets")
        rows = members.df.join(nodes.df.select("node", "packed"), "node").join(sets.df, "node")
        links.append(Stage(links_across(rows.select("key", "node", "root", "packed", "shingles"), least_agreement, percent), "near-links"))
        ends.drop()
        sets.drop()
        stars_of.drop()
        stars_of = components(links[0].df.union(links[1].df).union(links[2].df))

    result = sketches.df.select("doc_id", "n_shingles").join(
        stars_of.df.select(F.col("u").alias("_node"), F.col("v").alias("root")), F.col("doc_id") == F.col("_node"), "left"
    )
    for stage in (classes, nodes, buckets, near, members, *links):
        stage.drop()
    component = F.coalesce("root", "doc_id")
    return result.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def _confirm(docs: DataFrame, near: Stage, shingle: int, percent: int) -> Stage:
    ends = Stage(near.df.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "near-ends")
    sets = Stage(full_sets(docs, ends, shingle), "near-sets")
    links = Stage(confirmed(near.df, sets.df, percent), "near-links")
    ends.drop()
    sets.drop()
    return links


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that are kept: those of one document of each
    component. Rows that share id and text keep one row as well; rows of one id
    with different texts, and null ids, stay."""
    # Helping columns have names that docs does not have.
    gone_id, again_id, row = (unused(docs, name) for name in ("_gone", "_again", "_row"))
    gone = Stage(
        near_duplicates(docs, shingle, percent).where(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct(),
        "near-gone",
    )
    kept = docs.join(gone.small(), docs["doc_id"].cast("long") == F.col(gone_id), "left_anti")
    again = Stage(
        docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias(again_id)).agg(F.count("*").alias(row)).where(F.col(row) > 1),
        "near-again",
    )
    if again.df.isEmpty():
        return kept
    same = F.col("doc_id") == F.col(again_id)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Combined on the map side, so any number of equal rows is one per task.
    one = kept.join(again.small(), same, "left_semi").groupBy("doc_id", "text").agg(
        F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias(row)
    )
    return kept.join(again.small(), same, "left_anti").unionAll(one.select(f"{row}.*"))


def unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name
