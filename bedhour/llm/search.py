"""Operator 11: ranked lexical search of many queries at once.

Queries (items) share terms, and often whole sets of them. ``share`` mines the
shared sets: terms are put in order of how many items hold them, and pairs that
stand near each other in most items become nodes, again and again, until no two
are together in two items. The nodes make a graph without cycles in which a node
adds up two smaller ones and serves several larger ones or items.
For a block of documents each node's partial scores are added up once and handed
to all that use them; an item then adds its few remaining nodes.

Scores are whole numbers: with N documents that hold a term, L terms in all, n
terms in the document, df documents with the term and tf occurrences,
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and
``m = 50 + 50 * n * N div L``, a term adds
``w * (1000000000 * tf div (1000 * tf + 20 * m))``.

Texts are read once: the occurrences of the items' terms are written to the
shared folder, and statistics and scores are made from there. A task keeps the
``k`` best documents of each item and hands on only those; they are ranked in
two steps, so no task ranks what all tasks found. Items are planned together as
long as they have at most ``PLAN_TERMS`` terms in all, else in several passes,
dealt by hash; so what is collected and broadcast has a fixed bound, but for the
terms of one item.

Defined results: a null text or one without terms has no score; an item without
terms, or none of whose terms stand in a document, gives no rows. Every row of
``documents`` and of ``items`` counts by itself, repeated rows and null ids
included; documents of equal score go by id, a null id last. Further columns are
ignored. Long texts are counted ``PART`` bytes at a time. Empty tables give no
rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stage, in_tasks

# Bytes that stand in no term become blanks; A-Z become a-z.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PLAN_TERMS = 100_000
# How far apart, in the order of an item, two nodes may stand to be joined.
REACH = 32
BLOCK_DOCUMENTS = 512
PART = 1 << 20
SALTS = 64


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about ``PART`` bytes."""
    plain = text.translate(TERM_BYTES)
    first = 0
    while first < len(plain):
        last = plain.find(b" ", first + PART)
        last = len(plain) if last < 0 else last
        yield plain[first:last].split()
        first = last


@dataclass(frozen=True)
class Plan:
    """Items over a graph of shared term sets. Nodes below ``terms`` are single
    terms, node ``terms + i`` is the sum of the two nodes ``sums[i]``."""

    terms: int
    sums: list[tuple[int, int]]
    items: list[list[int]]

    def uses(self) -> list[int]:
        used = [0] * (self.terms + len(self.sums))
        for nodes in (*self.sums, *self.items):
            for node in nodes:
                used[node] += 1
        return used

    def additions(self) -> int:
        return len(self.sums) + sum(max(len(nodes) - 1, 0) for nodes in self.items)

    def totals(self, partial: dict[int, np.ndarray]) -> Iterator[np.ndarray | None]:
        """Each item's scores, from those of the terms (absent terms left out).
        A node is dropped with its last use."""
        left = self.uses()

        def taken(node: int) -> np.ndarray | None:
            left[node] -= 1
            return partial.pop(node, None) if not left[node] else partial.get(node)

        for node, (a, b) in enumerate(self.sums, self.terms):
            one, other = taken(a), taken(b)
            both = one if other is None else other if one is None else one + other
            if both is not None:
                partial[node] = both
        for nodes in self.items:
            found = [p for p in map(taken, nodes) if p is not None]
            total = found[0] if found else None
            for p in found[1:]:
                total = total + p
            yield total


def share(items: list[list[int]], terms: int) -> Plan:
    """Mine the term sets that items share, see the module text. Linear in the
    terms of the items for each round, and a round makes them fewer."""
    held = Counter(t for item in items for t in set(item))
    rest = [sorted(set(item), key=lambda t: (-held[t], t)) for item in items]
    sums: list[tuple[int, int]] = []
    while True:
        pairs = Counter((item[i], other) for item in rest for i in range(len(item)) for other in item[i + 1 : i + 1 + REACH])
        partner: dict[int, int] = {}
        node_of: dict[int, int] = {}
        for (one, other), n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n < 2:
                break
            if one not in partner and other not in partner:
                partner[one], partner[other] = other, one
                node_of[one] = terms + len(sums)
                sums.append((one, other))
        if not partner:
            return Plan(terms, sums, rest)
        for at, item in enumerate(rest):
            inside = set(item)
            joined = [node for node in item if partner.get(node) in inside]
            if joined:
                new = [node_of.get(node) if partner.get(node) in inside else node for node in item]
                rest[at] = [node for node in new if node is not None]


def postings(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, times`` for every row: its number of terms, and which
    of ``words`` (by place) it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {word: i for i, word in enumerate(shared.value)}
        for batch in batches:
            sizes: list[int] = []
            found: list[Counter] = []
            for text in batch.column(1).cast(pa.binary()):
                counts: Counter = Counter()
                size = 0
                for part in terms_of(text.as_py() or b""):
                    size += len(part)
                    counts.update(i for i in map(place.get, part) if i is not None)
                sizes.append(size)
                found.append(counts)
            offsets = pa.array(np.concatenate([[0], np.cumsum(list(map(len, found)))]).astype(np.int32))
            lists = (
                pa.ListArray.from_arrays(offsets, pa.array([x for c in found for x in of(c)], kind))
                for of, kind in ((Counter.keys, pa.int32()), (Counter.values, pa.int64()))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "times"]
            )

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return picked.transform(in_tasks, run, "doc_id long, n long, terms array<int>, times array<long>")


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        none = np.empty(0, np.int64)
        self.kept = [(none, none, np.empty(0, bool))] * items
        self.least = np.ones(items, np.int64)

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.least[item])
        if not len(good):
            return
        kept = [np.concatenate([old, new[good]]) for old, new in zip(self.kept[item], (scores, ids, nameless), strict=True)]
        order = np.lexsort((kept[1], kept[2], -kept[0]))[: self.k]
        self.kept[item] = tuple(column[order] for column in kept)
        if len(order) == self.k:
            self.least[item] = self.kept[item][0][-1]


def best_of_tasks(posted: DataFrame, plan: Plan, weights: np.ndarray, n: int, size: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best documents of each item among those
    of a task."""
    shared = posted.sparkSession.sparkContext.broadcast((plan, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        best = Best(len(plan.items), k)
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_DOCUMENTS):
                batch = whole.slice(first, BLOCK_DOCUMENTS)
                rows = batch.num_rows
                length = batch.column(1).to_numpy(zero_copy_only=False)
                offsets = batch.column(2).offsets.to_numpy()
                row = np.repeat(np.arange(rows), np.diff(offsets))
                term = batch.column(2).flatten().to_numpy()
                times = batch.column(3).flatten().to_numpy()
                middle = 50 + 50 * length * n // max(size, 1)
                gain = weights[term] * (1_000_000_000 * times // (1_000 * times + 20 * middle[row]))
                order = np.argsort(term, kind="stable")
                present, starts = np.unique(term[order], return_index=True)
                partial = {}
                # Without any term there is still one, empty, part.
                for node, of in zip(present.tolist(), np.split(order, starts[1:]), strict=False):
                    partial[node] = np.zeros(rows, np.int64)
                    partial[node][row[of]] = gain[of]
                nameless = np.asarray(batch.column(0).is_null())
                ids = batch.column(0).fill_null(0).to_numpy()
                for item, scores in enumerate(plan.totals(partial)):
                    if scores is not None:
                        best.add(item, scores, ids, nameless)
        for item, (scores, ids, nameless) in enumerate(best.kept):
            if len(scores):
                columns = [np.full(len(scores), item, np.int64), pa.array(ids, mask=nameless), scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return posted.transform(in_tasks, run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item among what the tasks found, first per salt."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("_salt", F.pmod(F.hash("doc_id", "score"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(W.partitionBy("item", "_salt").orderBy(*order))).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("_salt")


def search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame:
    """``search`` for items that are planned together."""
    spark = docs.sparkSession
    words = sorted({word for _, of in items for word in of})
    place = {word: i for i, word in enumerate(words)}
    posted = Stage(postings(docs, words), "postings").df
    n, size = posted.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per word of the items at most.
    held = dict(posted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow().to_pandas().values.tolist())
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(words))], np.int64)
    plan = share([[place[word] for word in of] for _, of in items], len(words))
    ranked = _ranked(best_of_tasks(posted, plan, weights, n, size, k), k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(items)], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, plan_terms: int = PLAN_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score
    above 0 for each item."""
    # An item is a row with an id of its own: equal rows stay apart.
    texts = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted({w for part in terms_of(t.as_py() or b"") for w in part}) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.binary()))], ["item_id", "words"])

    split = Stage(texts.transform(in_tasks, run, "item_id long, words array<binary>").where(F.size("words") > 0), "items").df
    total = split.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // plan_terms))
    found: DataFrame | None = None
    for block in range(blocks):
        chosen = split.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block).collect()
        chosen = sorted(((r["item_id"], list(map(bytes, r["words"]))) for r in chosen), key=lambda i: (i[0] is None, i[0] or 0, i[1]))
        part = search_block(docs, chosen, k)
        found = part if found is None else found.unionByName(part)
    return found
