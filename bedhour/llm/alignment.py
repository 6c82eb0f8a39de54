"""Operator 13: alignment of two tokenizers' ids over the same text.

Tokenizer A is a byte-level BPE file and sees a blank and the text; tokenizer B
is a sentencepiece file and sees the text, to which it adds the blank. Each id
stands for some bytes, so both lists have cumulative byte ends. Two dictionaries
lead from an end to the place of its id; the sorted intersection of their keys
slices both lists into groups, and the ids that end a slice together are linked.

Links are counted over the corpus. Two ids that end together are equal from the
end as far as the shorter one goes, so there are at most ``possible_links``
different pairs, a number fixed by the two files (about half a million for the
public ones): their counts may be broadcast whatever the size of the corpus. A
document keeps its different pairs and how often each stands in it, so neither
texts nor ids are read again for the counts.

Defined results: a text that is null, empty, or not given back byte by byte by
both tokenizers (one that holds U+2581, say) has no tokens: zeros and an empty
digest. Names of special tokens in a text are ordinary text. Rows stay as they
are, repeated rows and null ids included; further columns are ignored; no rows
give no rows. A text is cut at single blanks between other letters into parts of
about ``PART`` letters, where no token of either kind reaches across; ends are
put into dictionaries ``STRETCH`` ids at a time. So a very long text needs its
ids as arrays, but no dictionary of its size. For the figures, texts are cut at
all such blanks, and a word that came before is not aligned again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage, in_tasks, row_chunks, text_bytes
from .packing import Encoder, byte_of_letter

SPACE_MARK = "▁"
PART = 1 << 20
STRETCH = 1 << 16
# Words remembered, and the letters of the longest such word.
CACHED, KEPT = 250_000, 64
BREAK = re.compile(r"(?<=\S) (?=\S)")


class PlainEncoder(Encoder):
    """Byte-level ids where names of special tokens are ordinary text."""

    def __init__(self, definition: str):
        super().__init__(definition)
        self.whole.encode_special_tokens = True
        self.special = []


def byte_level_entries(definition: str) -> list[bytes]:
    """The bytes of each id of a byte-level file."""
    import json

    vocab = json.loads(definition)["model"]["vocab"]
    letters = byte_of_letter()
    entries = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        entries[i] = bytes(map(letters.get, piece)) if letters.keys() >= set(piece) else piece.encode()
    return entries


def piece_entries(model) -> list[bytes]:
    """The bytes of each id of a sentencepiece model; control ids have none."""
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            entries.append(bytes([int(piece[3:5], 16)]))
        else:
            entries.append(b"" if model.is_control(i) else piece.replace(SPACE_MARK, " ").encode())
    return entries


def possible_links(a: list[bytes], b: list[bytes]) -> int:
    """Number of id pairs that can end together: one is the end of the other."""

    def inside(few: list[bytes], many: list[bytes], whole: bool) -> int:
        known: dict[bytes, int] = {}
        for entry in few:
            known[entry] = known.get(entry, 0) + 1
        return sum(known.get(entry[at:], 0) for entry in many for at in range(0 if whole else 1, len(entry)))

    return inside(a, b, True) + inside(b, a, False)


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray, stretch: int = STRETCH) -> tuple[np.ndarray, np.ndarray]:
    """How many ids of A, and of B, lie up to each end that both have."""
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    from_a = from_b = 0
    while from_a < len(ends_a):
        to_a = min(from_a + stretch, len(ends_a))
        to_b = int(np.searchsorted(ends_b, ends_a[to_a - 1], side="right"))
        at_a = dict(zip(ends_a[from_a:to_a].tolist(), range(from_a + 1, to_a + 1), strict=True))
        at_b = dict(zip(ends_b[from_b:to_b].tolist(), range(from_b + 1, to_b + 1), strict=True))
        common = sorted(at_a.keys() & at_b.keys())
        cuts_a += map(at_a.__getitem__, common)
        cuts_b += map(at_b.__getitem__, common)
        from_a, from_b = to_a, to_b
    return np.array(cuts_a, np.int64), np.array(cuts_b, np.int64)


# Ids of A and of B, their groups as text, the links as 64-bit numbers.
Word = tuple[int, int, bytes, bytes]


class Aligner:
    """Both tokenizers, and what their ids stand for."""

    def __init__(self, definition: str, model: bytes):
        import sentencepiece

        self.a = PlainEncoder(definition)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.entries = byte_level_entries(definition), piece_entries(self.b)
        self.sizes = tuple(np.array(list(map(len, e)), np.int64) for e in self.entries)
        # A piece with the mark behind another letter would reach across a cut.
        self.parts = not any(SPACE_MARK in self.b.id_to_piece(i).lstrip(SPACE_MARK) for i in range(len(self.entries[1])))
        a, b = ([str(i).encode() for i in range(len(e))] for e in self.entries)
        # An id as written inside its side of a group, and at the end of it.
        self.known: dict[str, Word | None] = {}
        self.written = [i + sep for ids, seps in ((a, b",|"), (b, b",;")) for sep in (seps[:1], seps[1:]) for i in ids]

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text, by parts if it is long. Each part begins with the
        blank that A reads and B adds."""
        cuts = [-1]
        while self.parts and len(text) - cuts[-1] > PART and (found := BREAK.search(text, cuts[-1] + PART)):
            cuts.append(found.start())
        found_a, found_b = [], []
        for first, last in pairwise([*cuts, len(text)]):
            part = text[first + 1 : last]
            found_a.append(self.a.ids(" " + part).astype(np.int64))
            found_b.append(np.array(self.b.encode(part), np.int64))
        return np.concatenate(found_a), np.concatenate(found_b)

    def align(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B, and the places after which both are cut."""
        none = np.empty(0, np.int64)
        if not text:
            return none, none, none, none
        whole = b" " + text.encode()
        both = self.ids(text)
        for ids, entries in zip(both, self.entries, strict=True):
            if b"".join(map(entries.__getitem__, ids.tolist())) != whole:
                return none, none, none, none
        ends = (np.cumsum(size[ids]) for ids, size in zip(both, self.sizes, strict=True))
        return *both, *common_cuts(*ends)

    def groups_text(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        if not len(a):
            return b""
        n_a, n_b = map(len, self.entries)
        kind_a, kind_b = a.copy(), b + 2 * n_a
        kind_a[cuts_a - 1] += n_a
        kind_b[cuts_b - 1] += n_b
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(np.concatenate([[0], cuts_b[:-1]]), np.diff(cuts_a, prepend=0))] = kind_a
        order[np.arange(len(b)) + np.repeat(cuts_a, np.diff(cuts_b, prepend=0))] = kind_b
        return b"".join(map(self.written.__getitem__, order.tolist()))[:-1]

    def links(self, a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> np.ndarray:
        """One link per slice, as ``id of A * number of B's ids + id of B``."""
        return a[cuts_a - 1] * len(self.entries[1]) + b[cuts_b - 1]


    def figures(self, texts: list[str | None]) -> list[list[Word]]:
        """The words of each text in order; none if the text has no tokens."""
        words = [(BREAK.split(t) if self.parts else [t]) if t else [] for t in texts]
        new = {w for of in words for w in of} - self.known.keys()
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = {w for of in words for w in of}
        self.learn(sorted(w for w in new if len(w) <= KEPT))
        for w in new:
            if len(w) > KEPT:
                self.learn([w])
        found = [[self.known[w] for w in of] for of in words]
        for w in new:
            if len(w) > KEPT:
                del self.known[w]
        return [[] if None in of else of for of in found]

    def learn(self, words: list[str]) -> None:
        """Align words, all at once with blanks between them."""
        apart = [w for w in words if len(words) > 1 and (w[:1].isspace() or w[-1:].isspace())]
        for word in apart:
            self.learn([word])
        together = [w for w in words if not apart or not (w[:1].isspace() or w[-1:].isspace())]
        if not together:
            return
        found = a, b, cuts_a, cuts_b = self.align(" ".join(together))
        if not len(a):
            for word in together if len(together) > 1 else []:
                self.learn([word])
            if len(together) == 1:
                self.known[together[0]] = None
            return
        ends = np.cumsum(self.sizes[0][a])[cuts_a - 1]
        last = np.searchsorted(ends, np.cumsum([1 + len(w.encode()) for w in together]), side="right")
        groups, links = self.groups_text(*found).split(b";"), self.links(*found)
        ids_a, ids_b = np.diff(cuts_a[last - 1], prepend=0), np.diff(cuts_b[last - 1], prepend=0)
        first = 0
        for word, to, n_a, n_b in zip(together, last.tolist(), ids_a.tolist(), ids_b.tolist(), strict=True):
            self.known[word] = (n_a, n_b, b";".join(groups[first:to]), links[first:to].tobytes())
            first = to


_aligners: dict[int, Aligner] = {}


def aligner(definition: str, model: bytes) -> Aligner:
    key = hash((definition, model))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(definition, model)
    return _aligners[key]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(list(map(len, rows)))]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def align(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_cuts, b_cuts``: the ids of both tokenizers, and
    for each group the number of ids up to its end."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(*shared.value)
        for batch in batches:
            found = [work.align(t.as_py()) for t in batch.column(1)]
            columns = [_lists([f[i] for f in found], pa.int32()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
    return _texts(docs).transform(in_tasks, run, schema)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _links_of_documents(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """The figures of each document, its digest, and its different links with
    how often each stands in it."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(*shared.value)
        for batch in batches:
            figures, digests, links, times = [], [], [], []
            texts = batch.column(1)
            for first, last in row_chunks(text_bytes(texts)[1]):
                for words in work.figures(texts[first:last].to_pylist()):
                    linked = np.frombuffer(b"".join([w[3] for w in words]), np.int64)
                    # Every group ends with one link.
                    figures.append((sum(w[0] for w in words), sum(w[1] for w in words), len(linked), len(linked)))
                    digests.append(hashlib.sha256(b";".join([w[2] for w in words])).hexdigest() if words else "")
                    different, n = np.unique(linked, return_counts=True)
                    links.append(different)
                    times.append(n)
            counts = [pa.array(column, pa.int64()) for column in (zip(*figures, strict=True) if figures else ((),) * 4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), _lists(links, pa.int64()), _lists(times, pa.int32())],
                ["doc_id", *FIGURES, "groups_sha256", "links", "times"],
            )

    figures = ", ".join(f"{name} long" for name in FIGURES)
    schema = f"doc_id long, {figures}, groups_sha256 string, links array<long>, times array<int>"
    return _texts(docs).transform(in_tasks, run, schema)


def link_counts(documents: DataFrame, ids_b: int) -> DataFrame:
    """``link, n, best`` over the corpus: how many links hold the pair, and
    whether no pair of its id of B has more. Rows are added up in the tasks
    first, so a common pair is a row per task."""
    pairs = documents.select(F.inline(F.arrays_zip(F.col("links").alias("link"), F.col("times").alias("t"))))
    counted = pairs.groupBy("link").agg(F.sum("t").alias("n")).withColumn("_b", F.col("link") % ids_b)
    most = counted.groupBy("_b").agg(F.max("n").alias("_most"))
    return counted.join(most, "_b").select("link", "n", (F.col("n") == F.col("_most")).alias("best"))


def alignment_figures(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for every row of ``docs``."""
    spark = docs.sparkSession
    work = aligner(definition, model)
    written = Stage(_links_of_documents(docs, definition, model), "links")
    counted = link_counts(written.df, len(work.entries[1])).toArrow()
    if counted.num_rows > possible_links(*work.entries):
        raise ArithmeticError("ids are linked that cannot end together")
    link, n, best = (counted.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    order = np.argsort(link)
    shared = spark.sparkContext.broadcast((link[order], n[order], best[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, top = shared.value
        for batch in batches:
            links, times = (batch.column(i) for i in (6, 7))
            offsets = links.offsets.to_numpy()
            at = np.searchsorted(known, links.flatten().to_numpy())
            often = times.flatten().to_numpy().astype(np.int64)
            sums = []
            for values in (often * top[at], often * count[at]):
                upto = np.concatenate([[0], np.cumsum(values)])
                sums.append(pa.array(upto[offsets[1:] - offsets[0]] - upto[offsets[:-1] - offsets[0]], pa.int64()))
            columns = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *sums, batch.column(5)], ["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"]
            )

    schema = f"doc_id long, {', '.join(f'{name} long' for name in FIGURES)}, n_best long, count_sum long, groups_sha256 string"
    return written.df.transform(in_tasks, run, schema)
