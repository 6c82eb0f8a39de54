"""Operator 1: cost-balanced packing of documents into token sequences.

A document's ids are cut and packed inside the task that tokenises it, so ids
never cross the network. A task packs its documents in groups of about
``group_tokens`` ids:

* a document over the capacity first fills whole sequences;
* the rests, longest first, each go to the sequence of lowest cost that still
  has room for them. The cost of a sequence is the sum over its pieces of
  ``linear * n + quadratic * n * n``: the work of the dense layers and that of
  attention inside a document;
* a rest that fits nowhere is cut: its head fills the roomiest sequence.

A group has ``tokens // capacity`` full sequences, and the remainder goes to
sequences of its binary digits (1300 = 1024 + 256 + 16 + 4), so nothing is
padded. A group is lost and redone with its task; the ids of sequences are made
from the partition and a counter, so a repeated task gives the same ones.

Defined results: a null text is empty, and an empty text is one piece holding
the end id; rows are packed as they are, repeated rows and null ids included;
further columns are ignored; no rows give no pieces. A text of any length is
one task's work, its ids are held at once.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import in_tasks, kept_by_stage

# Word pattern of the byte-level tokenizer files (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself if
    printable, else the next letter from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    return letters


class Encoder:
    """Ids of a byte-level BPE file, the same as ``tokenizers`` gives. Where the
    file is plain enough, its merges run in ``tiktoken``, which is several times
    faster; texts with special strings go to ``tokenizers``."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        parsed = json.loads(definition)
        vocab = parsed["model"]["vocab"]
        self.code = "H" if max(vocab.values()) < 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        self.special = [t["content"] for t in parsed.get("added_tokens", [])]
        self.fast = self._ranks(parsed, vocab)

    def _ranks(self, parsed: dict, vocab: dict[str, int]):
        """The same merges by rank, where the file is plain enough for that."""
        merged = [m if isinstance(m, str) else " ".join(m) for m in parsed["model"]["merges"]]
        in_order = all(vocab.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merged))
        pre = parsed.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if not (in_order and plain) or parsed.get("normalizer"):
            return None
        import tiktoken

        letters = byte_of_letter()
        ranks = {
            bytes(letters[c] for c in piece): i
            for piece, i in vocab.items()
            if piece not in self.special
        }
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, self.dtype)
        ids = None
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                ids = self.fast.encode_ordinary(text)
            except Exception:  # its pattern matcher gives up on very long white space
                ids = None
        if ids is None:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.frombuffer(array(self.code, ids), self.dtype)


_encoders: dict[int, Encoder] = kept_by_stage()


def encoder(definition: str) -> Encoder:
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


@dataclass(frozen=True)
class Costs:
    """Cost of a piece of n ids: ``linear * n + quadratic * n * n``."""

    linear: float = 1.0
    quadratic: float = 1.0 / 2048

    def of(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n


def pack_group(lengths: list[int], capacity: int, costs: Costs) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one group."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    rests: list[tuple[int, int, int]] = []
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for i in range(whole):
            pieces.append((doc, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rests.append((n % capacity, doc, whole * capacity))
    total = sum(n for n, _, _ in rests)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << b for b in reversed(range(capacity.bit_length())) if (total % capacity) >> b & 1]
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    rests.sort(key=lambda r: (-r[0], r[1]))
    for n, doc, start in rests:
        while n:
            fits = np.where(room >= n, cost, np.inf)
            best = int(fits.argmin())
            if np.isinf(fits[best]):
                best = int(room.argmax())
            used = min(n, int(room[best]))
            pieces.append((doc, start, used, sequence + best, sizes[best] - int(room[best])))
            room[best] -= used
            cost[best] += costs.of(used)
            start, n = start + used, n - used
    return pieces


def pack(
    docs: DataFrame,
    definition: str,
    capacity: int = 2048,
    end_id: int = 1,
    costs: Costs = Costs(),
    group_tokens: int = 2_000_000,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id``, ``text``); ``definition`` is
    the content of a byte-level tokenizer file. ``with_ids`` adds the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    schema = T.StructType([*PIECES.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]) if with_ids else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(shared.value)
        end = np.array([end_id], made.dtype)
        base = TaskContext.get().partitionId() << 33
        waiting: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, held, base
            pieces = pack_group([len(ids) for _, ids in waiting], capacity, costs)
            rows: dict[str, list] = {f.name: [] for f in schema.fields}
            for doc, start, n, sequence, offset in pieces:
                doc_id, ids = waiting[doc]
                part = ids[start : start + n]
                rows["doc_id"].append(doc_id)
                rows["start"].append(start)
                rows["length"].append(n)
                rows["ids_crc32"].append(zlib.crc32(part.astype("<u4").tobytes()))
                rows["doc_tokens"].append(len(ids))
                rows["sequence_id"].append(base + sequence)
                rows["offset"].append(offset)
                if with_ids:
                    rows["ids"].append(part.tolist())
            base += 1 + max(sequence for _, _, _, sequence, _ in pieces)
            waiting, held = [], 0
            kinds = {name: pa.int64() for name in rows} | {"ids": pa.list_(pa.int32())}
            return pa.RecordBatch.from_pydict({k: pa.array(v, kinds[k]) for k, v in rows.items()})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([made.ids(text.as_py()), end])
                waiting.append((doc_id, ids))
                held += len(ids)
                if held >= group_tokens:
                    yield flush()
        if waiting:
            yield flush()

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return picked.transform(in_tasks, run, schema)
