"""Operator 9: secret scan by character Markov models.

Three fixed patterns give the base spans. Beyond them, every run of
``[A-Za-z0-9+/_=-]`` of ``least_length`` or more letters is scored by two
first-order Markov models, one of random strings and one of ordinary
identifiers: the log-likelihood ratio is summed over its letter pairs, and a run
whose ratio per letter reaches ``threshold`` is a span of kind ``markov`` unless
it touches a base span.

The models are trained on labelled samples. Identifiers of the corpus are
ordinary, ``sample`` of them. Random are as many strings: half are seeded base62
and base64 strings, and up to a quarter each the corpus's own assigned values and
access keys, so no kind, however common, decides alone. Runs of hex digits (and
of digits) are left out: they are base spans, and would teach that other letters
are not random. Strings of the corpus are chosen by hash from all of them; pair
counts are smoothed, so without identifiers nothing is added.

Defined results: a null or empty text has no spans; positions are code points,
the end exclusive; rows stay as they are, repeated rows and null ids included;
further columns are ignored by ``find_secrets`` and kept by ``redact``; a text of
any length is scanned whole; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, in_tasks

SAMPLE = 5_000
SPARE, BYTES_EACH = 8, 16
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = np.full(128, len(ALPHABET), np.int64)
for _i, _c in enumerate(ALPHABET):
    CODE[ord(_c)] = _i

# Base kinds, patterns and least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST_HEX)
_NAMES = ("password", "passwd", "secret", "token", "api")
LIKE_HEX = r"^[0-9a-fA-F+/_.=-]+$"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{7,63}"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    spans = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        spans += [
            (m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE
        ]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def training_strings(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], list[str]]:
    """At most ``sample`` random strings and as many ordinary ones."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))

    def of_kind(pattern: str, group: int, kind: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)))
        return F.transform(found, lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))

    values = F.concat(of_kind(f"(?i){ASSIGN}", 2, 0), of_kind(f"({ACCESS})", 1, 1))
    random = rows.select(F.explode(values).alias("value")).select("value.kind", "value.word")
    random = random.where((F.length("word") >= LEAST_VALUE) & ~F.col("word").rlike(LIKE_HEX))
    random = random.select("kind", F.substring("word", 1, 64).alias("word"), F.xxhash64("word").alias("at")).distinct()
    identifiers = F.regexp_extract_all("text", F.lit(rf"(?<![A-Za-z0-9_-])({IDENTIFIER})(?![A-Za-z0-9_-])"), F.lit(1))
    # Frequent words count by their frequency: places in texts are drawn, not words.
    ordinary = rows.select("doc_id", F.posexplode(identifiers).alias("place", "word")).select(
        "word", F.xxhash64("word", "doc_id", "place").alias("at")
    )
    # Runs of hex digits and access keys are random strings.
    ordinary = ordinary.where(~F.col("word").rlike(r"^(AKIA[A-Z0-9]{14,}|.*[0-9a-f]{16,}.*)$"))

    # What reaches the driver must not grow with the corpus, so rows are thinned
    # by their hash first: a few times as many as wanted stay. Identifiers are
    # taken to be one in ``BYTES_EACH`` bytes.
    values_found = Stage(random, "secret-values")
    n_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0

    def chosen(words: DataFrame, of: int, most: int = sample) -> list[str]:
        share = min(1.0, SPARE * most / max(of, 1))
        thin = words.where(F.pmod("at", F.lit(1 << 30)) < int(share * (1 << 30)))
        return [r["word"] for r in thin.orderBy("at", "word").limit(most).collect()]

    own = []
    for kind in (0, 1):
        of_this = values_found.df.where(F.col("kind") == kind)
        own += chosen(of_this, of_this.count(), sample // 4)
    values_found.drop()
    return seeded_strings(sample // 2) + own, chosen(ordinary, n_bytes // BYTES_EACH)


def seeded_strings(n: int) -> list[str]:
    """The same base62 and base64 strings at every call, of 20 to 64 letters."""
    draw = np.random.default_rng(9)
    alphabets = [ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + "-_"]
    return ["".join(draw.choice(list(alphabets[max(i % 4 - 1, 0)]), draw.integers(20, 65))) for i in range(n)]


def pair_logs(strings: list[str], smoothing: float = 0.5) -> np.ndarray:
    """Log probability of a letter after another, or after the start."""
    size = len(ALPHABET)
    counts = np.full((size + 1, size), smoothing)
    for word in strings:
        codes = CODE[np.frombuffer(word.encode("ascii", "replace"), np.uint8) & 127]
        codes = codes[codes < size]
        if len(codes):
            np.add.at(counts, (np.concatenate([[size], codes[:-1]]), codes), 1)
    # A pair not seen falls back on the letter's own share.
    own = counts[:, :].sum(0)
    counts += own / own.sum() * size * smoothing
    return np.log(counts / counts.sum(1, keepdims=True))


def train(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Log-likelihood ratio of every letter pair, random over ordinary."""
    random, ordinary = training_strings(docs, sample)
    return pair_logs(random) - pair_logs(ordinary)


def ratio(word: str, logs: np.ndarray) -> float:
    """Log-likelihood ratio per letter."""
    codes = CODE[np.frombuffer(word.encode("ascii"), np.uint8)]
    return float(logs[np.concatenate([[len(ALPHABET)], codes[:-1]]), codes].sum()) / len(word)


def all_spans(text: str, logs: np.ndarray, run: re.Pattern, threshold: float) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    added = []
    for m in run.finditer(text):
        start, end = m.span()
        if not any(a < end and start < b for a, _, b in spans) and ratio(m.group(), logs) >= threshold:
            added.append((start, 3, end))
    return sorted(spans + added)


def runs(least_length: int) -> re.Pattern:
    letters = re.escape(ALPHABET)
    return re.compile(f"(?<![{letters}])[{letters}]{{{least_length},}}")


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find_secrets(
    docs: DataFrame, logs: np.ndarray | None = None, least_length: int = 20, threshold: float = 0.3
) -> DataFrame:
    """``doc_id``, counts of the base kinds, their digest, and all spans."""
    logs = train(docs) if logs is None else logs
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = runs(least_length)
        for batch in batches:
            rows: list[tuple[int, int, int, str, str]] = []
            for text in batch.column(1):
                spans = all_spans(text.as_py() or "", logs, pattern, threshold)
                base = [s for s in spans if s[1] < 3]
                kinds = [k for _, k, _ in base]
                rows.append(
                    (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(digest(base).encode()).hexdigest(), digest(spans))
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.transform(in_tasks, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(
    docs: DataFrame, logs: np.ndarray | None = None, least_length: int = 20, threshold: float = 0.3, mark: str = "[secret]"
) -> DataFrame:
    """The rows of ``docs`` with every span replaced by ``mark``, and ``n_chars``,
    where there is one, set to the new length. Null texts stay null."""
    logs = train(docs) if logs is None else logs
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = runs(least_length)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, text in enumerate(texts):
                spans = all_spans(text, logs, pattern, threshold) if text else []
                if spans:
                    parts, done = [], 0
                    for start, _, end in spans:
                        if start >= done:
                            parts += [text[done:start], mark]
                        done = max(done, end)
                    texts[i] = "".join([*parts, text[done:]])
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.transform(in_tasks, run, docs.schema)
    if "n_chars" in docs.columns:
        same = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.coalesce(same, F.col("n_chars")))
    return out.select(*docs.columns)
