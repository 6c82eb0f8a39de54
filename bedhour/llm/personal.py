"""Operator 12: personal data by patterns, and terms that give it away.

Four fixed patterns find the base spans: email and network addresses, card and
telephone numbers. Their values are the protected entities. A term that stands
near an entity again and again tells who is meant even when the entity itself is
taken out, so co-occurrence over the corpus says how much each term discloses:

* the information of an entity e held by n(e) of N documents is ``log2(N / n(e))``;
* a term t in df(t) documents, near e in n(e, t) of them, gives
  ``log2(n(e, t) * N / (n(e) * df(t)))`` of it (pointwise mutual information).

The disclosure of a term is the largest share it gives of any entity's
information: 1 when it is found with that entity only. From ``remove`` on, the
term is taken out of all texts, from ``generalise`` on it is replaced by its kind
(``[NUMBER]``, ``[NAME]``, ``[WORD]``). A pair counts only if it was seen in enough
different surroundings: ``contexts`` is 2 to the entropy of the surroundings of e
in which t stands, so any number of copies of a document, or of near copies of
it, are little more than one.

Near means within ``REACH`` terms and ``NEAR`` letters before or after. Terms are
runs of ASCII letters and digits and of all other letters, A-Z lower-cased.
Co-occurrence is counted per document in tasks, then by shuffles combined on the
map side. Terms are handed to tasks in slices of at most ``SLICE_TERMS`` terms
and ``SLICE_LETTERS`` letters, one pass over the texts for each (one in general);
for counting, terms beyond one slice are counted over all words by a shuffle.

Defined results: a null or empty text has no spans; positions are code points,
the end exclusive; rows stay as they are, repeated rows and null ids included;
further columns are ignored by ``find_personal`` and kept by ``sanitise``; empty
tables give none. A text of any length is scanned whole, in time linear in it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage, in_tasks
from .search import TERM, terms_of

# Spans of the last two kinds are the method's: terms to generalise, and to remove.
KINDS = ("email", "ip", "card", "phone", "general", "removed")
GENERAL, REMOVED = 4, 5
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
REACH = 8
NEAR = 400
LEAST_CONTEXTS = 3.0
GENERALISE, REMOVE = 0.8, 0.95
SLICE_TERMS = 200_000
SLICE_LETTERS = 8 << 20

# Base patterns. Possessive forms of the stated ones: a failing run
# is not tried again from its middle, so time is linear in the text.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(TERM)
_NO_DIGITS = re.compile(r"[^0-9]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def digits_of(text: str) -> str:
    return _NO_DIGITS.sub("", text)


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one ``@``; it starts where the run of local letters
    before that does, or where the match before ended."""
    free = 0
    at = text.find("@")
    while at >= 0:
        head = text[free:at]
        start = at - len(head) + len(head.rstrip(LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    spans = [(0, *span) for span in emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.groups()):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return spans


def entity(kind: int, value: str) -> str:
    """One way of writing the value of a base span."""
    return value.translate(_LOWER) if kind == 0 else value if kind == 1 else digits_of(value)


def surroundings(text: str, start: int, end: int) -> list[str]:
    """Terms near a span. One that reaches past ``NEAR`` letters is left out."""
    low, high = max(0, start - NEAR), min(len(text), end + NEAR)
    before = [m for m in _TERM.finditer(text, low, start) if m.start() > low or not low or not _TERM.match(text[low - 1])]
    after = [m for m in _TERM.finditer(text, end, high) if m.end() < high or high == len(text) or not _TERM.match(text[high])]
    return [m.group().translate(_LOWER) for m in before[-REACH:] + after[:REACH]]


def mentions(text: str) -> Iterator[tuple[int, str, str | None, int, int]]:
    """(kind, value, term, context, first) of a text: for each entity a row per
    surroundings (term null), and one per term in them; ``first`` is 1 once per
    pair. Terms that are part of any base span are not terms."""
    spans = base_spans(text)
    hidden = {t.group().translate(_LOWER) for _, start, end in spans for t in _TERM.finditer(text, start, end)}
    seen: set[tuple] = set()
    for kind, start, end in spans:
        value = entity(kind, text[start:end])
        near = [t for t in surroundings(text, start, end) if t not in hidden]
        context = int.from_bytes(hashlib.blake2b("\0".join(near).encode(), digest_size=8).digest(), "big", signed=True)
        for term in (None, *near):
            if (kind, value, term, context) not in seen:
                seen.add((kind, value, term, context))
                first = (kind, value, term) not in seen
                seen.add((kind, value, term))
                yield kind, value, term, context, int(first)


ROWS = 20_000


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def mention_rows(docs: DataFrame) -> DataFrame:
    names = ["kind", "value", "term", "context", "first"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for batch in batches for text in batch.column(0) for row in mentions(text.as_py() or ""))
        while rows := list(islice(found, ROWS)):
            columns = zip(zip(*rows, strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    return _texts(docs).transform(in_tasks, run, "kind int, value string, term string, context long, first long")


def supported_pairs(docs: DataFrame, least_contexts: float) -> DataFrame:
    """``kind, value, term, n`` of pairs seen in enough surroundings, with the
    number of documents; the entity alone stands under a null term."""
    pair = ["kind", "value", "term"]
    places = mention_rows(docs).groupBy(*pair, "context").agg(F.count(F.lit(1)).alias("c"), F.sum("first").alias("n"))
    spread = places.groupBy(*pair).agg(
        F.sum("n").alias("n"), F.sum("c").alias("c"), F.sum(F.col("c") * F.log2("c")).alias("w")
    )
    contexts = F.pow(F.lit(2.0), F.log2("c") - F.col("w") / F.col("c"))
    # Equal shares of a whole number of contexts count as that number.
    return spread.where(contexts + 1e-9 >= least_contexts).select(*pair, "n")


def slices(terms: Stage) -> list[DataFrame]:
    """The rows of a table with a column ``term``, in parts whose terms have a
    bounded number and length."""
    n, letters = terms.df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("term")), F.lit(0))).first()
    parts = max(1, -(-n // SLICE_TERMS), -(-letters // SLICE_LETTERS))
    if parts == 1:
        return [terms.df]
    return [terms.df.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part) for part in range(parts)]


def document_counts(docs: DataFrame, wanted: Stage) -> DataFrame:
    """``term, df``: how many rows of ``docs`` hold each term. Tasks add up a
    batch of texts before anything is shuffled."""
    parts = slices(wanted)
    known = None
    if len(parts) == 1:
        known = docs.sparkSession.sparkContext.broadcast(frozenset(r["term"].encode() for r in parts[0].collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = known.value if known else None
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).cast(pa.binary()) if keep is None or keep else ():
                words = {w for part in terms_of(text.as_py() or b"") for w in part}
                counts.update(words if keep is None else words & keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"]
            )

    counted = _texts(docs).transform(in_tasks, run, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))
    return counted if known else counted.join(wanted.df, "term", "left_semi")


def disclosing_terms(
    docs: DataFrame, least_contexts: float = LEAST_CONTEXTS, generalise: float = GENERALISE
) -> DataFrame:
    """``term, disclosure``: terms that give at least the share ``generalise`` of
    an entity's information, and the largest share."""
    found = Stage(supported_pairs(docs, least_contexts), "pairs").df
    pairs = found.where(F.col("term").isNotNull()).withColumnRenamed("n", "n_both")
    alone = found.where(F.col("term").isNull()).drop("term")
    candidates = Stage(pairs.select("term").distinct(), "candidates")
    counts = document_counts(docs, candidates)
    n = docs.where(F.length("text") > 0).count()
    joined = pairs.join(alone, ["kind", "value"]).join(counts, "term")
    known = F.log2(F.lit(float(max(n, 1))) / F.col("n"))
    given = F.log2(F.col("n_both") * F.lit(float(max(n, 1))) / (F.col("n") * F.col("df")))
    share = F.when(known > 0, given / known).otherwise(F.lit(0.0))
    return joined.groupBy("term").agg(F.max(share).alias("disclosure")).where(F.col("disclosure") >= generalise)


def term_spans(
    text: str, words: Mapping[str, int], taken: list[tuple[int, int, int]]
) -> list[tuple[int, int, int]]:
    """Spans of the given terms (with their kinds) that touch no span already taken."""
    spans = []
    order = sorted((start, end) for _, start, end in taken)
    nth, covered = 0, 0
    for m in _TERM.finditer(text):
        start, end = m.span()
        while nth < len(order) and order[nth][0] < end:
            covered = max(covered, order[nth][1])
            nth += 1
        if covered <= start and (kind := words.get(m.group().translate(_LOWER))):
            spans.append((kind, start, end))
    return spans


SPAN_FIELDS = ["kind", "start", "end"]
SPANS = T.ArrayType(T.StructType([T.StructField(name, T.IntegerType()) for name in SPAN_FIELDS]))


def _spans_column(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    offsets = [0]
    for spans in rows:
        offsets.append(offsets[-1] + len(spans))
    fields = [pa.array([s[i] for spans in rows for s in spans], pa.int32()) for i in range(3)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, SPAN_FIELDS))


def with_spans(docs: DataFrame, terms: DataFrame, column: str, remove: float = REMOVE) -> DataFrame:
    """``docs`` with the spans of every text under ``column`` (a new name): kind
    (place in ``KINDS``), start and end, ordered by kind and start. ``terms`` is
    what ``disclosing_terms`` gives."""
    kind = F.when(F.col("disclosure") >= remove, REMOVED).otherwise(GENERAL)
    stored = Stage(terms.select("term", kind.alias("kind")), "terms")
    out, fields = docs, docs.columns
    at = fields.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, SPANS)])
    for nth, part in enumerate(slices(stored)):
        known = docs.sparkSession.sparkContext.broadcast({r["term"]: r["kind"] for r in part.collect()})

        def run(batches: Iterator[pa.RecordBatch], nth=nth, known=known) -> Iterator[pa.RecordBatch]:
            words = known.value
            as_bytes = frozenset(w.encode() for w in words)
            for batch in batches:
                found = []
                before = batch.column(len(fields)).to_pylist() if nth else [None] * batch.num_rows
                for text, earlier in zip(batch.column(at), before, strict=True):
                    whole = text.as_py() or ""
                    spans = [tuple(s[f] for f in SPAN_FIELDS) for s in earlier] if nth else base_spans(whole)
                    if as_bytes and any(not as_bytes.isdisjoint(p) for p in terms_of(whole.encode())):
                        spans = sorted(spans + term_spans(whole, words, spans))
                    found.append(spans)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], _spans_column(found)], [*fields, column])

        if nth:
            out = Stage(out, "spans").df
        out = out.transform(in_tasks, run, schema)
    return out


def find_personal(docs: DataFrame, remove: float = REMOVE, **thresholds: float) -> DataFrame:
    """``doc_id, found``: all spans of each row's text."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_spans(picked, disclosing_terms(picked, **thresholds), "found", remove).drop("text")


def personal_digest(found: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of their spans, and all
    spans as text."""

    def number(kind: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    names = F.array(*map(F.lit, KINDS))

    def text(spans: Column) -> Column:
        written = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(written, ",")

    base = F.filter("found", lambda s: s["kind"] < GENERAL)
    return found.select("doc_id", *map(number, range(GENERAL)), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def general_kind(word: str) -> str:
    return "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"


def sanitise(docs: DataFrame, remove: float = REMOVE, **thresholds: float) -> DataFrame:
    """The rows of ``docs`` with marks for base spans, and disclosing terms
    replaced by their kind or, from ``remove`` on, taken out. Null texts stay null."""
    at, fields = docs.columns.index("text"), docs.columns
    column = "_spans" + "_".join(["", *(f for f in fields if f.startswith("_spans"))])
    spanned = with_spans(docs, disclosing_terms(docs, **thresholds), column, remove)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, found in enumerate(batch.column(len(fields)).to_pylist()):
                parts, done = [], 0
                for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= done:
                        word = texts[i][s["start"] : s["end"]]
                        mark = MARKS[s["kind"]] if s["kind"] < GENERAL else general_kind(word) if s["kind"] == GENERAL else ""
                        parts += [texts[i][done : s["start"]], mark]
                    done = max(done, s["end"])
                if found:
                    texts[i] = "".join([*parts, texts[i][done:]])
            columns = list(batch.columns[: len(fields)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, fields)

    return in_tasks(spanned, run, docs.schema)
