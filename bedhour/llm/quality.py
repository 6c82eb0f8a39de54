"""Operator 6: quality rules and n-gram perplexity.

The model is a modified Kneser-Ney model over the bytes of all texts (A-Z
lower-cased), order ``ORDER``: two letters of any script, or the end of a word
and the beginning of the next, so it grows with the corpus and sees some word
order. Spark counts in how many texts each gram stands; a task counts its own
and the counts are summed by gram. Continuation counts, discounts and back-off
weights are further aggregations of that table. Each order is a table of grams
with their counts and one of contexts with their totals; joined, they give every
gram of the texts its probability. A text must not vouch for itself, so a gram's
probability is that of the model without one text that holds it: its count is
less one, and so is a continuation count that rests on that text alone.

The gram table with its probabilities is written once. Its ``MODEL_ENTRIES`` most
frequent grams are broadcast as sorted arrays; if there are more, the others are
joined with the texts' grams, as the same 32-bit numbers.

A text's perplexity is that of its bytes from the last of the first gram on. Per
language, an exact histogram of the log perplexities of all texts gives the
quartiles; the band reaches ``fences`` quartile ranges beyond them (at least
``least_width``), more for short texts and less for long ones. Copies and near
copies make a text likely without fault of its own, so the lower end is at most
``LOW_SHARE`` of the lower quartile: text that says one thing over and over.
Texts outside the band are rejected, and so are those that fail the base rules.

Defined results: a null text is empty; it has no words and fails the base rules;
a text shorter than a gram has no perplexity and is judged by the rules alone; a
text of any length is scored whole; null is a language of its own; rows stay as they are, repeated rows and null ids
included; further columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import (
    IS_SPACE,
    LOWER,
    MIX_1,
    MIX_2,
    Stage,
    in_tasks,
    mix,
    per_row,
    prefix_sums,
    row_chunks,
    substring_hashes,
    text_bytes,
    word_spans,
)

ORDER = 6
# Entries of a table that are broadcast; the others are joined.
MODEL_ENTRIES = 1 << 22
# Tables of the model up to this size are broadcast to the gram table; there are
# two per order, and the driver makes each.
TABLE_BYTES = 1 << 20
# Counted grams that a task holds, and rows of a batch that it hands on.
HELD_GRAMS, OUT_ROWS = 1 << 21, 1 << 16
# A gram and its count are held as one number; the count has the bits that the
# gram leaves, so it is of no more texts than they can count.
COUNT_BITS = np.uint64(64 - 8 * ORDER)
MOST_TEXTS = np.uint64((1 << int(COUNT_BITS)) - 1)
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
STEPS = 200  # histogram steps per unit of log2 perplexity
# Half the width of a band beyond the quartiles, in quartile ranges, for a text
# of ``TYPICAL_WORDS``; it goes with one over the root of the length, down to a share.
FENCES, TYPICAL_WORDS, LEAST_SHARE = 5.0, 300, 0.4
# The lower end of a band is this share of the lower quartile, if that is less.
LOW_SHARE = 0.25


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def rule_metrics(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """The base figures of each text."""
    rows = len(starts) - 1
    begin, end, row = word_spans(data, starts)
    sums = prefix_sums(data)
    n_words = np.bincount(row, minlength=rows)
    letters = ((data & 0xC0) != 0x80) & ~IS_SPACE[data]

    # Lines: cut after each line feed and at row starts.
    cuts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, starts]))
    line_begin, line_end = cuts[:-1], cuts[1:].copy()
    line_end -= data[line_end - 1] == 10 if len(line_end) else 0
    words_before = np.searchsorted(begin, cuts)
    worded = words_before[1:] > words_before[:-1]
    line_begin, line_end = line_begin[worded], line_end[worded]
    line_row = np.searchsorted(starts, line_begin, side="right") - 1
    own = mix(np.arange(1, rows + 1, dtype=np.uint64))
    _, later = repeated(mix(substring_hashes(sums, line_begin, line_end) ^ own[line_row]))

    word = substring_hashes(sums, begin, end)
    covered = np.zeros(len(word), bool)
    if len(word) > 2:
        grams = mix(mix(word[:-2] * MIX_1 + word[1:-1]) * MIX_2 + word[2:])
        inside = row[:-2] == row[2:]
        at = np.flatnonzero(inside)
        twice, _ = repeated(mix(grams[at] ^ own[row[at]]))
        for shift in range(3):
            covered[at[twice] + shift] = True
    return {
        "n_words": n_words,
        "word_chars": per_row(letters, starts),
        "n_symbols": per_row(SYMBOLS[data], starts),
        "n_dup_lines": np.bincount(line_row[later], minlength=rows),
        "n_repeat_words": np.bincount(row[covered], minlength=rows),
    }


def byte_grams(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All grams of texts as integers, and the row of each."""
    size = len(data) - ORDER + 1
    if size < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = LOWER[data].astype(np.int64)
    grams = np.zeros(size, np.int64)
    for at in range(ORDER):
        grams = grams << 8 | low[at : at + size]
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = row[:size] == row[ORDER - 1 :]
    return grams[inside], row[:size][inside]


def _texts_per_gram(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of some texts, and in how many of them each stands."""
    grams, row = byte_grams(data, starts)
    if len(starts) - 1 <= 1 << 64 - 8 * ORDER:
        # Gram and row fit one number.
        both = np.sort(grams.view(np.uint64) << np.uint64(64 - 8 * ORDER) | row.view(np.uint64))
        once = both[new_ones(both)] >> np.uint64(64 - 8 * ORDER)
    else:
        order = np.lexsort((row, grams))
        once = grams[order][new_ones(grams[order]) | new_ones(row[order])]
    return added_up(once.astype(np.int64), None)


def new_ones(values: np.ndarray) -> np.ndarray:
    """Which of some values in order differ from the one before."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def added_up(grams: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The different grams, of grams in order, and the sums of their counts (of one each)."""
    first = np.flatnonzero(new_ones(grams))
    if counts is None:
        return grams[first], np.diff(first, append=len(grams))
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def merged(held: list[np.ndarray]) -> np.ndarray:
    """Grams with counts, each in one number (see ``COUNT_BITS``), in order and
    added up. ``held`` is emptied: no copy of it stays beside the sum."""
    both = np.concatenate(held)
    held.clear()
    both.sort()
    first = np.flatnonzero(new_ones(both >> COUNT_BITS))
    counts = np.add.reduceat(both & MOST_TEXTS, first) if len(first) else both
    both = both[first]
    both &= ~MOST_TEXTS
    both |= counts
    return both


def count_grams(docs: DataFrame) -> DataFrame:
    """``gram, n``: in how many texts each gram stands. A task adds up what it
    has counted whenever that is ``HELD_GRAMS`` numbers, and hands it on once half
    of them are different, or if more texts might not fit the bits of a count."""

    def out(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(found), OUT_ROWS):
            part = found[first : first + OUT_ROWS]
            columns = [(part >> COUNT_BITS).view(np.int64), (part & MOST_TEXTS).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        texts = 0
        for batch in batches:
            data, starts = text_bytes(batch.column(0))
            for first, last in row_chunks(starts, rows=int(MOST_TEXTS)):
                if texts + last - first > MOST_TEXTS:
                    yield from out(merged(held))
                    texts = 0
                part = data[starts[first] : starts[last]]
                grams, counts = _texts_per_gram(part, starts[first : last + 1] - starts[first])
                held.append(grams.view(np.uint64) << COUNT_BITS | counts.view(np.uint64))
                texts += last - first
                if sum(map(len, held)) >= HELD_GRAMS:
                    held = [merged(held)]
                    if len(held[0]) >= HELD_GRAMS // 2:
                        yield from out(held.pop())
                        texts = 0
        if held:
            yield from out(merged(held))

    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .transform(in_tasks, run, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and from 3 on."""
    found = {r["n"]: r["k"] for r in table.where(F.col("n") <= 4).groupBy("n").agg(F.count("*").alias("k")).collect()}
    n1, n2, n3, n4 = (found.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5

    def d(k: int, here: int, above: int) -> float:
        return min(max(k - (k + 1) * y * above / here if here else k * y, 0.0), float(k))

    return d(1, n1, n2), d(2, n2, n3), d(3, n3, n4)


def cut(n: Column, discounts: tuple[float, float, float]) -> Column:
    """The discount of a count."""
    one, two, more = map(F.lit, discounts)
    return F.when(n <= 0, F.lit(0.0)).when(n == 1, one).when(n == 2, two).otherwise(more)


def low_bytes(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 8 * order) - 1))


@dataclass
class Level:
    """One order: ``gram, n`` of its grams, ``context, total, mass`` (the sums of
    counts and of discounts) of their contexts, and the discounts."""

    counts: Stage
    contexts: Stage
    discounts: tuple[float, float, float]


@dataclass
class Model:
    """Levels of order 1 to ``ORDER``, in the shared folder."""

    levels: list[Level]

    def drop(self) -> None:
        for level in self.levels:
            level.counts.drop()
            level.contexts.drop()


def train(docs: DataFrame) -> Model:
    """The model of all texts. Nothing of it reaches the driver."""
    levels: list[Level] = []
    counts = Stage(count_grams(docs), "quality-grams")
    for order in range(ORDER, 0, -1):
        table = counts.df
        discounts = _discounts(table)
        sums = table.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(cut(F.col("n"), discounts)).alias("mass")
        )
        levels.insert(0, Level(counts, Stage(sums, "quality-contexts"), discounts))
        if order > 1:
            # Continuation count: after how many bytes the shorter gram stands.
            shorter = low_bytes(F.col("gram"), order - 1).alias("gram")
            counts = Stage(table.groupBy(shorter).agg(F.count("*").alias("n")), "quality-grams")
    return Model(levels)


def chances(grams: DataFrame, model: Model, own: bool) -> DataFrame:
    """``gram, n, log2`` of every gram of ``grams``; ``own`` says that they are
    those of the model's texts, one of which is left out. A gram that a level
    does not hold has no share there, one whose context it does not hold backs
    off whole."""
    table = grams.select("gram", "n")
    for order, level in enumerate(model.levels, 1):
        part = low_bytes(F.col("gram"), order)
        counts = level.counts.small(TABLE_BYTES).select(F.col("gram").alias("_part"), F.col("n").alias(f"_n{order}"))
        contexts = level.contexts.small(TABLE_BYTES).select(
            F.col("context").alias("_context"), F.col("total").alias(f"_total{order}"), F.col("mass").alias(f"_mass{order}")
        )
        table = table.withColumns({"_part": part, "_context": F.shiftright(part, 8)})
        if own and order == ORDER:
            table = table.withColumn(f"_n{order}", F.col("n")).drop("_part")
        else:
            table = table.join(counts, "_part", "left").drop("_part")
        table = table.join(contexts, "_context", "left").drop("_context")
    # From the longest down: what is left of the counts without one text.
    gone = F.lit(int(own))
    for order in range(ORDER, 0, -1):
        n = F.coalesce(f"_n{order}", F.lit(0))
        table = table.withColumns({f"_left{order}": n - gone, f"_gone{order}": gone})
        gone = F.when(F.col(f"_left{order}") <= 0, F.col(f"_gone{order}")).otherwise(F.lit(0))
    chance = F.lit(1.0 / 256)
    for order, level in enumerate(model.levels, 1):
        left, before = F.col(f"_left{order}"), F.coalesce(f"_n{order}", F.lit(0))
        total = F.coalesce(f"_total{order}", F.lit(0)) - F.col(f"_gone{order}")
        mass = F.col(f"_mass{order}") - cut(before, level.discounts) + cut(left, level.discounts)
        share = F.when(total > 0, (left - cut(left, level.discounts)) / total).otherwise(F.lit(0.0))
        weight = F.when(total > 0, F.least(F.greatest(mass / total, F.lit(1e-6)), F.lit(1.0))).otherwise(F.lit(1.0))
        table = table.withColumn(f"_chance{order}", share + weight * chance)
        chance = F.col(f"_chance{order}")
    return table.select("gram", "n", F.log2(F.least(F.greatest(chance, F.lit(1e-9)), F.lit(1.0))).cast("float").alias("log2"))


class Table:
    """Grams with their log2 probabilities. The most frequent ones, at most
    ``MODEL_ENTRIES``, are sorted arrays for a broadcast; the ``rest``, if any,
    stays in the shared folder and is joined. A gram of the rest is rare, so no
    task of that join gets many rows of one gram."""

    def __init__(self, chances: DataFrame, name: str):
        self.stage = Stage(chances, name)
        df = self.stage.df
        power = F.floor(F.log2("n")).cast("int")
        sizes = {r["power"]: r["k"] for r in df.groupBy(power.alias("power")).agg(F.count("*").alias("k")).collect()}
        least, held = 1 << (max(sizes, default=0) + 1), 0
        for at in sorted(sizes, reverse=True):
            held += sizes[at]
            if held > MODEL_ENTRIES:
                break
            least = 1 << at
        head = df.where(F.col("n") >= least).select("gram", "log2").toArrow()
        keys, values = (head.column(i).to_numpy() for i in range(2))
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.rest = df.where(F.col("n") < least).select("gram", "log2") if held > len(self.keys) else None


class Scorer:
    """Log2 probabilities of the grams a table's arrays hold."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def log2(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The probability of each gram, 0 if it is not held, and whether it is."""
        if not len(self.keys):
            return np.zeros(len(grams), np.float32), np.zeros(len(grams), bool)
        # Each gram is looked up once, however often it stands in the texts.
        order = np.argsort(grams)
        new = new_ones(grams[order])
        keys, nth = grams[order][new], np.cumsum(new) - 1
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        log2, held = np.empty(len(grams), np.float32), np.empty(len(grams), bool)
        log2[order], held[order] = np.where(found, self.values[at], np.float32(0))[nth], found[nth]
        return log2, held


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with_content(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.col("text"), F.lit("/"), F.col("lang")).alias("content"),
        F.col("text").cast("string").alias("text"),
    )


def _rest_means(docs: DataFrame, table: Table) -> Stage:
    """``_content, mean``: the mean log2 probability of the grams of a text that
    the table's arrays do not hold, by a join with the rest of the table. Equal
    texts have equal means, so rows are told apart by content only."""
    shared = docs.sparkSession.sparkContext.broadcast(table.keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, np.zeros(len(shared.value), np.float32))
        for batch in batches:
            data, starts = text_bytes(batch.column(3))
            content = batch.column(2).to_numpy()
            for first, last in row_chunks(starts):
                grams, row = byte_grams(data[starts[first] : starts[last]], starts[first : last + 1] - starts[first])
                missed = ~scorer.log2(grams)[1]
                columns = [content[first:last][row[missed]], grams[missed]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_content", "gram"])

    missed = _with_content(docs).transform(in_tasks, run, "_content long, gram long")
    return Stage(missed.join(table.rest, "gram").groupBy("_content").agg(F.avg("log2").alias("mean")), "quality-rest")


def score(docs: DataFrame, model: Model, own: bool = False) -> DataFrame:
    """``doc_id, lang, content`` (hash of text and language), the base figures
    and ``log2_perplexity`` per row. ``own``: ``docs`` are the model's texts."""
    grams = model.levels[-1].counts.df if own else count_grams(docs)
    table = Table(chances(grams, model, own), "quality-chances")
    shared = docs.sparkSession.sparkContext.broadcast((table.keys, table.values))
    names = ["doc_id", "lang", "content", *FIGURES, "grams", "missed", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            data, starts = text_bytes(batch.column(3))
            for first, last in row_chunks(starts):
                part = data[starts[first] : starts[last]]
                begins = starts[first : last + 1] - starts[first]
                figures = rule_metrics(part, begins)
                columns = [pa.array(figures[f].astype(np.int64)) for f in FIGURES]
                grams, row = byte_grams(part, begins)
                log2, held = scorer.log2(grams)
                columns += [
                    pa.array(np.bincount(row, minlength=last - first)),
                    pa.array(np.bincount(row[~held], minlength=last - first)),
                    pa.array(np.bincount(row, log2.astype(np.float64), last - first).astype(np.float64)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(first, last - first) for i in range(3)], *columns], names
                )

    kinds = ", ".join([*[f"{f} long" for f in FIGURES], "grams long, missed long, bits double"])
    scores = _with_content(docs).transform(in_tasks, run, f"doc_id long, lang string, content long, {kinds}")
    bits = F.col("bits")
    if table.rest is not None:
        means = _rest_means(docs, table).small()
        scores = scores.join(means, F.col("content") == F.col("_content"), "left").drop("_content")
        bits = bits + F.col("missed") * F.coalesce("mean", F.lit(0.0))
    entropy = F.when(F.col("grams") > 0, -bits / F.col("grams"))
    return scores.withColumn("log2_perplexity", entropy).drop("grams", "missed", "bits", "mean")


def bands(scores: DataFrame, fences: float = FENCES, least_width: float = 0.1) -> DataFrame:
    """``lang, q1, q3, width`` of the log2 perplexity. Quartiles come from a
    histogram over all rows, which has few rows per language."""
    step = F.round(F.col("log2_perplexity") * STEPS).cast("int")
    histogram = (
        scores.where(F.col("log2_perplexity").isNotNull())
        .groupBy("lang", step.alias("step"))
        .agg(F.count("*").alias("n"))
    )
    upto = F.sum("n").over(W.partitionBy("lang").orderBy("step"))
    total = F.sum("n").over(W.partitionBy("lang"))
    ranked = histogram.select("lang", "step", upto.alias("upto"), total.alias("total"))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.col("total") * q, F.col("step"))) / STEPS
    width = F.greatest((F.col("q3") - F.col("q1")) * fences, F.lit(least_width))
    return (
        ranked.groupBy("lang")
        .agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
        .select("lang", "q1", "q3", width.alias("width"))
    )


def judge(docs: DataFrame, least_words: int = 50, most_repeated: int = 50, fences: float = FENCES) -> DataFrame:
    """The scores of every row with ``base_failed``, ``low``, ``high`` and ``kept``."""
    model = train(docs)
    scores = Stage(score(docs, model, own=True), "quality-scores")
    model.drop()
    limits = Stage(bands(scores.df, fences).withColumnRenamed("lang", "_lang"), "quality-bands")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    # The mean over a text's letters varies less the longer the text is.
    share = F.sqrt(F.lit(float(TYPICAL_WORDS)) / F.greatest("n_words", F.lit(1)))
    width = F.col("width") * F.greatest(share, F.lit(LEAST_SHARE))
    inside = F.coalesce(F.col("log2_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return (
        scores.df.join(limits.small(), F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .select(scores.df["*"], F.least(F.col("q1") - width, F.col("q1") * LOW_SHARE).alias("low"), (F.col("q3") + width).alias("high"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & inside)
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept. What a row's judgement depends on is
    its text and language, so these tell which rows to drop, whatever the ids.
    The helping column has a name that ``docs`` does not have."""
    name = "_rejected" + "_".join(["", *(c for c in docs.columns if c.startswith("_rejected"))])
    rejected = judge(docs, **options).where(~F.col("kept")).select(F.col("content").alias(name)).distinct()
    content = F.xxhash64(docs["text"], F.lit("/"), docs["lang"])
    return docs.join(Stage(rejected, "quality-rejected").small(), content == F.col(name), "left_anti")
