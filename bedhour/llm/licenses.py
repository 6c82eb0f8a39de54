"""Operator 2: licence scan by a positional rare-token index, DataFrame
functions only.

Templates are phrases and licence headers, as words. The index holds one posting
(template, position) for every word of every template. A template's keys are the
words of highest inverse document frequency over the scanned texts, chosen so
that every match holds one: a word of each mandatory phrase, or, without such
phrases, as many words as leave too few others for the cover. So what is found
does not depend on the counts. In each text
the licence words are picked with their positions in one pass. Then, per text:

1. the keys found are looked up, which gives (template, shift) pairs, shift
   being the key's place in the text less its place in the template, each once;
2. the other postings of these templates are intersected at that shift: the
   share of a template's words that stand where they should is its cover;
3. a header counts if its cover reaches ``least_cover`` and one of its
   mandatory key phrases stands there in full; a phrase counts only in full.

All of it happens inside one row, so there is no shuffle but the small one of
word counts, and no text or licence can become a hot group.

Defined results: a null or empty text has 0 words and no labels; words are what
the pattern finds after A-Z are lower-cased; rows stay as they are, repeated
rows and null ids included; further columns are ignored; if no text holds a
licence word, keys are chosen by spelling, and nothing is found. A text of any
length is scanned whole; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stage, ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose every place counts, with their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Opening words of licence notices, their mandatory phrases, labels.
HEADERS = (
    ("licensed under the apache license version 2 0", ("apache license",), "apache-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy", ("hereby granted free",), "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",), "bsd"),
    ("this work is licensed under the gnu general public license version 3", ("gnu general public license",), "gpl-3.0"),
    ("licensed under cc by nc 4 0", ("cc by nc",), "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license", ("mozilla public license",), "mpl"),
    ("this work is licensed under a creative commons attribution", ("creative commons attribution",), "creative-commons"),
)


@dataclass(frozen=True)
class Template:
    words: tuple[str, ...]
    label: str
    base: bool
    phrases: tuple[tuple[int, int], ...]  # mandatory: position, words


def templates(base: Mapping[str, str] = BASE_PHRASES, headers=HEADERS) -> list[Template]:
    made = [Template(tuple(p.split()), label, True, ()) for p, label in base.items()]
    for text, mandatory, label in headers:
        words = tuple(text.split())
        spots = []
        for phrase in mandatory:
            part = tuple(phrase.split())
            spots += [(i, len(part)) for i in range(len(words)) if words[i : i + len(part)] == part]
        made.append(Template(words, label, False, tuple(spots)))
    return made


def licence_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id``, ``n_words`` and the vocabulary's words in the text with their
    places (``hits``: word, at)."""
    lowered = ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    words = F.regexp_extract_all("_lowered", F.lit(f"({WORD})"), F.lit(1))
    placed = F.transform("_words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.cast("long").alias("at"))))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered.alias("_lowered"))
        .select("doc_id", words.alias("_words"))
        .select("doc_id", F.size("_words").cast("long").alias("n_words"), F.filter(placed, lambda x: x.isNotNull()).alias("hits"))
    )


def rarest_words(hits: DataFrame, found: list[Template], least_cover: float) -> dict[Template, tuple[int, ...]]:
    """Positions of each template's keys, words in the fewest texts first. A
    match needs a mandatory phrase in full, so any word of each phrase will do;
    a template without phrases takes one word more than a match may lack. What is
    collected is one count per vocabulary word."""
    counts = (
        hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
        .groupBy("word")
        .count()
    )
    seen = {r["word"]: r["count"] for r in counts.collect()}

    def keys(t: Template) -> tuple[int, ...]:
        rank = lambda i: (seen.get(t.words[i], 0), t.words[i], i)
        if t.phrases and not t.base:
            return tuple(sorted({min(range(start, start + size), key=rank) for start, size in t.phrases}))
        cover = 1.0 if t.base else least_cover
        may_lack = sum(n / len(t.words) >= cover for n in range(len(t.words)))
        return tuple(sorted(range(len(t.words)), key=rank)[: may_lack + 1])

    return {t: keys(t) for t in found}


def _places_of(word: str) -> Column:
    """Where a vocabulary word stands in a row's text."""
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["at"])


def _judged(number: int, t: Template, keys: tuple[int, ...]) -> Column:
    """One entry per shift that a place of one of the template's keys gives: the
    other postings intersected at that shift."""

    words = F.array(*[F.lit(w) for w in t.words])

    def shifts(key: int) -> Column:
        return F.transform(_places_of(t.words[key]), lambda at: at - F.lit(key))

    def at_shift(first: Column) -> Column:
        hit = F.transform(words, lambda w, i: F.coalesce(F.array_contains(F.col("_places")[w], first + i), F.lit(False)))
        return F.struct(F.lit(number).alias("template"), first.alias("first"), hit.alias("hit"))

    def weighed(m: Column) -> Column:
        cover = F.size(F.filter(m["hit"], lambda x: x)) / F.lit(float(len(t.words)))
        phrases = [F.forall(F.slice(m["hit"], start + 1, size), lambda x: x) for start, size in t.phrases]
        whole = reduce(or_, phrases) if phrases else F.lit(True)
        return F.struct(
            m["template"].alias("template"), m["first"].alias("first"), cover.alias("cover"), whole.alias("whole")
        )

    first = F.array_distinct(F.flatten(F.array(*[shifts(key) for key in keys])))
    return F.transform(F.transform(first, at_shift), weighed)


def scan_licenses(docs: DataFrame, found: list[Template] | None = None, least_cover: float = 0.8) -> DataFrame:
    """``doc_id, n_words, matches`` (label, base, first, cover) per row."""
    found = templates() if found is None else found
    vocabulary = sorted({w for t in found for w in t.words})
    stage = Stage(licence_words(docs, vocabulary), "licence-words")
    keys = rarest_words(stage.df, found, least_cover)
    places = F.map_from_entries(F.array(*[F.struct(F.lit(w), _places_of(w)) for w in vocabulary]))
    labels = F.array(*[F.lit(t.label) for t in found])
    is_base = F.array(*[F.lit(t.base) for t in found])
    key_words = sorted({t.words[i] for t, at in keys.items() for i in at})
    relevant = F.exists("hits", lambda h: h["word"].isin(key_words))
    none = F.array().cast("array<struct<template:int,first:bigint,cover:double,whole:boolean>>")
    judged = stage.df.withColumn("_places", F.when(relevant, places)).withColumn(
        "_all", F.when(relevant, F.flatten(F.array(*[_judged(i, t, keys[t]) for i, t in enumerate(found)]))).otherwise(none)
    )
    counted = F.filter(
        "_all",
        lambda m: F.when(is_base[m["template"]], m["cover"] >= 1.0).otherwise(m["whole"] & (m["cover"] >= least_cover)),
    )
    return judged.select(
        "doc_id",
        "n_words",
        F.transform(
            counted,
            lambda m: F.struct(
                labels[m["template"]].alias("label"),
                is_base[m["template"]].alias("base"),
                m["first"].alias("first"),
                m["cover"].alias("cover"),
            ),
        ).alias("matches"),
    )


def license_digest(matches: DataFrame) -> DataFrame:
    """The matches of a row as counts and joined labels."""
    base = F.filter("matches", lambda m: m["base"])
    firsts = F.transform(base, lambda m: m["first"])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda m: m["label"]))), ",")
    return matches.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["cover"])), F.lit(0.0)).alias("score"),
    )
