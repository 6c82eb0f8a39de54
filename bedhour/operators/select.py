"""Label harmonisation with user-supplied dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


def dictionary_map(dictionary: DataFrame) -> DataFrame:
    """One altername per itemstring; of repeated entries the last one counts."""
    return (
        dictionary.where(F.col("itemstring").isNotNull())
        .groupBy("itemstring")
        .agg(F.max_by("altername", "position").alias("altername"))
    )


def select_features(events: DataFrame, dictionary: DataFrame, label: str) -> DataFrame:
    """Keep rows whose label is in the dictionary and rename it. Several
    itemstrings may share an altername, which merges synonyms."""
    names = dictionary_map(dictionary).withColumnRenamed("itemstring", label)
    return (
        lookup_join(events, names, label, "inner")
        .drop(label)
        .withColumnRenamed("altername", label)
        .select(*events.columns)
    )


def select_union(streams: list[DataFrame], dictionary: DataFrame, label: str) -> DataFrame:
    """Union of same-shape streams, then ``select_features``."""
    rows = streams[0]
    for other in streams[1:]:
        rows = rows.unionByName(other)
    return select_features(rows, dictionary, label)
