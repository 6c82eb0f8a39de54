"""One query per operator over the test tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    counts,
    licenses,
    mixing,
    near_duplicates,
    neighbours,
    packing,
    personal,
    quality,
    repeats,
    search,
    secrets,
    urls,
)

# Fixed value: hosts whose name holds one of these words are on the list.
LISTED_WORDS = ("spam", "casino", "malware")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_definition(name: str = "byte_bpe_50k.json") -> str:
    with open(tokenizer_file(name), encoding="utf-8") as f:
        return f.read()


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_definition())


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.scan_licenses(read(spark, sf_dir, "documents")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).distinct()
    listed = hosts.where(F.col("host").rlike("|".join(LISTED_WORDS)))
    return urls.judge_urls(pages, listed)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents")).select(
        "doc_id", *quality.FIGURES, "base_failed", "kept", "log2_perplexity", "low", "high"
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), length=200).drop("kept")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = counts.model_pieces(tokenizer_file("piece_bpe_32k.model"))
    return counts.token_counts(read(spark, sf_dir, "documents"), pieces)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=50)


def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_digest(personal.find_personal(read(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        pieces = f.read()
    return alignment.alignment_figures(read(spark, sf_dir, "documents"), tokenizer_definition(), pieces)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_licenses,
        op3_near_duplicates,
        op4_urls,
        op5_mixing,
        op6_quality,
        op7_neighbours,
        op8_repeats,
        op9_secrets,
        op10_token_counts,
        op11_search,
        op12_personal,
        op13_alignment,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def urls_sql() -> str:
    host = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    longest = sorted(urls.RULES, key=lambda r: (-len(r[0]), -len(r[1])))

    def chosen(what: int) -> str:
        cases = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, says)[what]}'"
            for h, p, says in longest
        )
        return f"CASE {cases} END"

    return f"""WITH parts AS (SELECT page_id, {host} AS host, {path} AS path FROM pages)
SELECT page_id, host, path, {chosen(0)} AS rule,
  coalesce({chosen(1)}, CASE WHEN regexp_matches(host, '{"|".join(LISTED_WORDS)}') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts"""


def licenses_sql(least_cover: float = 0.8) -> str:
    found = licenses.templates()
    postings = ", ".join(f"({i}, {at}, '{w}')" for i, t in enumerate(found) for at, w in enumerate(t.words))
    kinds = ", ".join(f"({i}, '{t.label}', {t.base}, {len(t.words)})" for i, t in enumerate(found))
    phrases = ", ".join(f"({i}, {at}, {size})" for i, t in enumerate(found) for at, size in t.phrases)
    return f"""WITH postings(template, pos, word) AS (VALUES {postings}),
kinds(template, label, base, size) AS (VALUES {kinds}),
phrases(template, begin_at, size) AS (VALUES {phrases}),
texts AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{licenses.WORD}') AS w FROM documents),
hits AS (SELECT * FROM (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM texts)
  WHERE word IN (SELECT word FROM postings)),
seen AS (SELECT word, count(DISTINCT rid) AS n FROM hits GROUP BY word),
keys AS (SELECT template, pos, word FROM (SELECT p.*, row_number() OVER (PARTITION BY template
  ORDER BY coalesce(n, 0), p.word, p.pos) AS nth FROM postings p LEFT JOIN seen s ON s.word = p.word) WHERE nth = 1),
shifts AS (SELECT rid, template, h.pos - k.pos AS start_pos FROM hits h JOIN keys k ON k.word = h.word),
stand AS (SELECT s.rid, s.template, s.start_pos, p.pos FROM shifts s JOIN postings p ON p.template = s.template
  JOIN hits h ON h.rid = s.rid AND h.word = p.word AND h.pos = s.start_pos + p.pos),
covers AS (SELECT rid, template, start_pos, count(*) AS n FROM stand GROUP BY rid, template, start_pos),
whole AS (SELECT DISTINCT rid, template, start_pos FROM (SELECT s.rid, s.template, s.start_pos, f.begin_at, f.size, count(*) AS n
  FROM stand s JOIN phrases f ON f.template = s.template AND s.pos >= f.begin_at AND s.pos < f.begin_at + f.size
  GROUP BY ALL) WHERE n = size),
matches AS (SELECT c.rid, c.start_pos, k.label, k.base, CAST(c.n AS DOUBLE) / k.size AS cover FROM covers c
  JOIN kinds k ON k.template = c.template LEFT JOIN whole w ON w.rid = c.rid AND w.template = c.template AND w.start_pos = c.start_pos
  WHERE CASE WHEN k.base THEN c.n = k.size ELSE w.rid IS NOT NULL AND CAST(c.n AS DOUBLE) / k.size >= {least_cover} END)
SELECT doc_id, CAST(len(any_value(w)) AS BIGINT) AS n_words, count(label) FILTER (base) AS n_base,
  min(start_pos) FILTER (base) AS first_word, max(start_pos) FILTER (base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0) AS score
FROM texts t LEFT JOIN matches m ON m.rid = t.rid GROUP BY t.rid, doc_id"""


def search_sql(k: int = 50) -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{search.TERM}')"
    return f"""WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
wanted AS (SELECT row_number() OVER () AS iid, item_id, list_distinct({words}) AS w FROM benchmark),
asked AS (SELECT iid, item_id, unnest(w) AS term FROM wanted),
totals AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM texts),
held AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY rid, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM held, totals GROUP BY term),
sizes AS (SELECT rid, doc_id, CAST(50 + (50 * CAST(len(w) AS BIGINT) * nn) // ll AS BIGINT) AS m FROM texts, totals),
scores AS (SELECT a.iid, a.item_id, h.rid, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked a JOIN held h ON h.term = a.term JOIN weights x ON x.term = a.term JOIN sizes s ON s.rid = h.rid GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT c.*, s.doc_id,
  row_number() OVER (PARTITION BY iid ORDER BY score DESC, s.doc_id NULLS LAST) AS rank
  FROM scores c JOIN sizes s ON s.rid = c.rid WHERE score > 0) WHERE rank <= {k}"""


ORACLE: dict[str, str] = {"op2_licenses": licenses_sql(), "op4_urls": urls_sql(), "op11_search": search_sql()}
