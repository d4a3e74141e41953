"""The queries of the operators over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chain_dedup, ctw, decontaminate, language_id, line_dedup, line_quality, mixing, ngram_join, periodic_runs, suffix_dedup, token_alignment, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WORD = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query()
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents joined by Jaccard similarity of three-word shingles, 0.9 or more."""
    return ngram_join.join_by_shingles(documents(spark, folder))


@query()
def op2_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Context-tree-weighting scores of all texts, learned from six of seven folds."""
    training = language_id.learns(F.col("doc_id"), 7, 2)
    out = ctw.score_texts(documents(spark, folder).select("doc_id", "text"), training)
    return out.select("doc_id", (~training).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_symbols")


@query()
def op3_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark passages, in whatever order, by greedy string tiling."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, folder).select("doc_id", "text"), items)


LINE_QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
v AS (SELECT doc_id, i, a, lead(a) OVER x AS b, lead(a, 2) OVER x AS c FROM p WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM v WHERE c IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
raw AS (SELECT doc_id, source, body, unnest(string_split(body, chr(10))) AS l FROM d),
li AS (SELECT doc_id, source, body, l, regexp_extract_all(l, '{WORD}') AS w FROM raw WHERE regexp_matches(l, '{WORD}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM li GROUP BY doc_id),
n AS (SELECT doc_id, source, body, regexp_replace(lower(array_to_string(w, ' ')), '[0-9]', '0', 'g') AS l, len(w) AS n FROM li),
c AS (SELECT source, l, min(doc_id) AS first FROM n GROUP BY source, l HAVING count(DISTINCT body) > {line_quality.MOST_DOCUMENTS}),
rem AS (SELECT n.doc_id, sum(n.n) AS n FROM n JOIN c ON n.source IS NOT DISTINCT FROM c.source AND n.l = c.l WHERE n.doc_id <> c.first GROUP BY n.doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(rem.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rem USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {line_quality.LEAST_SHARE} * n_words AS kept FROM f
"""


@query(LINE_QUALITY_SQL)
def op4_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules with cross-document line frequency per host."""
    out = line_quality.line_quality(documents(spark, folder))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


LINE_DEDUP_SQL = rf"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
li AS (SELECT doc_id, unnest(a) AS l, generate_subscripts(a, 1) AS pos FROM raw),
n AS (SELECT doc_id, l, pos, array_to_string(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), ' ') AS t FROM li),
s AS (SELECT doc_id, pos, t, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM n WHERE t <> ''),
v AS (SELECT doc_id, i, t AS a, lead(t) OVER x AS b, lead(t, 2) OVER x AS c FROM s WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
runs AS (
  SELECT doc_id, i, 2 AS more, a, b, c FROM v WHERE c IS NOT NULL
  UNION ALL SELECT doc_id, i, 1, a, b, NULL FROM v WHERE b IS NOT NULL AND len(string_split(a, ' ')) + len(string_split(b, ' ')) >= {line_dedup.PASSAGE_WORDS}
  UNION ALL SELECT doc_id, i, 0, a, NULL, NULL FROM v WHERE len(string_split(a, ' ')) >= {line_dedup.PASSAGE_WORDS}),
r AS (SELECT doc_id, i, more, row_number() OVER (PARTITION BY more, a, b, c ORDER BY doc_id, i) AS k FROM runs),
gone AS (SELECT DISTINCT s.doc_id, s.pos FROM r JOIN s ON r.doc_id = s.doc_id AND s.i BETWEEN r.i AND r.i + r.more WHERE r.k > 1)
SELECT n.doc_id, CAST(count(*) FILTER (t <> '') AS BIGINT) AS n_lines, CAST(count(gone.pos) AS BIGINT) AS n_removed_lines,
  md5(coalesce(string_agg(l, chr(10) ORDER BY n.pos) FILTER (gone.pos IS NULL), '')) AS kept_md5
FROM n LEFT JOIN gone ON n.doc_id = gone.doc_id AND n.pos = gone.pos GROUP BY n.doc_id
"""


@query(LINE_DEDUP_SQL)
def op5_line_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Later repeats of runs of three lines or fifty words removed."""
    out = line_dedup.dedup_lines(documents(spark, folder).select("doc_id", "text"), least_words=line_dedup.PASSAGE_WORDS)
    return out.select("doc_id", "n_lines", "n_removed_lines", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


@query()
def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes under 50-byte strings that start in an earlier document too, removed."""
    out = suffix_dedup.dedup_substrings(documents(spark, folder).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_chained_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Fuzzy passages that documents share with earlier ones, by chained seeds, and the classes of documents that they link."""
    return chain_dedup.passage_classes(documents(spark, folder).select("doc_id", "text"))


@query()
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Exact token counts of whole texts by overlapping chunks."""
    out = token_counts.count_tokens(documents(spark, folder).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query()
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Sources mixed to target weights by permuted blocks."""
    out = mixing.mix_sources(documents(spark, folder).select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


@query()
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every text by segmentation-marginalised pieces, learned from two of three folds."""
    vocabulary, training = public_tokenizers.path("piece_bpe_32k.model"), language_id.learns(F.col("doc_id"), 3, 1)
    docs = documents(spark, folder)
    model = language_id.fit(docs.filter(training), vocabulary)
    out = language_id.identify(docs.select("doc_id", "text"), model, vocabulary)
    return out.select("doc_id", (~training).alias("held_out"), "lang_pred", "score")


@query()
def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as ids of a byte-level vocabulary, and those ids as bytes again."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encode(documents(spark, folder).select("doc_id", "text"), ranks)
    counted = tokens.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), byte_bpe.digest(F.col("ids")).alias("ids_sha256"))
    return byte_bpe.decode(counted, ranks).select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten the words from a place on repeat some words of that place, by its key."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w"))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    placed = split.withColumn("a", F.when(n > 0, (g % n).cast("int"))).withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    repeated = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every text, and what is left where each run keeps its first period."""
    out = periodic_runs.find_runs(planted_runs(documents(spark, folder)))
    longest = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best),
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = out.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query()
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two public vocabularies aligned in every text, with how often the corpus links each pair."""
    out = token_alignment.align_tokenizers(documents(spark, folder).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return out.withColumn("groups_sha256", digest).drop("groups")
