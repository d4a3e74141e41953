"""Quality rules on text and on how often its lines occur across documents, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import shields

#: Documents of one host that may share a line; texts that are equal as a whole count once.
MOST_DOCUMENTS = 20
#: A document of which less than this share of words is left is depleted.
LEAST_SHARE = 0.3
LEAST_WORDS = 50
REPEAT_PERCENT = 50
_SPACES = "\t\n\x0b\f\r "


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _SPACES, " " * len(_SPACES)), " "), "")


def measures(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` without the text, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    plain = documents.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    split = plain.withColumn("_body", F.coalesce(F.col(text), F.lit(""))).withColumn("_h", F.transform(word_array(F.col("_body")), lambda x: F.xxhash64(x)))
    lines = F.filter(F.split("_body", "\n"), lambda x: F.translate(x, _SPACES, "") != "")
    counted = split.withColumn("n_words", F.size("_h").cast("long")).withColumn("_lines", lines)
    # three-word windows as (hash, place), sorted: equal ones stand side by side
    windows = F.transform(F.sequence(F.lit(0), F.size("_h") - 3), lambda i: F.struct(F.xxhash64(F.get("_h", i), F.get("_h", i + 1), F.get("_h", i + 2)).alias("h"), i.alias("i")))
    counted = counted.withColumn("_s", F.when(F.size("_h") > 3, F.sort_array(windows)))
    same = F.filter("_s", lambda x, k: (x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"]))
    places = F.sort_array(F.transform(same, lambda x: x["i"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])
    return counted.select(
        *[c for c in plain.columns if c != text], "n_words",
        F.char_length(F.translate("_body", _SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length("_body") - F.char_length(F.translate("_body", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def normal_line(line: Column) -> Column:
    """Lower case, white space squeezed, digits alike."""
    return F.regexp_replace(F.array_join(word_array(F.lower(line)), " "), "[0-9]", "0")


def line_rows(documents: DataFrame, key: str, text: str = "text", host: str = "source") -> DataFrame:
    """key, _host, _text (hash), _line (hash), _n (words of all such lines): a row for each different line of a document that has a word."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.translate(x, _SPACES, "") != "")
    pieces = documents.select(key, F.col(host).alias("_host"), F.xxhash64(F.col(text)).alias("_text"), F.explode(lines).alias("_l"))
    hashed = pieces.select(key, "_host", "_text", F.xxhash64(normal_line(F.col("_l"))).alias("_line"), F.size(word_array(F.col("_l"))).alias("_n"))
    return hashed.groupBy(key, "_host", "_text", "_line").agg(F.sum("_n").alias("_n"))


def common_lines(rows: DataFrame, key: str, most: int = MOST_DOCUMENTS) -> DataFrame:
    """_host, _line, n_documents, _first (smallest key): lines above the limit."""
    texts = rows.groupBy("_host", "_line", "_text").agg(F.min(key).alias("_first"))
    return texts.groupBy("_host", "_line").agg(F.count("*").alias("n_documents"), F.min("_first").alias("_first")).filter(F.col("n_documents") > most)


def _judged(documents: DataFrame, key: str, text: str, host: str, most_documents: int, least_share: float) -> DataFrame:
    """`documents` with the text as _text, the measures, n_removed_words, _gone (hashes of the lines to remove), base_failed and kept."""
    rows = line_rows(documents, key, text, host)
    common = common_lines(rows, key, most_documents).select(F.col("_host").alias("_h"), F.col("_line").alias("_l"), "_first")
    hit = rows.join(common, rows["_host"].eqNullSafe(common["_h"]) & (rows["_line"] == common["_l"])).filter(F.col(key) != F.col("_first"))
    removed = hit.groupBy(F.col(key).alias("_key")).agg(F.sum("_n").alias("n_removed_words"), F.collect_set("_line").alias("_gone"))
    out = measures(documents.withColumn("_text", F.col(text)), text).join(removed, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    # one comparison over both sides of the join: a filter on it can't be pushed below, where the measures would be worked out again inside of it
    floor = F.when(failed, F.col("n_words") + 1).otherwise(least_share * F.col("n_words"))
    kept = F.col("n_words") - F.least("n_removed_words", "n_words") >= floor
    return out.withColumn("base_failed", failed).withColumn("kept", kept)


@shields("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")
def line_quality(documents: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", most_documents: int = MOST_DOCUMENTS, least_share: float = LEAST_SHARE) -> DataFrame:
    """All columns of `documents` but the text, then n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_removed_words, base_failed, kept.

    Normalised lines that more than `most_documents` different texts of a host share are removed
    from all documents but the first that has them, so that one copy of everything stays. A
    document fails the base rule under 50 words or if over half of its words are in three-word
    windows that it holds twice; it is depleted if less than `least_share` of its words are left.
    kept: neither. NULL and empty texts have no words and fail; a NULL host is a host; rows with
    equal keys are one document to the line count; lines of a NULL key are never removed; an
    empty table gives no rows; columns with the names of added ones are replaced.
    """
    return _judged(documents, key, text, host, most_documents, least_share).drop("_text", "_gone")


@shields()
def apply_rules(documents: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", most_documents: int = MOST_DOCUMENTS, least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows of `documents` that line_quality() keeps, their texts without the lines that it removes."""
    judged = _judged(documents, key, text, host, most_documents, least_share).filter("kept")
    stays = F.filter(F.split("_text", "\n"), lambda x: (F.translate(x, _SPACES, "") == "") | ~F.array_contains("_gone", F.xxhash64(normal_line(x))))
    cleaned = judged.withColumn(text, F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(stays, "\n")))
    return cleaned.select(*documents.columns)
