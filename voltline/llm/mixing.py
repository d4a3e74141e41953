"""Mixing sources to target weights by blocks, with DataFrame operations only.

Each source's texts form one stream of words, in an order of their keys and texts, cut into blocks of `block_words`. A source's
quota of blocks is dealt to output shards by multinomial draws; the slots that a shard gets
run on from the last shard's and are mapped to blocks through a pseudorandom permutation
of the source's block numbers, a new one for each pass over the source; a join by block
number fetches the blocks. mixed_blocks() gives the blocks of every shard with their words,
mix_texts() where each text's pieces go, mix_sources() how many words of each text are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import shields, stored

BLOCK_WORDS = 64
SHARDS = 64
MOST_PASSES = 3
SEED = 20_240_601
#: Groups that a source's documents are dealt to, so that no task holds a whole source.
LANES = 1024
_DRAWS = 4096
_WORD = r"[^\x20\x09-\x0D]+"
_ROUNDS = 24


def n_words(text: str = "text") -> Column:
    """Runs of bytes other than space and \\x09-\\x0D; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str = "source", size: str = "size", most: int = MOST_PASSES) -> DataFrame:
    """source, source_size, target: one row for each source of `sizes`.

    Sources by code point, NULL last, weigh 1, 2, 3 and again. All words are shared by weight;
    a target stops at `most` times its source, and the excess is shared by weight among the
    rest until none is above: sources are taken by cap over weight, and the first that isn't
    above its share ends the list of capped ones. The windows see a row for each source.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    ranked = totals.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("_weight", (F.pmod(F.col("_rank") - 1, F.lit(3)) + 1).cast("long")).withColumn("_cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    heavy = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    shared = weighed.withColumn("_share", left / heavy)
    free = F.when(F.col("_share") * F.col("_weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), "_rank", "_share"))
    level = F.min(free).over(everything)["_share"]
    return shared.withColumn("_level", level).select("source", "source_size", F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level") * F.col("_weight")).otherwise(F.col("_cap").cast("double")).alias("target"))


def permuted(slot: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 for each key: swap-or-not shuffle, rounds of reflect and maybe swap."""

    def turn(x: Column, r: Column) -> Column:
        pivot = F.pmod(F.xxhash64(key, r), n)
        other = F.pmod(pivot - x + n, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, other)).bitwiseAND(1) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), slot.cast("long"), turn)


def pack(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """`documents` (without the text, if it isn't to be kept) with size and _row, and a table of _row, _source, size and _begin: the place of each text in its source's stream.

    Texts come in the order of a hash of key and text, so a table gives one stream however its
    files lie. A running sum over a whole source would be one task; rows are dealt to LANES
    groups of each source, groups get offsets from their sums, and sums run inside groups
    only. Neither texts nor other columns are moved.
    """
    sized = documents.withColumn("size", n_words(text)).withColumn("_row", F.monotonically_increasing_id()).withColumn("_order", F.xxhash64(key, text))
    kept = stored(sized if keep else sized.drop(text))
    dealt = kept.select("_row", F.col(source).alias("_source"), "size", F.col(key).alias("_key"), "_order", F.pmod("_order", F.lit(LANES)).alias("_lane"))
    lanes = dealt.groupBy("_source", "_lane").agg(F.sum("size").alias("_sum"))
    offsets = lanes.select(F.col("_source").alias("_s"), F.col("_lane").alias("_l"), (F.sum("_sum").over(Window.partitionBy("_source").orderBy("_lane")) - F.col("_sum")).alias("_offset"))
    # rows equal in key and text are exchangeable
    inside = dealt.withColumn("_before", F.sum("size").over(Window.partitionBy("_source", "_lane").orderBy("_order", "_key", "_row")) - F.col("size"))
    placed = inside.join(offsets, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_lane") == F.col("_l")))
    return kept.drop("_order"), stored(placed.select("_row", "_source", "size", (F.col("_before") + F.col("_offset")).alias("_begin")))


def draw_slots(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """shard, source, slot, block: which block of its source each output slot takes.

    Each slot of a quota draws its shard uniformly, so a shard's counts are multinomial, given
    that quotas are met. Slots over a source's blocks begin another pass, `most` at the most.
    """
    sized = targets.withColumn("_blocks", F.ceil(F.col("source_size") / block_words).cast("long")).filter("_blocks > 0")
    # a last block that isn't full makes the mean block shorter
    quota = F.least(F.round(F.col("target") * F.col("_blocks") / F.col("source_size")).cast("long"), F.col("_blocks") * most)
    quotas = sized.withColumn("_quota", quota).filter("_quota > 0")
    # few rows that become many: a stated number of partitions, as small ones would be put into one task
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = quotas.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_quota") - 1) / _DRAWS)))).repartition(tasks, F.col("source"), F.col("_run"))
    draws = runs.select("source", "_blocks", F.explode(F.sequence(F.col("_run") * _DRAWS, F.least((F.col("_run") + 1) * _DRAWS, F.col("_quota")) - 1)).alias("_draw"))
    counts = draws.groupBy("source", "_blocks", F.pmod(F.xxhash64(F.lit(seed), "source", "_draw"), F.lit(shards)).alias("shard")).agg(F.count("*").alias("_count"))
    placed = counts.withColumn("_first", F.sum("_count").over(Window.partitionBy("source").orderBy("shard")) - F.col("_count"))
    parts = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_count") - 1) / _DRAWS)))).repartition(tasks, F.col("source"), F.col("shard"), F.col("_run"))
    slots = parts.select("shard", "source", "_blocks", F.explode(F.sequence(F.col("_first") + F.col("_run") * _DRAWS, F.col("_first") + F.least((F.col("_run") + 1) * _DRAWS, F.col("_count")) - 1)).alias("slot"))
    turn = F.floor(F.col("slot") / F.col("_blocks"))
    return slots.select("shard", "source", "slot", permuted(F.pmod("slot", "_blocks"), F.col("_blocks"), F.xxhash64(F.lit(seed), "source", turn)).alias("block"))


def cut_blocks(packed: DataFrame, block_words: int) -> DataFrame:
    """_row, _s, _b, _at (place in the stream), _first (place in the text), _n: the pieces of each text by blocks of its source."""
    last = F.col("_begin") + F.col("size")
    blocks = F.sequence(F.floor(F.col("_begin") / block_words), F.floor((last - 1) / block_words))
    parts = packed.filter("size > 0").select("_row", F.col("_source").alias("_s"), "_begin", last.alias("_last"), F.explode(blocks).alias("_b"))
    at = F.greatest(F.col("_begin"), F.col("_b") * block_words)
    return parts.select("_row", "_s", "_b", at.alias("_at"), (at - F.col("_begin")).alias("_first"), (F.least("_last", (F.col("_b") + 1) * block_words) - at).alias("_n"))


def _slots(packed: DataFrame, block_words: int, shards: int, most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    targets = source_targets(packed.select(F.col("_source").alias("source"), "size"), most=most)
    return targets, draw_slots(targets, block_words, shards, most, seed)


def mixed_blocks(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", block_words: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """shard, source, slot, block, text: the mix itself, a row for each slot with the words of its block.

    Words are joined by single spaces; further columns are not read. A shard's rows by source and
    slot are its part of the corpus. An empty table gives no rows.
    """
    kept, packed = pack(documents.select(F.col(text).alias("text"), F.col(source).alias("source"), F.col(key).alias("key")), key="key", keep=True)
    _, slots = _slots(packed, block_words, shards, most, seed)
    words = kept.select("_row", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)).alias("_words"))
    pieces = cut_blocks(packed, block_words).join(words, "_row").select("_s", "_b", F.struct("_at", F.array_join(F.slice("_words", (F.col("_first") + 1).cast("int"), F.col("_n").cast("int")), " ").alias("p")).alias("x"))
    blocks = pieces.groupBy("_s", "_b").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["p"]), " ").alias("text"))
    joined = slots.join(blocks.hint("merge"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    return joined.select("shard", "source", "slot", "block", "text")


def _mixed(documents: DataFrame, text: str, source: str, key: str, block_words: int, shards: int, most: int, seed: int, whole: bool) -> DataFrame:
    kept, packed = pack(documents, text, source, key, keep=whole)
    targets, slots = _slots(packed, block_words, shards, most, seed)
    parts = cut_blocks(packed, block_words)
    # planned by the size of the few rows of targets that slots come from, the slots would be broadcast
    pieces = parts.join(slots.select("shard", F.col("source").alias("_p"), "slot", "block").hint("merge"), F.col("_s").eqNullSafe(F.col("_p")) & (F.col("_b") == F.col("block")))
    totals = [F.sum("_n").alias("taken")]
    if whole:
        totals.append(F.array_sort(F.collect_list(F.struct("shard", "slot", F.col("_first").alias("first"), F.col("_n").alias("n_words")))).alias("pieces"))
    # texts meet the mix in one join, at the end
    out = kept.join(pieces.groupBy(F.col("_row").alias("_r")).agg(*totals), F.col("_row") == F.col("_r"), "left")
    goal = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = out.join(goal, F.col(source).eqNullSafe(F.col("_s")), "left")
    more = [F.coalesce("pieces", F.array().cast("array<struct<shard:bigint,slot:bigint,first:bigint,n_words:bigint>>")).alias("pieces")] if whole else []
    return out.select(*[c for c in documents.columns if whole or c != text], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *more)


@shields("size", "source_size", "target", "taken")
def mix_sources(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", block_words: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """All columns of `documents` but the text, then size, source_size, target, taken.

    size: words of the text (NULL: 0). taken: words of it in the shards, repeats counted; at most
    `most` times its size, as no block is taken more often. Empty texts are kept with 0. A NULL
    source is a source. Repeated rows are texts of their own. An empty table gives no rows.
    Columns that have the names of added ones are replaced. The same table gives the same
    mix, however its rows are partitioned: texts are ordered by key and text. A NULL key is a key.
    """
    return _mixed(documents, text, source, key, block_words, shards, most, seed, False)


@shields("size", "source_size", "target", "taken", "pieces")
def mix_texts(documents: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", block_words: int = BLOCK_WORDS, shards: int = SHARDS, most: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """As mix_sources(), but with the text and, last, pieces: shard, slot, first and n_words of each piece of the text that a shard holds."""
    return _mixed(documents, text, source, key, block_words, shards, most, seed, True)
