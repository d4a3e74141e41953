"""Benchmark passages in documents by greedy string tiling.

Windows of `seed` words are hashed. Documents that share a window with a test item are tiled
against it: the longest run of words that both hold and that no tile covers yet becomes a tile,
again and again, down to runs of `seed` words. The share of an item's words under tiles is its
coverage, whatever the order in which the document has them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import shields, stored
from .words import as_long, find_words, run_hash, slices, text_bytes

SEED_WORDS = 5
COVERAGE = 0.6
_BITS = 24


def seed_hashes(words: np.ndarray, size: int) -> np.ndarray:
    return run_hash(words, np.arange(max(0, len(words) - size + 1)), size)


def tiles(item: np.ndarray, document: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two sequences of word hashes: (place in item, place in document, words).

    Of runs that are equally long the first in the item goes first, then the first in the document.
    """
    mine, theirs = seed_hashes(item, size), seed_hashes(document, size)
    order = np.argsort(mine, kind="stable")
    low, high = np.searchsorted(mine[order], theirs, "left"), np.searchsorted(mine[order], theirs, "right")
    n = high - low
    j = np.repeat(np.arange(len(theirs)), n)
    i = order[np.repeat(low - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())]
    way = np.lexsort((i, j - i))  # by diagonal: seeds in a row make a longer match
    i, j = i[way], j[way]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j) != 1)])) if len(i) else np.zeros(0, np.int64)
    lengths = np.diff(np.concatenate([starts, [len(i)]])) + size - 1
    heap = [(-int(length), int(i[s]), int(j[s])) for s, length in zip(starts, lengths, strict=True)]
    heapq.heapify(heap)
    used_i, used_j, out = np.zeros(len(item), bool), np.zeros(len(document), bool), []
    while heap:
        length, a, b = heapq.heappop(heap)
        length = -length
        free = ~(used_i[a : a + length] | used_j[b : b + length])
        if free.all():
            used_i[a : a + length], used_j[b : b + length] = True, True
            out.append((a, b, length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if y - x >= size:
                heapq.heappush(heap, (x - y, a + x, b + x))
    return out


def _words_of(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(column)
    for i, j in slices(offsets):
        words = find_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        for k in range(j - i):
            yield words.hashes[words.offsets[k] : words.offsets[k + 1]]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    cut = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), as_long(np.concatenate(parts) if parts else np.zeros(0, np.uint64)))


def with_words(texts: DataFrame, size: int, shared=None) -> DataFrame:
    """key, words (hashes), seeds (different window hashes); of texts with a window, and if `shared` (a broadcast table of places) is given, one marked there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, words, seeds = [], [], []
            for k, w in enumerate(_words_of(batch.column(1))):
                s = np.unique(seed_hashes(w, size))
                if shared is not None:
                    s = s[shared.value[(s >> np.uint64(64 - _BITS)).astype(np.int64)]]
                if len(s):
                    rows.append(k)
                    words.append(w)
                    seeds.append(s)
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), _lists(words), _lists(seeds)], names=["key", "words", "seeds"])

    return texts.mapInArrow(work, "key long, words array<long>, seeds array<long>")


def tilings(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", seed: int = SEED_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """key, item, n_words (of the item), n_tiles, n_covered, coverage: pairs with so much coverage or more.

    Items with fewer than `seed` words can't be told from chance and match nothing. Neither do
    NULL or empty texts or rows with a NULL key. Rows with equal keys are tiled each, the best
    coverage counts. Empty tables give no rows.
    """
    spark = documents.sparkSession
    tests = stored(with_words(items.filter(F.col(item_key).isNotNull()).select(F.col(item_key).cast("long"), item_text), seed))
    seeds = tests.select(F.col("key").alias("item"), F.size("words").alias("m"), F.explode("seeds").alias("seed"))
    # a table of fixed size says which windows may be an item's; the join decides
    marked = np.zeros(1 << _BITS, bool)
    places = seeds.select(F.shiftrightunsigned("seed", 64 - _BITS).alias("p")).distinct().toArrow()["p"].to_numpy()
    marked[places] = True
    texts = documents.filter(F.col(key).isNotNull()).select(F.col(key).cast("long"), text)
    found = with_words(texts, seed, spark.sparkContext.broadcast(marked)).withColumn("row", F.monotonically_increasing_id())
    found = stored(found)
    hits = found.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    # tiles that cover so many words hold a fifth (1/seed) as many different windows at least, unless the item repeats itself
    distinct = tests.select(F.col("key").alias("item"), (F.size("seeds") >= F.size("words") - (seed - 1)).alias("plain"))
    enough = F.ceil(F.col("m") * coverage / seed)
    pairs = hits.groupBy("row", "item", "m").agg(F.count("*").alias("n")).join(distinct, "item").filter((F.col("n") >= enough) | ~F.col("plain")).select("row", "item")
    both = pairs.join(found.select("row", "key", F.col("words").alias("theirs")), "row").join(tests.select(F.col("key").alias("item"), F.col("words").alias("mine")), "item").select("key", "item", "mine", "theirs")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                mine, theirs = (batch.column(c)[k].values.to_numpy().view(np.uint64) for c in (2, 3))
                made = tiles(mine, theirs, seed)
                rows.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), len(mine), len(made), sum(x[2] for x in made)))
            names = ["key", "item", "n_words", "n_tiles", "n_covered"]
            yield pa.RecordBatch.from_pydict({name: pa.array([r[c] for r in rows], pa.int64()) for c, name in enumerate(names)})

    tiled = both.mapInArrow(work, "key long, item long, n_words long, n_tiles long, n_covered long").withColumn("coverage", F.col("n_covered") / F.col("n_words")).filter(F.col("coverage") >= coverage)
    return tiled.groupBy("key", "item").agg(F.max(F.struct("coverage", "n_words", "n_tiles", "n_covered")).alias("x")).select("key", "item", "x.n_words", "x.n_tiles", "x.n_covered", "x.coverage")


@shields("contaminated", "n_items", "item", "coverage")
def contamination(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of `documents` but the text, then contaminated, n_items, item (the best covered, of equals the smallest) and coverage; see tilings()."""
    plain = documents.drop(text)
    best = F.max(F.struct("coverage", F.negative("item").alias("i")))
    found = tilings(documents, items, key, text, **options).groupBy(F.col("key").alias("_k")).agg(F.count("*").alias("n_items"), best.alias("_b"))
    out = plain.join(found, F.col(key) == F.col("_k"), "left")
    return out.select(*plain.columns, F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.negative(F.col("_b.i")).alias("item"), F.coalesce("_b.coverage", F.lit(0.0)).alias("coverage"))
