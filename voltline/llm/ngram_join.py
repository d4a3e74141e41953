"""Join of documents whose sets of word shingles have a Jaccard similarity of `percent` or more.

Candidates come from token-combination prefixes. Shingles are ordered by how many sets hold
them, rarest first. A set that may lack t of its shingles in a partner takes the shortest prefix
in which t losses always leave a signature: a rare shingle is one by itself; of shingles of a
frequent class, k together are one, so only those beyond the first k-1 of their subclass count
and the prefix is extended. Two linked sets then share a signature within their prefixes.

Frequencies are counted over the whole corpus in a table by hash that grows with it up to MOST_BITS;
whatever it says, the order is one order for all sets, so links are never lost, and rare shingles
in crowded places only make longer lists.

A signature's documents are first compared with its smallest one only. What those links have
joined needs no more comparing. Of the rest, short lists compare documents of different
components; long lists are compared in blocks, unlinked documents against all others. No pairs
of a large group are ever written out. Sizes tell most pairs that can't link before they are
written; sets are compared in turns of a share of the corpus, and what a step leaves goes with it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .store import key_marks, key_place, noting, removed, stored, tidied
from .suffix_dedup import packed, unpacked
from .words import as_long, find_words, mix, shingles, slices, text_bytes

SHINGLE_WORDS = 3
PERCENT = 90
#: Places of the table of frequencies, the fewest and the most, and how many shingles one has to hold on average before there are more.
SKETCH_BITS, MOST_BITS = 21, 26
LOAD = 32
#: A shingle is of class k = 1, 2, 3 by how far its place is above the table's mean load.
CLASSES = (32, 1024)
#: Lists up to this long compare pairs of documents, longer ones go to blocks.
SHORT = 32
_BLOCK, _MEMBERS = 256, 2048
_SLICES = 256
#: Places counted together, and different sets that a task knows again.
_COUNTED, _KNOWN = 1 << 22, 1 << 17
_PARITY = 1024
#: Pairs whose sets have up to one in so many of the corpus' shingles are compared at once.
TURN = 4


def sets_of(batch: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number and sorted shingle hashes of each text."""
    data, offsets = text_bytes(batch)
    for i, j in slices(offsets):
        hashes, owner = shingles(find_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), size)
        order = np.argsort(owner, kind="stable")
        hashes, cut = hashes[order], np.searchsorted(owner[order], np.arange(j - i + 1))
        for k in range(j - i):
            yield i + k, np.unique(hashes[cut[k] : cut[k + 1]])


def fingerprints(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, n_shingles, f1, f2 (equal for equal sets), bits: for each of 1,024 places the parity of the shingles there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2 = (np.zeros(batch.num_rows, np.uint64) for _ in range(3))
            bits = np.zeros((batch.num_rows, _PARITY), np.uint8)
            for k, tokens in sets_of(batch.column(1), size):
                n[k], f1[k], f2[k] = len(tokens), mix(tokens).sum(), mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()
                bits[k] = np.bincount((tokens % np.uint64(_PARITY)).astype(np.int64), minlength=_PARITY) & 1
            packed = np.packbits(bits, axis=1).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * packed.shape[1]), pa.array(packed.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), as_long(n), as_long(f1), as_long(f2), lists], names=["key", "n_shingles", "f1", "f2", "bits"])

    return documents.select(F.col(key).cast("long"), text).mapInArrow(work, "key long, n_shingles long, f1 long, f2 long, bits array<long>")


def table_bits(n_shingles: int) -> int:
    """Places, as a power of two, of the table of frequencies of so many shingles."""
    return min(MOST_BITS, max(SKETCH_BITS, math.ceil(math.log2(max(1, n_shingles) / LOAD))))


def level(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte, in their order: up to 128 as they are, beyond that eight steps to each doubling."""
    return np.minimum(np.where(counts < 128, counts, 128 + 8 * np.log2(np.maximum(counts, 128) / 128)), 255).astype(np.uint8)


def frequencies(texts: DataFrame, size: int, bits: int) -> np.ndarray:
    """The level() of how many sets hold a shingle of each place of the table; texts: one column.

    Places go along in order, as the distances between them, so that a task sends what it has read and no tables.
    """
    width = (1 << bits) // _SLICES

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        places = np.sort(np.concatenate(held))
        cuts = np.searchsorted(places, np.arange(_SLICES + 1) * width)
        parts = [packed((places[i:j] % width).astype(np.int32)) for i, j in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_pydict({"slice": np.arange(_SLICES, dtype=np.int32), "part": parts})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, tokens in sets_of(batch.column(0), size):
                held.append((tokens >> np.uint64(64 - bits)).astype(np.int64))
                n += len(tokens)
                if n >= _COUNTED:
                    yield rows(held)
                    held, n = [], 0
        if held:
            yield rows(held)

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(width, np.int64), 0
        for p in parts:
            number = p.column(0)[0].as_py()
            for part in p.column(1):
                np.add.at(total, unpacked(part.as_py(), np.int32), 1)
        yield pa.RecordBatch.from_pydict({"slice": np.array([number], np.int32), "part": [level(total).tobytes()]})

    table = np.zeros(1 << bits, np.uint8)
    with tidied(texts.sparkSession):
        for r in texts.mapInArrow(count, "slice int, part binary").groupBy("slice").applyInArrow(add, "slice int, part binary").collect():
            table[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["part"], np.uint8)
    return table


def losses(n: int, percent: int) -> int:
    """How many of n shingles a linked set may lack."""
    return n - (percent * n + 99) // 100


def signatures(tokens: np.ndarray, counts: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of one set (sorted hashes); counts and classes: of its tokens."""
    n = len(tokens)
    need = losses(n, percent) + 1
    order = np.lexsort((tokens, counts))
    tokens, classes = tokens[order], classes[order]
    if (classes[:need] == 1).all():
        return tokens[:need]
    out: set[int] = set()
    # subclasses keep lists of combinations short; their number must be the same for partners, so it follows the power of two of the larger one
    for octave in {n.bit_length(), (100 * n // percent).bit_length()}:
        parts, left = max(1, (1 << octave) >> 5), need
        held: dict[tuple[int, int], list[int]] = {}
        for token, k in zip(tokens.tolist(), classes.tolist() if octave > 5 else [1] * n, strict=True):  # in small sets k-1 tokens short would be too many
            group = held.setdefault((k, token % parts if k > 1 else token), [])
            group.append(token)
            left -= len(group) >= k
            if not left:
                break
        for (k, _), group in held.items():
            for some in combinations(group, k):
                h = some[0]
                for x in some[1:]:
                    h = (h * 0x9E3779B97F4A7C15 + x ^ (h >> 29)) & 0xFFFFFFFFFFFFFFFF
                out.add(h)
    return np.fromiter(out, np.uint64, len(out))


def postings(texts: DataFrame, table: np.ndarray, load: float, size: int, percent: int, classes: tuple[int, ...] = CLASSES) -> DataFrame:
    """sig, set, key, n for every signature of every different set, n being its size; texts: key, text. Of equal sets the smallest key stands."""
    bits = int(len(table)).bit_length() - 1
    limits = level(np.array([load + c for c in classes]))
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = shared.value, {}
        for batch in batches:
            keys = batch.column(0).to_numpy()
            found, owner, sets, sizes = [], [], [], []
            for k, tokens in sets_of(batch.column(1), size):
                if len(tokens):
                    whole = int(mix(tokens).sum() + np.uint64(len(tokens)))
                    if whole in known and known[whole] <= keys[k]:  # else copies in one task would meet again at each signature
                        continue
                    if len(known) == _KNOWN:
                        known.clear()
                    known[whole] = keys[k]
                    c = counts[(tokens >> np.uint64(64 - bits)).astype(np.int64)]
                    s = signatures(tokens, c, np.searchsorted(limits, c, "left") + 1, percent)
                    found.append(s)
                    owner.append(np.full(len(s), keys[k]))
                    sets.append(np.full(len(s), whole, np.uint64))
                    sizes.append(np.full(len(s), len(tokens), np.int32))
            if found:
                yield pa.RecordBatch.from_arrays([as_long(np.concatenate(found)), as_long(np.concatenate(sets)), pa.array(np.concatenate(owner)), pa.array(np.concatenate(sizes))], names=["sig", "set", "key", "n"])

    # dealt by signature, so that sets and then lists are found where they are
    rows = texts.mapInArrow(work, "sig long, set long, key long, n int").repartition("sig")
    return rows.groupBy("sig", "set", "n").agg(F.min("key").alias("key"))


def lists_of(posted: DataFrame) -> DataFrame:
    """sig, key, n, c, lead, low, high: of signatures that several sets have, with their number, their smallest key and the sizes of its sets."""
    each = Window.partitionBy("sig")
    first, last = F.min(F.struct("key", "n")).over(each), F.min(F.struct("key", F.negative("n").alias("n"))).over(each)
    listed = posted.select("sig", "key", "n", F.count("*").over(each).alias("c"), first.alias("first"), last.alias("last")).filter("c > 1")
    return listed.select("sig", "key", "n", "c", F.col("first.key").alias("lead"), F.col("first.n").alias("low"), F.negative("last.n").alias("high"))


def sized(a: str, b: str, percent: int) -> Column:
    """If sets of these sizes can link."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def token_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """key, tokens of the texts whose keys are in `wanted` (key).

    A table of fixed size says which keys may be wanted, so that other texts are neither hashed nor shuffled.
    """
    shared = texts.sparkSession.sparkContext.broadcast(key_marks(wanted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(shared.value[batch.column(2).to_numpy()]))
            found = [tokens for _, tokens in sets_of(batch.column(1), size)]
            cut = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = as_long(np.concatenate(found) if found else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(cut), flat)], names=["key", "tokens"])

    sets = texts.select("key", "text", key_place()).mapInArrow(work, "key long, tokens array<long>")
    return sets.join(wanted.select("key").distinct(), "key", "left_semi")


def possible(pairs: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), with their sizes na and nb, that sizes and parities allow to link: sets can't differ in fewer shingles than in parities."""
    side = lambda k: prints.select(F.col("key").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("bits").alias(f"bits_{k}"))
    both = pairs.join(side("a"), "a").filter("na > 0").join(side("b"), "b")
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return both.filter(sized("na", "nb", percent) & (differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))).select("a", "b", "na", "nb").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int, n_shingles: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link; n_shingles: of the whole corpus."""
    spark = texts.sparkSession
    held: list[str] = []
    with noting(held):
        pairs = stored(pairs, tidy=True)
    turns = max(1, math.ceil(TURN * (pairs.agg(F.sum(F.col("na") + F.col("nb"))).first()[0] or 0) / max(1, n_shingles)))
    out = [_compared(pairs.filter(F.pmod(F.xxhash64("b", "a"), F.lit(turns)) == turn).select("a", "b").distinct(), texts, size, percent) for turn in range(turns)]
    linked = functools.reduce(DataFrame.union, out)
    removed(spark, held, linked)
    return linked


def _compared(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    held: list[str] = []
    with noting(held):
        pairs = stored(pairs, tidy=True)
        sets = stored(token_sets(texts, pairs.select(F.col("a").alias("key")).union(pairs.select("b")), size), tidy=True)
        right = pairs.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb")), "b")
        both = right.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta")), "a")
        common = F.size(F.array_intersect("ta", "tb"))
        counted = both.select("a", "b", common.alias("i"), (F.size("ta") + F.size("tb")).alias("s"))
        linked = stored(counted.filter(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b"), tidy=True)
    removed(texts.sparkSession, held, linked)
    return linked


def _blocks(entries: DataFrame, groups: DataFrame, labels: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between documents of long lists that aren't of one component yet; entries: key; groups: node, component of the joined lists."""
    keys = entries.select("key").distinct()
    g = keys.join(groups.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("component", "key").alias("g"))
    named = g.join(labels.withColumnRenamed("node", "key"), "key", "left").select("key", "g", F.coalesce("component", "key").alias("c"))
    sized = named.groupBy("g", "c").agg(F.count("*").alias("m"))
    largest = sized.groupBy("g").agg(F.max(F.struct("m", F.negative("c").alias("c"))).alias("x"), F.sum("m").alias("total")).select("g", F.negative(F.col("x.c")).alias("main"), "total", (F.col("total") - F.col("x.m")).alias("rest")).filter("rest > 0")
    chosen = stored(named.join(largest, "g"), tidy=True)
    placed = chosen.join(token_sets(texts, chosen, size), "key")
    h = F.abs(F.xxhash64("key") % (1 << 40))
    n_rest, n_all = F.ceil(F.col("rest") / _BLOCK).cast("long"), F.ceil(F.col("total") / _MEMBERS).cast("int")
    queries = placed.filter(F.col("c") != F.col("main")).select("g", (h % n_rest).alias("q"), F.explode(F.sequence(F.lit(0), n_all - 1)).alias("p"), "key", "c", "tokens")
    members = placed.select("g", F.explode(F.sequence(F.lit(0).cast("long"), n_rest - 1)).alias("q"), (h % n_all).cast("int").alias("p"), "key", "c", "tokens")

    queries, members = (x.toDF("g", "q", "p", "key", "c", "tokens") for x in (queries, members))

    def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(mine) and len(theirs):
            sizes = np.array([len(x) for x in mine["tokens"]])
            flat, owner = np.concatenate(list(mine["tokens"])), np.repeat(np.arange(len(mine)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            own, labels_ = mine["key"].to_numpy(), mine["c"].to_numpy()
            for key, c, tokens in zip(theirs["key"], theirs["c"], theirs["tokens"], strict=True):
                low, high = np.searchsorted(flat, tokens, "left"), np.searchsorted(flat, tokens, "right")
                n = high - low
                at = np.repeat(low - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(n.sum())
                common = np.bincount(owner[at], minlength=len(own))
                hit = (common * 100 >= (sizes + len(tokens) - common) * percent) & (labels_ != c)
                # one link to each of the query's components is enough
                for k in np.flatnonzero(hit):
                    found.append((key, own[k]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return queries.groupBy("g", "q", "p").cogroup(members.groupBy("g", "q", "p")).applyInPandas(compare, "a long, b long")


def join_by_shingles(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id: for each row its set's size and the smallest key that links reach from it.

    A text with fewer than `size` words has its whole sequence as its one shingle. NULL, empty
    texts and texts without words have empty sets and link with nothing. Rows with equal keys are
    one node; rows with a NULL key get their size and no component. Sets that are equal are
    joined before the search, so copies cost one comparison of fingerprints. An empty table gives
    no rows; further columns are not read. `percent` is 50 or more: below, prefixes of combinations
    may not suffice.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = documents.sparkSession
    prints = stored(fingerprints(documents, key, text, size), tidy=True)
    real = prints.filter("key IS NOT NULL AND n_shingles > 0")
    groups = real.groupBy("n_shingles", "f1", "f2").agg(F.min("key").alias("rep"), F.count("*").alias("copies")).filter("copies > 1")
    same = stored(real.select("key", "n_shingles", "f1", "f2").join(groups, ["n_shingles", "f1", "f2"], "left").select("key", F.coalesce("rep", "key").alias("rep")), tidy=True)
    texts = documents.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    total = real.agg(F.sum("n_shingles")).first()[0] or 0
    table = frequencies(texts.select("text"), size, table_bits(total))
    passing: list[str] = []
    with noting(passing):
        entries = stored(lists_of(postings(texts, table, total / len(table), size, percent)), tidy=True)
        can = (F.col("n") * 100 >= F.col("low") * percent) & (F.col("high") * 100 >= F.col("n") * percent)
        stars = entries.filter((F.col("key") != F.col("lead")) & can).select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
        links = stored(_verified(possible(stars, real, percent), texts, size, percent, total), tidy=True)
        labels = components(links)

        named = entries.drop("low", "high").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")
        named = stored(named, tidy=True)
        mixed = named.groupBy("sig").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("sig")
        open_ = stored(named.join(mixed, "sig"), tidy=True)
    removed(spark, passing, links.union(labels.toDF("a", "b")).union(open_.select("sig", "key")))
    with noting(passing):
        short = open_.filter(F.col("c") <= SHORT)
        other = short.select("sig", F.col("key").alias("b"), F.col("comp").alias("comp_b"), F.col("n").alias("nb"))
        pairs = short.join(other, "sig").filter((F.col("key") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & (F.col("key") != F.col("lead")) & sized("n", "nb", percent))
        more = _verified(possible(pairs.select(F.col("key").alias("a"), "b").distinct(), real, percent), texts, size, percent, total)
        long_ = open_.filter(F.col("c") > SHORT)
        regions = components(long_.select(F.col("lead").alias("a"), F.col("key").alias("b")))
        far = _blocks(long_, regions, labels, texts, size, percent)
        rest = stored(more.union(far), tidy=True)
        final = components(links.union(rest))
    removed(spark, passing, links.union(rest).union(final.toDF("a", "b")))

    same_key = same.groupBy("key").agg(F.min("rep").alias("rep"))
    extra = same.join(same_key.withColumnRenamed("rep", "low"), "key").filter("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    if extra.take(1):  # equal keys with different texts join their groups
        final = components(links.union(rest).union(extra))
    found = same_key.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("key").alias("k"), F.coalesce("component", "rep").alias("comp"))
    out = prints.join(found, F.col("key") == F.col("k"), "left")
    return out.select(F.col("key").alias(key), "n_shingles", F.coalesce("comp", "key").alias("component_id"))
