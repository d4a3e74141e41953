"""Language-model scores by context-tree weighting over bytes.

A text is read as its words (A-Z as a-z) joined by single spaces and closed by an end symbol.
Each byte is eight binary decisions; a decision is a node (last d bytes, bits so far) for every
depth d up to `depth`. A node's Krichevsky-Trofimov estimate is mixed with its deeper nodes by
the weights that context-tree weighting gives them: at a node, half of the prior stands for
"no deeper context matters" and half for the product of the deeper nodes. A deeper node that
training never saw says 1/2.

All contexts of the training corpus are in the model, however rare, and no task or driver holds
the tree. Texts are dealt to slices of some MB, written bucketed by slice. Each slice gives its
distinct grams (a byte with the `depth` before it) and how often training rows hold them. Grams
whose last two context bytes fall into one bucket are a forest of whole subtrees: a task sums
their counts over slices and weights them bottom-up. Their roots are summed into the nodes of
depth 1 and 0, of which there are 257 * 255 at the most; these go to all tasks. A bucket then
has each gram's code length once and answers the slices that asked for it, and texts are scored
slice by slice beside the answers. As the table is bucketed by slice, texts are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .store import shared_folder, shields, stored
from .words import LOWER, Words, as_long, find_words, mix, slices, text_bytes

DEPTH = 5
#: Subtrees from this depth on are whole in a bucket.
SPLIT = 2
BUCKETS = 256
#: Bytes of text in a slice; a longer text is one by itself.
SLICE_BYTES = 32 << 20
#: Words that go to all tasks, the most frequent; the others are joined.
MOST_WORDS = 1 << 17
END = 255
_END_WORD = int(mix(np.array([0x5EED], np.uint64)).view(np.int64)[0])
_LIST = 100_000
_WORDS_BUCKET = -1
_SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "n_symbols")


# --- counting -------------------------------------------------------------------------------


def stream(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that are modelled, and where each text begins in them (one more than texts)."""
    size = words.end - words.begin
    n = np.diff(words.offsets)
    empty = (n == 0).astype(np.int64)
    gap = np.concatenate([[0], np.cumsum(empty)])  # end symbols of texts without words before each text
    at = np.concatenate([[0], np.cumsum(size + 1)])[:-1] + np.repeat(gap[:-1], n)
    lengths = np.bincount(np.repeat(np.arange(len(n)), n), size + 1, len(n)).astype(np.int64) + empty
    begins = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(begins[-1], 32, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.concatenate([[0], np.cumsum(size)])[:-1], size)
    out[np.repeat(at, size) + inside] = LOWER[data[np.repeat(words.begin, size) + inside]]
    out[begins[1:] - 1] = END
    return out, begins


def grams(symbols: np.ndarray, begins: np.ndarray, depth: int) -> np.ndarray:
    """Each symbol (lowest byte) with the `depth` before it; before a text stand end symbols."""
    out = symbols.astype(np.uint64)
    for k in range(1, depth + 1):
        before = np.full(len(symbols), END, np.uint8)
        before[k:] = symbols[:-k]
        for j in range(k):
            at = begins[:-1] + j
            before[at[at < begins[1:]]] = END
        out |= before.astype(np.uint64) << np.uint64(8 * k)
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def texts_table(documents: DataFrame, text: str) -> DataFrame:
    """`documents` with _row (a number of its own) and _slice, written once, bucketed by slice."""
    schema = StructType([*documents.schema.fields, StructField("_row", LongType()), StructField("_slice", LongType())])
    at = documents.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        row, number, held = base, base, 0
        for batch in batches:
            sizes = np.diff(text_bytes(batch.column(at))[1])
            before = held + np.cumsum(sizes) - sizes
            # a slice ends with the text that fills it
            of = np.empty(len(sizes), np.int64)
            first = 0
            while first < len(sizes):
                last = int(np.searchsorted(before, SLICE_BYTES)) if before[-1] >= SLICE_BYTES else len(sizes)
                last = max(last, first)
                of[first:last] = number
                if last < len(sizes):
                    before = before - before[last]
                    number += 1
                first = last
            held = int(before[-1] + sizes[-1]) if len(sizes) else held
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(row, row + len(sizes))), pa.array(of)], names=schema.names)
            row += len(sizes)

    spark, name = documents.sparkSession, f"voltline_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    writer = documents.mapInArrow(work, schema).write.format("parquet").option("compression", "zstd")
    writer.option("path", f"{shared_folder(spark)}/{name}").bucketBy(buckets, "_slice").sortBy("_slice").saveAsTable(name)
    return spark.table(name)


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def slice_counts(texts: DataFrame, text: str, learns: str, depth: int) -> DataFrame:
    """_slice, bucket, keys (in order) and n: how often rows that are learned from hold each gram of the slice; words and ends of those rows are in a bucket of their own."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))

    def flush(number: int, symbols: list, tokens: list) -> Iterator[pa.RecordBatch]:
        keys, n = merged(symbols)
        bucket = bucket_of(keys)
        order = np.argsort(bucket, kind="stable")
        keys, n, bucket = keys[order], n[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(keys))
        parts = [(bucket[cuts[:-1]], cuts, keys, n)]
        if tokens:
            keys, n = merged(tokens)
            cuts = np.append(np.arange(0, len(keys), _LIST), len(keys))
            parts.append((np.full(len(cuts) - 1, _WORDS_BUCKET), cuts, keys, n))
        for bucket, cuts, keys, n in parts:
            columns = [pa.array(np.full(len(bucket), number)), pa.array(bucket, pa.int32()), _lists(cuts, as_long(keys)), _lists(cuts, as_long(n))]
            yield pa.RecordBatch.from_arrays(columns, names=["_slice", "bucket", "keys", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, symbols, tokens = None, [], []
        for batch in batches:
            of, learn = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            data, offsets = text_bytes(batch.column(2))
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else [0]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if of[low] != number and symbols:
                    yield from flush(number, symbols, tokens)
                    symbols, tokens = [], []
                number = int(of[low])
                for i, j in slices(offsets[low : high + 1] - offsets[low]):
                    i, j = i + low, j + low
                    part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                    words = find_words(part, own)
                    bytes_, begins = stream(part, words)
                    codes, on = grams(bytes_, begins, depth), np.repeat(learn[i:j], np.diff(begins))
                    symbols.append(np.unique(codes[on], return_counts=True))
                    rest = np.unique(codes[~on])
                    symbols.append((rest, np.zeros(len(rest), np.int64)))
                    ends = np.full(np.count_nonzero(learn[i:j]), _END_WORD, np.int64).view(np.uint64)
                    if len(ends):
                        tokens.append(np.unique(np.concatenate([words.hashes[np.repeat(learn[i:j], np.diff(words.offsets))], ends]), return_counts=True))
                    if len(symbols) > 32:
                        symbols, tokens = [merged(symbols)], [merged(tokens)] if tokens else []
        if symbols:
            yield from flush(number, symbols, tokens)

    return texts.select("_slice", learns, text).mapInArrow(work, "_slice long, bucket int, keys array<long>, n array<long>")


# --- the model ------------------------------------------------------------------------------


def bucket_of(codes: np.ndarray) -> np.ndarray:
    """Bucket of a gram, by the two bytes before its symbol."""
    return (mix(codes >> np.uint64(8) & np.uint64(0xFFFF)) % np.uint64(BUCKETS)).astype(np.int64)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = sum(np.log(x + k) for k in range(10))
    x = x + 10
    return (x - 0.5) * np.log(x) - x + 0.918938533204672742 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - 2 * 0.572364942924700087


class Level:
    """The nodes of one depth: sorted keys (context << 8 | 1 and the bits so far), counts, weighted log probability, estimate of a one, weight of stopping."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, deeper: np.ndarray | None):
        """deeper: sums of the weighted log probabilities of the nodes one byte deeper, None at the last depth."""
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = _log_kt(zeros, ones)
        self.one = (ones + 0.5) / (zeros + ones + 1)
        if deeper is None:
            self.weighted, self.stop = own, np.ones(len(keys))
        else:
            both = np.logaddexp(own, deeper)
            self.weighted, self.stop = both - np.log(2), np.exp(own - both)

    def above(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, counts and sums of weighted log probabilities of the nodes at `depth`, one less than this level's."""
        keys, at = np.unique(self.keys & np.uint64((1 << (8 * (depth + 1))) - 1), return_inverse=True)
        return keys, *(np.bincount(at, x, len(keys)).astype(float) for x in (self.zeros, self.ones, self.weighted))


def levels(keys: np.ndarray, counts: np.ndarray, depth: int, low: int) -> list[Level]:
    """The levels from `low` to `depth` over grams and how often training holds them."""
    keys, counts = keys[counts > 0], counts[counts > 0]
    out = [Level(*_nodes(keys, counts), None)]
    for d in range(depth - 1, low - 1, -1):
        out.insert(0, Level(*out[0].above(d)))
    return out


def _nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary nodes with how often a zero and a one followed."""
    parts, bits = [], []
    symbol = keys & np.uint64(255)
    for bit in range(8):
        parts.append((keys & ~np.uint64(255)) | (np.uint64(1) << np.uint64(bit)) | (symbol >> np.uint64(8 - bit)))
        bits.append((symbol >> np.uint64(7 - bit)) & np.uint64(1))
    node, one, n = np.concatenate(parts), np.concatenate(bits).astype(bool), np.tile(counts, 8).astype(float)
    out, at = np.unique(node, return_inverse=True)
    return out, np.bincount(at, n * ~one, len(out)).astype(float), np.bincount(at, n * one, len(out)).astype(float)


def log10(tree: list[Level], codes: np.ndarray) -> np.ndarray:
    """log10 of each gram's last byte after its context; tree: all levels from depth 0."""
    total = np.zeros(len(codes))
    symbol = codes & np.uint64(255)
    for bit in range(8):
        node = (np.uint64(1) << np.uint64(bit)) | (symbol >> np.uint64(8 - bit))
        ones = np.full(len(codes), 0.5)
        for depth in range(len(tree) - 1, -1, -1):
            level = tree[depth]
            if not len(level.keys):
                continue
            want = (codes & np.uint64((1 << (8 * (depth + 1))) - 256)) | node
            at = np.minimum(np.searchsorted(level.keys, want), len(level.keys) - 1)
            hit = np.flatnonzero(level.keys[at] == want)
            at = at[hit]
            ones[hit] = level.stop[at] * level.one[at] + (1 - level.stop[at]) * ones[hit]
        set_ = (symbol >> np.uint64(7 - bit)) & np.uint64(1) == 1
        total += np.log10(np.where(set_, ones, 1 - ones))
    return total


def _flat(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(kind)


def fold(parts: DataFrame, depth: int) -> DataFrame:
    """bucket, its grams (keys, n), and what its subtrees give to the nodes of depth 1 (above, zeros, ones, weighted)."""

    def done(bucket: int, found: list) -> pa.RecordBatch:
        keys, n = summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
        above = levels(keys, n, depth, SPLIT)[0].above(SPLIT - 1)
        lists = [_lists(np.array([0, len(x)]), as_long(x) if k < 3 else pa.array(x)) for k, x in enumerate([keys, n, *above])]
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *lists], names=["bucket", "keys", "n", "above", "zeros", "ones", "weighted"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, found, held = None, [], 0
        for batch in batches:
            of = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else [0]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if found and of[i] != bucket:
                    yield done(bucket, found)
                    found, held = [], 0
                bucket, some = int(of[i]), batch.slice(i, j - i)
                found.append((_flat(some.column(1), np.uint64), _flat(some.column(2), np.int64)))
                held += len(found[-1][0])
                if held > 2 * len(found[0][0]) + 10 * _LIST:
                    found = [summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))]
                    held = len(found[0][0])
        if found:
            yield done(bucket, found)

    rows = parts.select("bucket", "keys", "n").repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(work, "bucket int, keys array<long>, n array<long>, above array<long>, zeros array<double>, ones array<double>, weighted array<double>")


def top_levels(models: DataFrame) -> list[Level]:
    """The levels of depth 0 and 1, at most 257 * 255 nodes; sums are exact, so they don't follow the partitioning."""
    roots = models.select(F.explode(F.arrays_zip("above", "zeros", "ones", "weighted")).alias("r")).select("r.*")
    sums = roots.groupBy("above").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum(F.col("weighted").cast("decimal(38,12)")).cast("double").alias("weighted")).toArrow()
    keys, zeros, ones, weighted = (sums[c].to_numpy() for c in ("above", "zeros", "ones", "weighted"))
    order = np.argsort(keys)
    one = Level(keys[order].view(np.uint64), zeros[order], ones[order], weighted[order])
    return [Level(*one.above(0)), one]


def answers(parts: DataFrame, models: DataFrame, top: list[Level], depth: int) -> DataFrame:
    """_slice, keys and logs: log10 of the probability of each gram that the slice holds."""
    shared = parts.sparkSession.sparkContext.broadcast(top)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = logs = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("_slice").is_null().to_numpy(zero_copy_only=False))
            for i, j in zip([0, *heads.tolist()], [*heads.tolist(), batch.num_rows], strict=True):
                some = batch.slice(i, j - i)
                if some.num_rows and not some.column("_slice")[0].is_valid:
                    head = some.slice(0, 1)
                    keys = _flat(head.column("keys"), np.uint64)
                    tree = shared.value + levels(keys, _flat(head.column("n"), np.int64), depth, SPLIT)
                    logs = np.concatenate([log10(tree, keys[k : k + _LIST]) for k in range(0, len(keys), _LIST)])
                    some = some.slice(1)
                if not some.num_rows:
                    continue
                asked = _flat(some.column("keys"), np.uint64)
                bounds = np.concatenate([[0], np.cumsum(some.column("keys").value_lengths().to_numpy())])
                found = [_lists(bounds, as_long(asked)), _lists(bounds, pa.array(logs[np.searchsorted(keys, asked)]))]
                yield pa.RecordBatch.from_arrays([some.column("_slice"), *found], names=["_slice", "keys", "logs"])

    heads = models.select(F.lit(None).cast("long").alias("_slice"), "bucket", "keys", "n")
    asked = parts.select("_slice", "bucket", "keys", F.lit(None).cast("array<long>").alias("n"))
    rows = heads.union(asked).repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("_slice"))
    return rows.mapInArrow(look, "_slice long, keys array<long>, logs array<double>")


# --- scores ---------------------------------------------------------------------------------


def score_texts(documents: DataFrame, training: Column, text: str = "text", depth: int = DEPTH, most_words: int = MOST_WORDS) -> DataFrame:
    """All columns of `documents` but the text, then n_tokens, n_known, train_tokens (long), base_score, score, n_symbols.

    Learns from the rows for which `training` is true. score: log10 of the text's probability
    under the tree of `depth` (2 or more); -score * log2(10) / n_symbols is its code length per
    byte. base_score: of its tokens, words and one end, by add-one counts. NULL counts as the
    empty text: one end token. Without training rows every bit has 1/2, and N and V are 0.
    Repeated rows are scored each; an empty table gives no rows; columns with the names of added
    ones are replaced. Intermediate tables go to the shared folder; the one of texts is bucketed,
    so it also has a name in the session's catalogue.
    """
    if not SPLIT <= depth <= 7:
        raise ValueError("depth must be 2 to 7")
    learns = "_learns"
    while learns in [c.lower() for c in documents.columns]:
        learns += "_"
    return _scored(documents.withColumn(learns, F.coalesce(training, F.lit(False))), learns, text, depth, most_words)


@shields(*_SCORES)
def _scored(documents: DataFrame, learns: str, text: str, depth: int, most_words: int) -> DataFrame:
    spark = documents.sparkSession
    texts = texts_table(documents, text)
    parts = stored(slice_counts(texts, text, learns, depth))
    trees = parts.filter(F.col("bucket") != _WORDS_BUCKET)
    models = stored(fold(trees, depth))
    known = answers(trees, models, top_levels(models), depth)
    listed = parts.filter(F.col("bucket") == _WORDS_BUCKET).select(F.explode(F.arrays_zip("keys", "n")).alias("w"))
    words = stored(listed.groupBy(F.col("w.keys").alias("key")).agg(F.sum("w.n").alias("n")))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = words.orderBy(F.desc("n"), "key").limit(most_words).toArrow()
    keys = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], np.log10(top["n"].to_numpy()[order] + 1.0)))
    fields = [f for f in documents.schema.fields if f.name not in (text, learns)] + [StructField("_row", LongType())]
    added = [("n_tokens", LongType()), ("n_known", LongType()), ("base_score", DoubleType()), ("score", DoubleType()), ("n_symbols", LongType()), ("_words", ArrayType(LongType())), ("_times", ArrayType(LongType()))]
    schema = StructType(fields + [StructField(k, t) for k, t in added])

    def score(rows: pa.Table, known: pa.Table) -> pa.Table:
        common, logs = shared.value
        grams_, values = (np.concatenate([_flat(c, t) for c in known[n].chunks]) if known.num_rows else np.zeros(0, t) for n, t in (("keys", np.uint64), ("logs", np.float64)))
        order = np.argsort(grams_)
        grams_, values = grams_[order], values[order]
        rows = rows.combine_chunks()
        data, offsets = text_bytes(rows[text])
        parts = []
        for i, j in slices(offsets):
            part, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            found = find_words(part, own)
            symbols, begins = stream(part, found)
            codes, at = np.unique(grams(symbols, begins, depth), return_inverse=True)
            scores = np.add.reduceat(values[np.searchsorted(grams_, codes)][at], begins[:-1])
            owner = np.repeat(np.arange(j - i), np.diff(found.offsets))
            spot = np.minimum(np.searchsorted(common, found.hashes), max(len(common) - 1, 0))
            known = common[spot] == found.hashes if len(common) else np.zeros(len(found.hashes), bool)
            base = np.bincount(owner[known], logs[spot[known]], j - i).astype(float)  # without entries it counts in integers
            rest_owner, rest = owner[~known], found.hashes[~known]
            ends = np.arange(j - i)
            rest_owner, rest = np.concatenate([rest_owner, ends]), np.concatenate([rest, np.full(j - i, _END_WORD, np.int64).view(np.uint64)])
            end_at = np.searchsorted(common, rest[-1:])[0]
            if len(common) and end_at < len(common) and common[end_at] == rest[-1]:
                base += logs[end_at]
                rest_owner, rest = rest_owner[: -(j - i)], rest[: -(j - i)]
                n_known = np.bincount(owner[known], minlength=j - i) + 1
            else:
                n_known = np.bincount(owner[known], minlength=j - i)
            order = np.lexsort((rest, rest_owner))
            rest_owner, rest = rest_owner[order], rest[order]
            new = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (rest_owner[1:] != rest_owner[:-1])])) if len(rest) else np.zeros(0, np.int64)
            times = np.diff(np.concatenate([new, [len(rest)]]))
            lists = np.searchsorted(rest_owner[new], np.arange(j - i + 1)).astype(np.int32)
            out = [rows[f.name].slice(i, j - i) for f in fields]
            out += [pa.array(np.diff(found.offsets) + 1), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(scores), pa.array(np.diff(begins))]
            out += [pa.ListArray.from_arrays(pa.array(lists), as_long(x)) for x in (rest[new], times)]
            parts.append(pa.Table.from_arrays(out, names=schema.names))
        return pa.concat_tables(parts)

    first = stored(texts.drop(learns).groupBy("_slice").cogroup(known.groupBy("_slice")).applyInArrow(score, schema))
    rare = first.select("_row", F.explode(F.arrays_zip("_words", "_times")).alias("x")).select("_row", F.col("x._words").alias("key"), F.col("x._times").alias("times"))
    c = F.coalesce(F.col("n"), F.lit(0))
    tail = rare.join(words, "key").groupBy(F.col("_row").alias("_r")).agg(F.sum(F.col("times") * F.log10(c + 1.0)).alias("_log"), F.sum("times").alias("_k"))
    out = first.join(tail, F.col("_row") == F.col("_r"), "left")
    scale = float(np.log10(total["n"] + total["v"] + 1))
    zero = F.lit(0)
    return out.select(
        *[f.name for f in fields if f.name != "_row"], "n_tokens", (F.col("n_known") + F.coalesce("_k", zero)).alias("n_known"), F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_log", zero) - F.col("n_tokens") * scale).alias("base_score"), "score", "n_symbols",
    )
