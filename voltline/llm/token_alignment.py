"""Alignment of the tokens of two tokenizers, and how often the corpus links each pair of tokens.

Both tokenizers cut the same bytes. Places where a token of each ends cut a text into groups;
tokens of one group are linked. Tokens are made once and written as a table that is bucketed by
slice, a few MB of texts each.

The first pass over that table aligns all texts and gives, for each slice, its distinct pairs
and in how many of its documents they are linked. A bucket of first tokens holds all pairs of
those tokens. The distinct pairs of each bucket get a minimal perfect hash function: bits in
levels, where a pair takes the first level in which no other pair falls on its place, and its
number is the rank of that bit. Counts are dense vectors in the order of these numbers. The
slices are dealt to lanes; each lane adds into a vector of its own, and the vectors of lanes
are added. What goes into a task is a function of one bucket and a stream of slices.

The second pass asks each bucket for the counts of the slices' pairs. The number that a pair
gets is verified by the key stored under it. Then it aligns the texts again, slice by slice, beside the answers to
that slice. As the table is bucketed by slice, tokens are never shuffled.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from . import byte_bpe, token_counts
from .store import shared_folder, shields, stored
from .words import mix

#: Bytes of text in a slice; a longer text is one by itself.
SLICE_BYTES = 8 << 20
#: Units of up to so many characters are remembered, and so many of them in a process.
UNIT_CHARS, UNITS = 64, 1 << 18
#: A space that begins a unit; characters that not everyone takes for white space, or that B takes for a space.
_UNIT = re.compile(r"(?<=\S) ")
_SPACES = re.compile(r"\s ")
_ODD = re.compile("[\x1c-\x1f\x85\u180e\u200b\u2581\ufeff]")
#: Aligned at once: so many tokens, and so many links.
GROUP_TOKENS, BLOCK_LINKS = 1 << 18, 1 << 19
#: In groups with more links than this, equal tokens are taken together.
LARGE_GROUP = 1 << 12
#: Buckets of first tokens. A bucket holds no more pairs than two vocabularies allow.
BUCKETS = 1024
LANES = 4
#: Places per pair in a level of a function.
SPARE = 2
_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
_loaded: dict[tuple[str, str], Tokenizers] = {}


class Tokenizers:
    """A byte-level BPE of the tokenizers library (A) and a sentencepiece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        spec = json.loads(self.a.to_str())
        pre = spec["pre_tokenizer"] or {}
        #: Whether a text may be cut where a match of the byte-level pattern is sure to end.
        self.cut = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.code = token_counts.encoder(b_path)
        self.b = self.code.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others follow from 256 on
        value = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        self.kind = np.dtype(np.uint16 if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else np.uint32)
        #: Pairs are numbered first token times this, plus second token.
        self.width = len(self.b_bytes)
        ids = [list(map(str, range(len(x)))) for x in (self.a_bytes, self.b_bytes)]
        #: Whether no token of A or B goes from a character that isn't white space into a space: a text may be encoded in units then.
        special = all(x["special"] for x in spec["added_tokens"])
        self.apart = self.cut and special and self.code.plain and all(p[0] == "▁" or p[0].isspace() for p in self.code.pairs if p[1] == "▁")
        self.units: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.names = [i + s for some, seps in zip(ids, (",|", ",;"), strict=True) for s in seps for i in some]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        pieces = [list(byte_bpe.parts(t)) if self.cut else [t] for t in texts]
        ids = iter(self.a.encode_batch_fast([p for some in pieces for p in some], add_special_tokens=False))
        return [[i for _ in some for i in next(ids).ids] if len(some) > 1 else next(ids).ids for some in pieces]

    def encode_b(self, texts: list[str], size: int = byte_bpe.PART_CHARS) -> list[list[int]]:
        short = self.b.encode([t if len(t) <= size else "" for t in texts], num_threads=1)
        return [s if len(t) <= size else self._long(t, size) for t, s in zip(texts, short, strict=True)]

    def _long(self, text: str, size: int) -> list[int]:
        """A long text in parts, cut between characters that stand side by side in no piece, so that no merge crosses the cut."""
        if not self.code.plain:
            return self.b.encode(text)
        out, start, lead = [], 0, ""
        skip = len(self.b.encode(self.code.guard))
        while start < len(text):
            cut = start + size
            while cut < len(text) and text[cut - 1 : cut + 1].replace(" ", "▁") in self.code.pairs:
                cut += 1
            ids = self.b.encode(lead + text[start:cut])
            out += ids[skip if lead else 0 :]
            start, lead = cut, self.code.guard
        return out

    def encode(self, texts: list[str | None]) -> tuple[list[bytes], list[bytes]]:
        """Ids of A and B, packed; none where the text has none or the tokens don't stand for it.

        A unit is a space and what follows up to the next space that stands after something else.
        Each different unit is encoded once while it is remembered; a text with a unit whose tokens
        don't stand for it, or with odd characters, is encoded as a whole.
        """
        some = [t or "" for t in texts]
        if not self.apart:
            return self._whole(some)
        cut = [None if _ODD.search(t) else _UNIT.split(t) if t[:1] == " " or _SPACES.search(t) else t.split(" ") for t in some]
        a_of, b_of = self.units
        if len(a_of) > UNITS:
            a_of.clear()
            b_of.clear()
        new = list({u for units in cut if units for u in units if u not in a_of})
        for u, a, b in self._each([u for u in new if u and not u[-1].isspace()]):
            a_of[u], b_of[u] = a, b
        ends = [u for u in new if u and u[-1].isspace()]
        for u, a, b in zip(ends, *self._whole(ends), strict=True):
            if a:
                a_of[u], b_of[u] = a, b
        out: tuple[list[bytes], list[bytes]] = ([], [])
        for t, units in zip(some, cut, strict=True):
            try:
                a, b = (b"".join(map(of.__getitem__, units or [None])) for of in self.units)
            except KeyError:  # a space by itself, or a unit that its tokens don't stand for
                (a,), (b,) = self._whole([t])
            out[0].append(a)
            out[1].append(b)
        for u in new:
            if len(u) > UNIT_CHARS:
                a_of.pop(u, None)
                b_of.pop(u, None)
        return out

    def _each(self, units: list[str]) -> Iterator[tuple[str, bytes, bytes]]:
        """Units with their packed ids, without those that their tokens don't stand for; none ends in white space."""
        sizes = np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))
        for i, j in byte_bpe.groups(sizes, byte_bpe.PART_CHARS):
            some = units[i:j]
            ids = [x[0] for x in self._whole([" ".join(some)])]
            if not ids[0]:
                yield from ((u, a, b) for u, a, b in zip(some, *self._whole(some), strict=True) if a)
                continue
            ends = np.cumsum(sizes[i:j])
            cuts = []
            for packed, of in zip(ids, (self.a_sizes, self.b_sizes), strict=True):
                at = np.cumsum(of[np.frombuffer(packed, self.kind)])
                last = np.searchsorted(at, ends)
                if (at[last] != ends).any():
                    raise ValueError("a token goes on from one unit into the next")
                cuts.append([0, *((last + 1) * self.kind.itemsize).tolist()])
            (a, b), (a_cuts, b_cuts) = ids, cuts
            for k, u in enumerate(some):
                yield u, a[a_cuts[k] : a_cuts[k + 1]], b[b_cuts[k] : b_cuts[k + 1]]

    def _whole(self, some: list[str]) -> tuple[list[bytes], list[bytes]]:
        out: tuple[list[bytes], list[bytes]] = ([], [])
        for t, a, b in zip(some, self.encode_a([" " + t for t in some]), self.encode_b(some), strict=True):
            data = b" " + t.encode()
            whole = t and b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b))
            out[0].append(np.array(a, self.kind).tobytes() if whole else b"")
            out[1].append(np.array(b, self.kind).tobytes() if whole else b"")
        return out


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


# --- alignment --------------------------------------------------------------------------------


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and how many each row has."""
    sizes = byte_bpe.sizes_of(column) // kind.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64), sizes


class Alignment:
    """The groups of some documents that have the same bytes in a as in b; ids of all of them in a row."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sizes: tuple[np.ndarray, np.ndarray]):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends = [np.cumsum(s[ids]) for s, ids in zip(sizes, (a, b), strict=True)]
        total = int(ends[0][-1]) if len(a) else 0
        seen = np.zeros(total + 1, np.int8)
        for e in ends:
            seen[e] += 1
        before = np.cumsum(seen == 2, dtype=np.int32)
        self.group = [before[e - 1] for e in ends]  # of each token: ends in common before its own
        n = int(before[-1])
        self.size = [np.bincount(g, minlength=n) for g in self.group]
        self.first = [np.cumsum(s) - s for s in self.size]
        self.doc = np.repeat(np.arange(len(n_a)), n_a)  # of each a
        last = np.cumsum(n_a)
        at = np.concatenate([[0], self.group[0] + 1])[last] if n else np.zeros(len(n_a), np.int64)  # groups up to each document's end
        self.groups_to = np.maximum.accumulate(at) if len(at) else at

    def n_groups(self) -> np.ndarray:
        return np.diff(self.groups_to, prepend=0)

    def links(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Document, pair and number of links, in blocks; a document's pair may come more than once."""
        large = self.size[0] * self.size[1] > LARGE_GROUP
        sides = []
        for ids, group in zip((self.a, self.b), self.group, strict=True):
            times = np.ones(len(ids), np.int64)
            some = np.flatnonzero(large[group])
            if len(some):
                of, back, n = np.unique(group[some].astype(np.int64) << 32 | ids[some], return_index=True, return_counts=True)
                keep = ~large[group]
                keep[some[back]] = True
                times[some[back]] = n
                ids, group, times = ids[keep], group[keep], times[keep]
                doc = self.doc[keep] if not sides else None
            else:
                doc = self.doc if not sides else None
            sides.append((ids, group, times, doc))
        (a, group, a_times, doc), (b, b_group, b_times, _) = sides
        size = np.bincount(b_group, minlength=len(large))
        first = (np.cumsum(size) - size)[group]
        count = size[group]
        for i, j in byte_bpe.groups(count, BLOCK_LINKS):
            n = count[i:j]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(first[i:j] - ends + n, n)
            yield np.repeat(doc[i:j], n), np.repeat(a[i:j] * width, n) + b[at], np.repeat(a_times[i:j], n) * b_times[at]

    def pairs(self, width: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair and number of links, each pair of a document once; pairs are numbers under `span`."""
        keys, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, pair, n in self.links(width):
            k, t = _added(doc * span + pair, n)
            keys.append(k)
            times.append(t)
        key, n = _added(np.concatenate(keys), np.concatenate(times)) if len(keys) > 2 else (keys[-1], times[-1])
        return key // span, key % span, n

    def texts(self, names: list[str], n_a: int, n_b: int) -> list[str]:
        """Each document's groups in decimal ids: a,a|b;a|b,b."""
        at = np.cumsum(self.size[0] + self.size[1]) - self.size[0] - self.size[1]
        code = np.empty(len(self.a) + len(self.b), np.int64)
        for side, ids in enumerate((self.a, self.b)):
            group = self.group[side]
            rank = np.arange(len(ids)) - self.first[side][group]
            last = rank == self.size[side][group] - 1
            code[at[group] + (self.size[0][group] if side else 0) + rank] = ids + (2 * n_a + last * n_b if side else last * n_a)
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        code, start, out = code.tolist(), 0, []
        for end in ends:
            out.append("".join(map(names.__getitem__, code[start:end]))[:-1])
            start = end
        return out


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def _alignments(a: pa.Array, b: pa.Array, t: Tokenizers) -> Iterator[tuple[int, int, Alignment]]:
    """Ranges of rows with their alignments."""
    a_ids, n_a = unpacked(a, t.kind)
    b_ids, n_b = unpacked(b, t.kind)
    a_to, b_to = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    for i, j in byte_bpe.groups(n_a + n_b, GROUP_TOKENS):
        yield i, j, Alignment(a_ids[a_to[i] : a_to[j]], b_ids[b_to[i] : b_to[j]], n_a[i:j], n_b[i:j], (t.a_sizes, t.b_sizes))


# --- minimal perfect hashing ------------------------------------------------------------------


class Numbering:
    """Distinct keys numbered from 0 without gaps, by bits in levels.

    At each level the keys left fall on SPARE places per key; a place hit by one key alone is its
    bit. Other keys get whatever number their bits lead to, or -1.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, low = [], 0
        for bits in levels:
            self.ranks.append(low - 1 + np.cumsum(bits))
            low += int(bits.sum())
        self.size = low

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> Numbering:
        levels = []
        while len(keys):
            size = SPARE * len(keys) + 8
            at = cls.places(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self.places(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out

    def packed(self) -> tuple[bytes, bytes]:
        """Lengths of the levels, and their bits."""
        lengths = np.array([len(x) for x in self.levels], np.int64)
        return lengths.tobytes(), np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)])).tobytes()

    @classmethod
    def unpacked(cls, lengths: bytes, bits: bytes) -> Numbering:
        ends = np.cumsum(np.frombuffer(lengths, np.int64))
        flat = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        return cls(np.split(flat[: ends[-1]], ends[:-1]) if len(ends) else [])


# --- tables -----------------------------------------------------------------------------------


def tokens_table(documents: DataFrame, a_path: str, b_path: str, text: str) -> DataFrame:
    """All columns but the text, slice, and the packed ids a and b, written as a table in buckets of slices."""
    at = documents.columns.index(text)
    kept = [f for i, f in enumerate(documents.schema.fields) if i != at]
    schema = StructType([*kept, StructField("slice", LongType()), StructField("a", BinaryType()), StructField("b", BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, number, held = tokenizers_of(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            column = batch.column(at)
            sizes = byte_bpe.sizes_of(column)
            for i, j in byte_bpe.groups(sizes, 1 << 18):
                a, b = t.encode(column.slice(i, j - i).to_pylist())
                others = [c.slice(i, j - i) for k, c in enumerate(batch.columns) if k != at]
                more = [pa.array(np.full(j - i, number)), pa.array(a, pa.binary()), pa.array(b, pa.binary())]
                yield pa.RecordBatch.from_arrays([*others, *more], names=schema.names)
                held += int(sizes[i:j].sum())
                if held >= SLICE_BYTES:
                    number, held = number + 1, 0

    spark, name = documents.sparkSession, f"voltline_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    writer = documents.mapInArrow(work, schema).write.format("parquet").option("compression", "zstd")
    writer.option("path", f"{shared_folder(spark)}/{name}").bucketBy(buckets, "slice").sortBy("slice").saveAsTable(name)
    return spark.table(name)


def slice_pairs(tokens: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """slice, bucket, pairs (in order) and docs: in how many documents of the slice each is linked. A slice may have several rows of a bucket."""

    def flush(number: int, found: list[tuple[np.ndarray, np.ndarray]], width: int) -> Iterator[pa.RecordBatch]:
        pairs, docs = _added(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))
        if not len(pairs):
            return
        bucket = pairs // width % BUCKETS
        order = np.argsort(bucket, kind="stable")
        bucket, pairs, docs = bucket[order], pairs[order], docs[order]
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        at = pa.array(np.append(first, len(pairs)), pa.int32())
        columns = [pa.array(np.full(len(first), number)), pa.array(bucket[first].astype(np.int32)), pa.ListArray.from_arrays(at, pa.array(pairs)), pa.ListArray.from_arrays(at, pa.array(docs))]
        yield pa.RecordBatch.from_arrays(columns, names=["slice", "bucket", "pairs", "docs"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers_of(a_path, b_path)
        span, number, found = t.width * len(t.a_bytes), None, []
        for batch in batches:
            slices = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(slices)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if slices[i] != number and found:
                    yield from flush(number, found, t.width)
                    found = []
                number = int(slices[i])
                for _, _, aligned in _alignments(batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), t):
                    _, pair, _ = aligned.pairs(t.width, span)
                    found.append(_added(pair, np.ones(len(pair), np.int64)))
                if len(found) > 64:
                    found = [_added(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))]
        if found:
            yield from flush(number, found, t.width)

    return tokens.select("slice", "a", "b").mapInArrow(work, "slice long, bucket int, pairs array<long>, docs array<long>")


def numberings(parts: DataFrame) -> DataFrame:
    """bucket, lengths, bits (a minimal perfect hash function of the bucket's distinct pairs) and keys (packed, by number)."""

    def build(table: pa.Table) -> pa.Table:
        keys = table["pair"].to_numpy()
        number = Numbering.of(keys)
        by_number = np.empty(len(keys), np.int64)
        by_number[number(keys)] = keys
        lengths, bits = number.packed()
        return pa.table({"bucket": table["bucket"][:1], "lengths": [lengths], "bits": [bits], "keys": [by_number.tobytes()]})

    distinct = parts.select("bucket", F.explode("pairs").alias("pair")).distinct()
    return distinct.groupBy("bucket").applyInArrow(build, "bucket int, lengths binary, bits binary, keys binary")


def _beside(parts: DataFrame, functions: DataFrame) -> DataFrame:
    """The rows of each lane of a bucket in one task, in a stream that begins with the bucket's function."""
    lanes = functions.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    asked = parts.withColumn("lane", F.pmod(F.xxhash64("slice"), F.lit(LANES)).cast("int"))
    both = lanes.withColumn("later", F.lit(False)).unionByName(asked.withColumn("later", F.lit(True)), allowMissingColumns=True)
    return both.repartition("bucket", "lane").sortWithinPartitions("bucket", "lane", "later")


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def counts(parts: DataFrame, functions: DataFrame) -> DataFrame:
    """bucket and docs (packed): the dense vector of counts of its pairs, by number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, number, vector = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"bucket": pa.array([bucket], pa.int32()), "docs": [vector.tobytes()]})

        for batch in batches:
            later = batch.column("later").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(~later)
            for i, j in zip([0, *heads.tolist()], [*heads.tolist(), len(later)], strict=True):
                some = batch.slice(i, j - i)
                if not some.num_rows:
                    continue
                if not later[i]:
                    if vector is not None:
                        yield done()
                    bucket = some.column("bucket")[0].as_py()
                    number = Numbering.unpacked(some.column("lengths")[0].as_py(), some.column("bits")[0].as_py())
                    vector = np.zeros(number.size, np.int64)
                    some = some.slice(1)
                np.add.at(vector, number(_lists(some.column("pairs"))), _lists(some.column("docs")))
        if vector is not None:
            yield done()

    def total(table: pa.Table) -> pa.Table:
        vectors = [np.frombuffer(x, np.int64) for x in table["docs"].to_pylist()]
        return pa.table({"bucket": table["bucket"][:1], "docs": [np.sum(vectors, axis=0).tobytes()]})

    lanes = _beside(parts.select("slice", "bucket", "pairs", "docs"), functions.select("bucket", "lengths", "bits")).mapInArrow(add, "bucket int, docs binary")
    return lanes.groupBy("bucket").applyInArrow(total, "bucket int, docs binary")


def answers(parts: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """slice, pairs, docs (of the corpus) and best: whether no pair of the same first token has more."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = keys = docs = best = None
        for batch in batches:
            later = batch.column("later").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(~later)
            for i, j in zip([0, *heads.tolist()], [*heads.tolist(), len(later)], strict=True):
                some = batch.slice(i, j - i)
                if not some.num_rows:
                    continue
                if not later[i]:
                    head = {n: some.column(n)[0].as_py() for n in ("lengths", "bits", "keys", "total")}
                    number = Numbering.unpacked(head["lengths"], head["bits"])
                    keys, docs = np.frombuffer(head["keys"], np.int64), np.frombuffer(head["total"], np.int64)
                    first, of = np.unique(keys // width, return_inverse=True)
                    most = np.zeros(len(first), np.int64)
                    np.maximum.at(most, of, docs)
                    best = docs == most[of]
                    some = some.slice(1)
                if not some.num_rows:
                    continue
                pairs = _lists(some.column("pairs"))
                at = number(pairs)
                if (at < 0).any() or (keys[at] != pairs).any():
                    raise ValueError("a pair has no number of its own")
                offsets = pa.array(np.concatenate([[0], np.cumsum(byte_bpe.sizes_of(some.column("pairs")))]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pairs, docs[at], best[at])]
                yield pa.RecordBatch.from_arrays([some.column("slice"), *lists], names=["slice", "pairs", "docs", "best"])

    stream = _beside(parts.select("slice", "bucket", "pairs"), index)
    return stream.mapInArrow(look, "slice long, pairs array<long>, docs array<long>, best array<boolean>")


@shields(*_COUNTS, "groups")
def align_tokenizers(documents: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """All columns of `documents` but the text, then n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups.

    a_path: a byte-level BPE for the tokenizers library, given a space and the text; b_path: a
    sentencepiece model that adds that space. groups: the token ids as a,a|b;a|b,b. A pair's count
    is the number of documents (rows) in which it is linked. n_best: links whose pair has the
    highest count of its A token, ties included; count_sum: counts summed over links. NULL and
    empty texts, and those whose tokens don't stand for their bytes, have no tokens: zeros and an
    empty string. Repeated rows each count and keep theirs; an empty table gives no rows; columns
    with the new names are replaced. A very long text is encoded in parts but aligned as a whole.
    The paths must exist on every executor. Intermediate tables go to the shared folder; the one
    of tokens is bucketed, so it also has a name in the session's catalogue.
    """
    tokens = tokens_table(documents, a_path, b_path, text)
    parts = stored(slice_pairs(tokens, a_path, b_path))
    functions = stored(numberings(parts))
    vectors = counts(parts, functions).withColumnRenamed("docs", "total")
    index = stored(functions.join(vectors, "bucket"))
    width = tokenizers_of(a_path, b_path).width
    kept = [f for f in documents.schema.fields if f.name != text]
    schema = StructType([*kept, *[StructField(n, LongType()) for n in _COUNTS], StructField("groups", StringType())])

    def finish(rows: pa.Table, known: pa.Table) -> pa.Table:
        t = tokenizers_of(a_path, b_path)
        rows = rows.combine_chunks()
        span = t.width * len(t.a_bytes)
        pairs, docs, best = (np.concatenate([_lists(c) for c in known[n].chunks]) if known.num_rows else np.zeros(0, np.int64) for n in ("pairs", "docs", "best"))
        order = np.argsort(pairs, kind="stable")
        pairs, docs, best = pairs[order], docs[order], best[order].astype(np.int64)
        sums, texts = np.zeros((len(_COUNTS), rows.num_rows), np.int64), []
        a, b = (c.chunk(0) if c.num_chunks else pa.array([], pa.binary()) for c in (rows["a"], rows["b"]))
        for i, j, aligned in _alignments(a, b, t):
            doc, pair, n = aligned.pairs(t.width, span)
            at = np.searchsorted(pairs, pair)
            ends = np.searchsorted(doc, np.arange(j - i + 1))
            each = [np.concatenate([[0], np.cumsum(x)]) for x in (n, n * best[at], n * docs[at])]
            sums[:, i:j] = [aligned.n_a, aligned.n_b, aligned.n_groups(), *(np.diff(x[ends]) for x in each)]
            texts += aligned.texts(t.names, len(t.a_bytes), len(t.b_bytes))
        out = [rows[f.name] for f in kept] + [pa.array(x) for x in sums] + [pa.array(texts, pa.string())]
        return pa.Table.from_arrays(out, names=schema.names)

    known = answers(parts, index, width)
    return tokens.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(finish, schema)
