"""Removal of byte strings that start in an earlier document too, by a difference-cover sample of suffixes.

Positions whose remainder modulo 13 is in {0, 1, 3, 9} are the sample. Any two positions can be
moved on by the same 0 to 12 bytes so that both are sampled, so two equal strings of `length`
bytes hold, at the same offset, sampled suffixes whose first `length` - 12 bytes are equal.
Sampled prefixes are named by triples of their thirds, and the triple of names gives the prefix
its name; where a name stands in two documents, the suffixes that the sample left out are merged
in: each string of `length` bytes around it gets a key of the bytes before the sampled suffix, its
name and the bytes behind. Of suffixes that lie together by key the one in the first document
stands, the others are repeats.

Only equality up to `length` bytes matters here, so names are 64-bit hashes and not ranks: the
recursion ends after two levels, and grouping by name takes the place of a total order.

Names meet in buckets, as packed arrays of one slice of texts and one bucket each: a name, and the
distances to the key and the place before it, byte by byte, so that what is mostly zero shrinks in the
shuffle. Of a name that several documents of a slice have, one goes along. Names are dealt to
PASSES, and the shuffle files of one are gone before the next. For the sample 32 bits beside bucket and pass will do:
a chance match there only makes more strings of `length` bytes to compare.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .store import shields, stored
from .words import mix, powers, slices, text_bytes

LENGTH = 50
COVER, MODULUS = (0, 1, 3, 9), 13
#: Bytes hashed at once, and bytes of text in a slice; a longer text is a slice by itself.
_PIECE, SLICE_BYTES = 1 << 20, 8 << 20
#: The names are met in so many parts, one after the other.
PASSES = 2
#: Names in a bucket, and the fewest buckets.
BUCKET_NAMES, LEAST_BUCKETS = 1 << 21, 48
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
PACKED = "bucket int, slice long, names binary, keys binary, at binary"


def names(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Names of the strings of `length` bytes at `places` (in order): thirds are named, then the triple of their names."""
    cuts = [0, length // 3, 2 * length // 3, length]
    out = np.zeros(len(places), np.uint64)
    first = 0
    while first < len(places):
        low = int(places[first])
        last = int(np.searchsorted(places, low + _PIECE))
        piece, at = data[low : int(places[last - 1]) + length], places[first:last] - low
        power, inverse = powers(len(piece) + 1)
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * power[:-1], out=total[1:])
        name = np.zeros(len(at), np.uint64)
        for start, end in zip(cuts, cuts[1:], strict=False):
            name = mix(name * _BASE + mix((total[at + end] - total[at + start]) * inverse[at + start]))
        out[first:last] = name
        first = last
    return out


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = text_bytes(column)
    for k in range(len(column)):
        yield data[offsets[k] : offsets[k + 1]]


def packed(x: np.ndarray) -> bytes:
    """Differences, all first bytes, then all second bytes, and so on."""
    return np.diff(x, prepend=x.dtype.type(0)).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, len(data) // size)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def _group(names: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by name, and for each in that order the least and the greatest rank that its name has."""
    order = np.argsort(names)
    names, rank = names[order], rank[order]
    first = np.concatenate([[True], names[1:] != names[:-1]])
    starts, of = np.flatnonzero(first), np.cumsum(first) - 1
    return order, np.minimum.reduceat(rank, starts)[of], np.maximum.reduceat(rank, starts)[of]


def slice_rows(number: int, held: list, buckets: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Names, keys and places of a slice, in rows of a bucket each.

    first: of a name all but the strings of the first document are marked, and names are given whole;
    else all are marked if two documents have it, and 32 bits of a name are given. What the
    slice alone shows to be marked goes in rows without names.
    """
    name, key, at = (np.concatenate(x) for x in zip(*held, strict=True))
    if not len(name):
        return
    order, low, high = _group(name, key)
    key_in_order = key[order]
    marked = np.zeros(len(name), bool)
    marked[order] = key_in_order > low if first else low < high
    send = np.zeros(len(name), bool)
    if first:
        send = ~marked
    else:
        sorted_names = name[order]
        send[order] = (low == high) | np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    rows = [(number % buckets, b"", key[marked], at[marked])] if marked.any() else []
    name, key, at = name[send], key[send], at[send]
    bucket = ((name >> np.uint64(32)) // np.uint64(PASSES) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, name, key, at = bucket[order], name[order], key[order], at[order]
    given = name if first else name.astype(np.uint32)
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
    rows += [(int(bucket[i]), given[i:j].tobytes(), key[i:j], at[i:j]) for i, j in zip(cuts, cuts[1:], strict=False) if i < j]
    columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), *(pa.array(x, pa.binary()) for x in ([r[1] for r in rows], [packed(r[2]) for r in rows], [packed(r[3]) for r in rows]))]
    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "slice", "names", "keys", "at"])


def named(texts: DataFrame, length: int, turn: int, buckets: int, first: bool) -> DataFrame:
    """The names of one turn, by slice_rows(); texts: key, text and for strings of the whole length also spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy()
            everything, offsets = text_bytes(batch.column(1))
            for i, j in slices(offsets, _PIECE):
                data, begin = everything[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                sizes = np.diff(begin)
                doc = np.repeat(np.arange(j - i, dtype=np.int32), sizes)
                at = np.arange(len(data)) - begin[doc]
                room = at + length <= sizes[doc]
                if batch.num_columns > 2:
                    change = np.zeros(len(data) + 1, np.int32)
                    for row in range(i, j):
                        spans = batch.column(2)[row].values
                        for side, step in (("begin", 1), ("end", -1)):  # spans may be of another row with this key
                            np.add.at(change, begin[row - i] + np.minimum(spans.field(side).to_numpy(), sizes[row - i]), step)
                    room &= np.cumsum(change)[:-1] > 0
                else:
                    room &= _SAMPLED[at % MODULUS]
                places = np.flatnonzero(room)
                name = names(data, places, length)
                mine = (name >> np.uint64(32)) % np.uint64(PASSES) == turn
                places, name = places[mine], name[mine]
                held.append((name, keys[i:j][doc[places]], at[places].astype(np.int32)))
                size += len(data)
                if size >= SLICE_BYTES:
                    yield from slice_rows(number, held, buckets, first)
                    number, held, size = number + 1, [], 0
        if held:
            yield from slice_rows(number, held, buckets, first)

    return texts.mapInArrow(work, PACKED)


_SAMPLED = np.isin(np.arange(MODULUS), COVER)


def met(rows: DataFrame, first: bool, before: int, after: int) -> DataFrame:
    """key, begin, end: the bytes from `before` bytes before a marked string's place up to `after` behind it, joined where they touch."""

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        slice_of, name, keys, at = table["slice"].to_numpy(), *(table[n].to_pylist() for n in ("names", "keys", "at"))
        sent = [i for i, x in enumerate(name) if x]
        out = [i for i, x in enumerate(name) if not x]
        done = [(slice_of[i], keys[i], at[i]) for i in out]
        if sent:
            key = [unpacked(keys[i], np.int64) for i in sent]
            counts = [len(k) for k in key]
            of = np.repeat(np.arange(len(sent)), counts)
            key = np.concatenate(key)
            order, low, high = _group(np.frombuffer(b"".join(name[i] for i in sent), np.uint64 if first else np.uint32), key if first else slice_of[sent][of])
            marked = np.zeros(len(key), bool)
            marked[order] = key[order] > low if first else low < high
            ends = np.cumsum(counts)
            for n, i in enumerate(sent):
                some = slice(ends[n] - counts[n], ends[n])
                if marked[some].any():
                    done.append((slice_of[i], packed(key[some][marked[some]]), packed(unpacked(at[i], np.int32)[marked[some]])))
        return pa.table({"slice": pa.array([d[0] for d in done], pa.int64()), "keys": pa.array([d[1] for d in done], pa.binary()), "at": pa.array([d[2] for d in done], pa.binary())})

    def join(table: pa.Table) -> pa.Table:
        key = np.concatenate([unpacked(x, np.int64) for x in table["keys"].to_pylist()])
        at = np.concatenate([unpacked(x, np.int32) for x in table["at"].to_pylist()])
        order = np.lexsort((at, key))
        key, begin = key[order], np.maximum(at[order] - before, 0)
        end = at[order] + after
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (begin[1:] > end[:-1])])
        starts = np.flatnonzero(new)
        last = np.concatenate([starts[1:], [len(key)]]) - 1
        return pa.table({"key": key[starts], "begin": begin[starts], "end": end[last]})

    marked = rows.groupBy("bucket").applyInArrow(meet, "slice long, keys binary, at binary")
    return marked.groupBy("slice").applyInArrow(join, "key long, begin int, end int")


def shared_spans(texts: DataFrame, length: int, size: int, first: bool, before: int, after: int) -> DataFrame:
    """The spans of met(), by key, with texts of about `size` strings in all; key, spans."""
    buckets = max(LEAST_BUCKETS, size // (PASSES * BUCKET_NAMES))
    found = [stored(met(named(texts, length, turn, buckets, first), first, before, after), tidy=True) for turn in range(PASSES)]
    return functools.reduce(DataFrame.union, found)


def by_key(spans: DataFrame) -> DataFrame:
    return spans.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


@shields("n_bytes", "n_removed", "n_spans", "kept")
def dedup_substrings(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of `documents` but the text, then n_bytes, n_removed, n_spans (long) and kept (binary: the bytes that stay).

    A byte goes if a string of `length` bytes that covers it also starts in a document with a
    smaller key; strings never cross documents and are judged on the input. Documents that are
    equal as a whole are searched once: of those the later ones go whole (if long enough). NULL
    and empty texts have 0 bytes and nothing to remove. Rows with equal keys are taken for one
    document and share its marks; rows with a NULL key stay whole. An empty table gives no rows; columns with the
    names of added ones are replaced.
    """
    plain = documents
    known = plain.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).filter(F.octet_length("text") >= length)
    whole = stored(known.select("key", F.sha2("text", 256).alias("sum"), F.octet_length("text").cast("long").alias("size")))
    copies = stored(whole.join(whole.groupBy("sum").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "sum").filter("key > first").select("key").distinct(), tidy=True)
    once = known.join(copies, "key", "left_anti")
    size = whole.agg(F.sum("size")).first()[0] or 0
    near = shared_spans(once, length - MODULUS + 1, size * len(COVER) // MODULUS, False, MODULUS - 1, 1)
    size = near.agg(F.sum(F.col("end") - F.col("begin"))).first()[0] or 0
    held = stored(once.join(by_key(near), "key").select("key", "text", "spans"), tidy=True)
    starts = by_key(shared_spans(held, length, size, True, 0, length)).withColumnRenamed("spans", "_spans")
    marks = starts.select("key", "_spans", F.lit(False).alias("_whole")).union(copies.select("key", F.array().cast("array<struct<begin:int,end:int>>"), F.lit(True)))
    joined = plain.join(marks.withColumnRenamed("key", "_k"), F.col(key) == F.col("_k"), "left").drop("_k")
    fields = [f for f in plain.schema.fields if f.name != text]
    added = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [StructField("kept", BinaryType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            keep = [k for k in range(batch.num_columns - 2) if k != place]
            rows = []
            for row, data in enumerate(_texts(batch.column(place))):
                marks, gone = batch.column(batch.num_columns - 2)[row], np.zeros(len(data), bool)
                if batch.column(batch.num_columns - 1)[row].as_py():
                    gone[:] = True
                elif marks.is_valid and len(marks):
                    change = np.zeros(len(data) + 1, np.int32)
                    for side, step in (("begin", 1), ("end", -1)):
                        np.add.at(change, np.minimum(marks.values.field(side).to_numpy(), len(data)), step)
                    gone = np.cumsum(change)[:-1] > 0
                spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1))
                rows.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            out = [batch.column(k) for k in keep] + [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)] + [pa.array([r[3] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=[batch.schema.names[k] for k in keep] + ["n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(cut, StructType(fields + added))
