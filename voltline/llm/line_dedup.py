"""Removal of runs of lines that occurred earlier, found by winnowing over line hashes.

Of every window of `window` line hashes the smallest (the last of equals) is a fingerprint. A
run of `window` lines or more that occurs twice has the same windows in both places and so the
same fingerprints: every repeat is found through a fingerprint that occurs more than once. From
such places the search goes both ways over all windows that chose the fingerprint; a window
that began earlier somewhere is repeated, and neighbouring repeated windows make up the run.
Where runs are measured in words too, shorter windows with words enough are their own fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .store import shields, stored
from .words import as_long, mix

WINDOW = 3
#: Words of a passage that is a repeat whatever its lines, where runs are measured in words too.
PASSAGE_WORDS = 50
_BASE = np.uint64(0x9E3779B97F4A7C15)


def line_hashes(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """All lines of a text, which of them hold a word, and those lines' hashes (A-Z as a-z, white space squeezed)."""
    lines = (text or "").split("\n")
    words = [x.encode().lower().split() for x in lines]
    at = np.array([i for i, w in enumerate(words) if w], np.int64)
    return lines, at, np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i])) for i in at], np.uint64)


def windows(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: its hash, its fingerprint, and whether the window before chose another place."""
    n = len(hashes) - size + 1
    if n < 1:
        none = np.zeros(0, np.uint64)
        return none, none, np.zeros(0, bool)
    views = np.lib.stride_tricks.sliding_window_view(hashes, size)
    whole = np.zeros(n, np.uint64)
    for i in range(size):
        whole = mix(whole * _BASE + views[:, i])
    place = np.arange(n) + size - 1 - views[:, ::-1].argmin(axis=1)
    return whole, hashes[place], np.concatenate([[True], place[1:] != place[:-1]])


def long_windows(hashes: np.ndarray, counts: np.ndarray, size: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the windows of `size` lines with so many words or more."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(counts)])
    starts = np.flatnonzero(total[size:] - total[:-size] >= least_words)
    whole = np.full(len(starts), size, np.uint64)
    for i in range(size):
        whole = mix(whole * _BASE + hashes[starts + i])
    return whole, starts


def window_rows(documents: DataFrame, key: str, text: str, size: int, least_words: int | None = None) -> DataFrame:
    """whole, print, fresh, key, start: a row for every window of every text; start is the first line times `size`, plus the lines after it in the window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, owner, starts = [], [], []
            for k, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines, at, hashes = line_hashes(body.as_py())
                found = windows(hashes, size)
                if len(found[0]):
                    parts.append(found)
                    owner.append(np.full(len(found[0]), k))
                    starts.append(np.arange(len(found[0]), dtype=np.int32) * size + size - 1)
                counts = np.array([len(lines[i].encode().split()) for i in at] if least_words else [], np.int64)
                for fewer in range(1, size if least_words else 1):
                    whole, first = long_windows(hashes, counts, fewer, least_words)
                    if len(whole):
                        parts.append((whole, whole, np.ones(len(whole), bool)))
                        owner.append(np.full(len(whole), k))
                        starts.append((first * size + fewer - 1).astype(np.int32))
            if parts:
                whole, print_, fresh = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([as_long(whole), as_long(print_), pa.array(fresh), pa.array(np.concatenate(owner)), pa.array(np.concatenate(starts))], names=["whole", "print", "fresh", "key", "start"])

    rows = documents.filter(F.col(key).isNotNull()).select(F.col(key).cast("long"), text)
    return rows.mapInArrow(work, "whole long, print long, fresh boolean, key long, start int")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """key, starts: the windows of each document that began earlier, in a smaller key or further up."""
    prints = rows.filter("fresh").groupBy("print").agg(F.count("*").alias("places")).filter("places > 1").select("print")
    anchored = rows.join(prints, "print", "left_semi")
    first = anchored.groupBy("whole").agg(F.min(F.struct("key", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("whole", "first")
    later = anchored.join(first, "whole").filter(F.struct("key", "start") > F.col("first"))
    return later.groupBy("key").agg(F.collect_set("start").alias("starts"))


@shields("n_lines", "n_removed_lines")
def dedup_lines(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW, least_words: int | None = None) -> DataFrame:
    """All columns of `documents`, its text without repeated runs, then n_lines and n_removed_lines (long).

    A line with a word goes if a run of `size` such lines that holds it also begins earlier: in a
    document with a smaller key, or further up in its own. With `least_words` so does a run of fewer
    lines that has so many words. Comparison is on the input, not on
    what is left. Lines without a word are not counted, break no run and stay. NULL and empty
    texts stay as they are; a document of which nothing is left stays with what blank lines it
    had. Rows with equal keys are taken for one document and share its marks. Rows with a NULL
    key stay whole. An empty table gives no rows; columns with the names of added ones are
    replaced.
    """
    plain = documents
    starts = stored(repeated_windows(stored(window_rows(plain, key, text, size, least_words))))
    # marks grow with the corpus: joined by sort and merge at every size
    marks = starts.select(F.col("key").alias("_k"), F.col("starts").alias("_starts")).hint("merge")
    joined = plain.join(marks, F.col(key) == F.col("_k"), "left").drop("_k")
    names = plain.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = names.index(text)
            texts, counts, removed = [], [], []
            for body, found in zip(batch.column(place), batch.column(len(names)), strict=True):
                body, found = body.as_py(), found.as_py()
                if not found:
                    texts.append(body)
                    counts.append(sum(bool(x.encode().split()) for x in (body or "").split("\n")))
                    removed.append(0)
                    continue
                lines, at, _ = line_hashes(body)
                gone = np.zeros(len(at) + 1, np.int64)
                first, more = np.divmod(np.array(found, np.int64), size)
                fits = first + more < len(at)  # others are of another row with this key
                np.add.at(gone, first[fits], 1)
                np.add.at(gone, first[fits] + more[fits] + 1, -1)
                out = set(at[np.cumsum(gone)[:-1] > 0].tolist())
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in out))
                counts.append(len(at))
                removed.append(len(out))
            columns = [batch.column(k) if k != place else pa.array(texts, pa.string()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed_lines"])

    return joined.mapInArrow(work, StructType([*plain.schema.fields, StructField("n_lines", LongType()), StructField("n_removed_lines", LongType())]))
