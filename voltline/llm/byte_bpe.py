"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A text is split by a pattern and each match is merged by itself, so a long text can be cut
before it is encoded wherever a match is sure to end. Such safe boundaries follow from the
pattern's character classes alone, without reading further: a match that holds a letter goes
on only with letters, one that holds a number only with numbers, and no match goes on into
white space unless it is white space. Parts between safe boundaries give the tokens of the
whole text, and only one part at a time is in the regular expression.

Decoding joins the bytes of tokens. Tokens may hold parts of characters, so the result is
binary and nothing is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .store import shields

#: Texts of more characters are cut.
PART_CHARS = 32_768
#: Texts are encoded in groups of about so many characters; memory doesn't follow the batch size.
GROUP_CHARS = 1 << 20
#: Places before which every match of the pattern ends: white space after anything else, and
#: the end of a run of letters or of numbers. (An apostrophe may go on into letters, so the
#: beginning of a run of letters isn't one.)
_BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}])|(?<=\p{N})(?=[^\p{N}])")
_loaded: dict[tuple[str, str], Coder] = {}


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """`text` cut at the first safe boundary after every `size` characters, or whole if there is none."""
    start = 0
    while len(text) - start > size:
        found = _BOUNDARY.search(text, start + size)
        if not found or found.start() == len(text):
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Coder:
    """The ranks of a file: base64 of a token's bytes and its id, by line. No special tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.known = np.zeros(len(tokens) + 1, bool)
        self.known[list(ranks.values())] = True
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, text: str) -> list[np.ndarray]:
        """The ids of a text, by part."""
        return [self.encoding.encode_to_numpy(part, disallowed_special=()) for part in parts(text)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens in a row; an id that the file lacks is an error."""
        low = np.clip(ids, -1, len(self.known) - 1)
        if not self.known[low].all():
            raise ValueError(f"no token has the id {ids[~self.known[low]][0]}")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[ids] - ends + sizes, sizes)]


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Coder(path, pattern)
    return _loaded[path, pattern]


def groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` in all, one row at least."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
        yield first, last
        first = last


def _with_column(documents: DataFrame, source: str, field: StructField, work) -> DataFrame:
    """All columns but `source`, which stays in Python, and a new one; `work` turns a slice of the source's values into an Arrow array."""
    at = documents.columns.index(source)
    kept = [f for i, f in enumerate(documents.schema.fields) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            others = pa.RecordBatch.from_arrays([c for i, c in enumerate(batch.columns) if i != at], names=[f.name for f in kept]) if kept else None
            for i, j in groups(sizes_of(column), GROUP_CHARS):
                some = others.slice(i, j - i).columns if kept else []
                yield pa.RecordBatch.from_arrays([*some, work(column.slice(i, j - i))], names=[f.name for f in kept] + [field.name])

    return documents.mapInArrow(run, StructType([*kept, field]))


def sizes_of(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    size = pc.list_value_length(column) if pa.types.is_list(column.type) or pa.types.is_large_list(column.type) else pc.binary_length(column)
    return size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


@shields("ids")
def encode(documents: DataFrame, ranks: str, text: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """All columns of `documents` but the text, then ids (array of int): its tokens by the rank file `ranks`.

    Strings of special tokens are plain text. NULL and the empty text have no ids (an empty
    array). Repeated rows each keep theirs; an empty table gives no rows; a column named ids is
    replaced. Rows keep their partition: there is no shuffle. `ranks` must exist on every executor.
    """

    def work(texts: pa.Array) -> pa.Array:
        code, found, ends = coder(ranks, pattern), [], [0]
        for value in texts.to_pylist():
            some = code.encode(value) if value else []
            found += some
            ends.append(ends[-1] + sum(map(len, some)))
        ids = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))

    return _with_column(documents, text, StructField("ids", ArrayType(IntegerType(), False), False), work)


@shields("bytes")
def decode(tokens: DataFrame, ranks: str, text: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """All columns of `tokens` but the ids (column `text`, an array of int), then bytes (binary): what the tokens stand for.

    A NULL array gives no bytes (empty), a NULL id in an array none for itself. An id that no token
    has is an error. Repeated rows each keep theirs; an empty table gives no rows; a column named
    bytes is replaced. There is no shuffle. `ranks` must exist on every executor.
    """

    def work(lists: pa.Array) -> pa.Array:
        code = coder(ranks, pattern)
        out = []
        for ids in lists:
            values = ids.values.drop_null() if ids.is_valid else None
            out.append(code.decode(values.to_numpy(zero_copy_only=False).astype(np.int64)).tobytes() if values is not None else b"")
        return pa.array(out, pa.binary())

    return _with_column(tokens, text, StructField("bytes", BinaryType(), False), work)


def digest(ids: Column) -> Column:
    """Hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)
