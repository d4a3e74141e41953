"""Token counts with a public sentencepiece model, exact for texts of any length.

Short texts are encoded whole. A huge text is encoded in overlapping chunks with offsets.
Neighbouring chunks are spliced where both encodings begin a token and the boundary is
proven: the two characters beside it occur together in no piece of the vocabulary, so no
merge can ever cross it, and what stands left of it has no influence on what stands right.
If an overlap holds no such place, it is widened, up to the end of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import shields

CHUNK_BYTES = 16_000
OVERLAP_BYTES = 400
_loaded: dict[str, Encoder] = {}


class Encoder:
    """A model with the pairs of characters that occur inside its pieces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        #: Chunks can stand for the text only if characters are taken as they are.
        self.plain = not spec.normalizer_spec.precompiled_charsmap and not spec.normalizer_spec.remove_extra_whitespaces and spec.trainer_spec.model_type == 2
        pieces = [p.piece for p in spec.pieces if p.type in (1, 4)]
        self.pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        #: A character of no piece keeps the model's added first space apart from a chunk.
        self.guard = next(c for c in map(chr, range(1, 0x110000)) if not any(c in x for x in self.pairs) and c not in pieces)

    def proven(self, data: bytes, at: int) -> bool:
        left = _character(data, at - 1, -1)
        right = _character(data, at + 1, 1)
        return data[left:right].decode().replace(" ", "▁") not in self.pairs

    def count(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of the text; chunk and overlap in bytes."""
        data = text.encode()
        if len(data) <= chunk + overlap or not self.plain:
            return len(self.model.encode(text))
        total, first, at = 0, 0, 0  # tokens before `first` are counted; `at`: where the chunk was cut
        begins = self._begins(data, 0, chunk + overlap)
        while True:
            cut, wide = _character(data, at + chunk, 1), overlap
            while True:
                if cut >= len(data):
                    return total + sum(b >= first for b in begins)
                after, known = self._begins(data, cut, cut + chunk + wide), set(begins)
                splice = next((b for b in after if cut < b < cut + wide and b in known and self.proven(data, b)), None)
                if splice is not None:
                    break
                if cut + wide >= len(data):  # no boundary up to the end: the chunk takes the rest
                    return total + sum(b >= first for b in begins)
                wide *= 2  # no common boundary: look further
                begins = self._begins(data, at, cut + wide)
            total += sum(first <= b < splice for b in begins)
            first, at, begins = splice, cut, after

    def _begins(self, data: bytes, start: int, stop: int) -> list[int]:
        """Where the tokens of data[start:stop] begin; tokens for the bytes of one character repeat its place."""
        lead = self.guard.encode() if start else b""
        some = data[start : _character(data, stop, 1)]
        pieces = self.model.encode((lead + some).decode(), return_type="proto").pieces
        return [p.begin + start - len(lead) for p in pieces if p.begin >= len(lead)]


def _character(data: bytes, at: int, step: int) -> int:
    """The next place from `at` on where a character begins."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += step
    return at


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


@shields("n_bytes", "n_tokens")
def count_tokens(documents: DataFrame, model_path: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES, overlap_bytes: int = OVERLAP_BYTES) -> DataFrame:
    """All columns of `documents`, then n_bytes (UTF-8) and n_tokens.

    NULL counts as the empty text: 0 and 0. Repeated rows each keep their count; an empty table
    gives no rows. Columns named n_bytes or n_tokens are replaced. Rows keep their partition:
    there is no shuffle. `model_path` must exist on every executor.
    """
    kept = documents.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(model_path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            counts: list[int] = []
            for i in range(0, len(texts), 64):
                some = [x or "" for x in texts.slice(i, 64).to_pylist()]
                short = [j for j, x in enumerate(some) if len(x) <= chunk_bytes + overlap_bytes]
                found = dict(zip(short, map(len, code.model.encode([some[j] for j in short], num_threads=1)), strict=True))
                counts += [found[j] if j in found else code.count(x, chunk_bytes, overlap_bytes) for j, x in enumerate(some)]
            keep = [k for k in range(batch.num_columns) if k != batch.schema.get_field_index(text)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(counts, pa.int64())], names=[batch.schema.names[k] for k in keep] + ["n_tokens"])

    return _add_column(kept, text, count)


def _add_column(df: DataFrame, text: str, count) -> DataFrame:
    """The text itself doesn't come back from Python."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([f for f in df.schema.fields if f.name != text] + [StructField("n_tokens", LongType())])
    return df.mapInArrow(count, schema)
