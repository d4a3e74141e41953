"""Byte-level BPE against the library on whole texts, and exact round trips."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from voltline.llm import byte_bpe
from voltline.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, ids string, bytes int, _extra_0 string"
CODE = byte_bpe.coder(RANKS, public_tokenizers.PATTERN)
ODD = ["", "a", "<|endoftext|> it's  we'll\n\n\tx", "É漢字かな 12ab34 'sS 's", "don'tdon't'''s' 't't", "　 x  y", "🙂🏽 é́ \x00\x1f", "_a1-b2" * 9, " " * 90 + "x" + " " * 80]


def whole(text):
    return CODE.encoding.encode_ordinary(text)


@pytest.mark.parametrize("text", ODD + ["word " * 30_000, "漢字" * 30_000, " \n" * 30_000 + "a", "a1" * 40_000, "'s" * 40_000])
def test_parts_give_the_tokens_of_the_whole(text):
    for size in (1, 7, byte_bpe.PART_CHARS):
        if size > 7 or len(text) < 1_000:
            assert "".join(byte_bpe.parts(text, size)) == text
            assert [i for part in byte_bpe.parts(text, size) for i in whole(part)] == whole(text)
    ids = [int(i) for part in CODE.encode(text) for i in part]
    assert ids == whole(text)
    assert bytes(CODE.decode(__import__("numpy").array(ids, int))) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'stlrveémd 1२ⅷ\t\n 　.-_漢🙂́ͅ"), max_size=40))
def test_boundaries_are_safe(text):
    assert [i for part in byte_bpe.parts(text, 1) for i in whole(part)] == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_boundaries_are_safe_for_any_text(text):
    assert [i for part in byte_bpe.parts(text, 1) for i in whole(part)] == whole(text)


def test_tables(spark):
    rows = [(i, t, "own", 5, "kept") for i, t in enumerate([*ODD, None, "tail " * 20_000, ODD[2]])] + [(None, "x y", None, None, None), (0, ODD[0], "own", 5, "kept")]
    docs = spark.createDataFrame(rows, SCHEMA)
    tokens = byte_bpe.encode(docs, RANKS)
    assert tokens.columns == ["doc_id", "bytes", "_extra_0", "ids"]
    back = byte_bpe.decode(tokens.withColumn("again", tokens.ids), RANKS)
    assert back.columns == ["doc_id", "_extra_0", "again", "bytes"]
    got = sorted((r.doc_id is None, r.doc_id or 0, r._extra_0, r.again, bytes(r.bytes)) for r in back.collect() if r._extra_0)
    assert got == sorted((False, i, "kept", whole(t or ""), (t or "").encode()) for i, t, *_ in rows if i is not None)
    assert [bytes(r.bytes) for r in back.filter("doc_id IS NULL").collect()] == [b"x y"]
    assert byte_bpe.encode(docs.limit(0), RANKS).collect() == [] == byte_bpe.decode(tokens.limit(0), RANKS).collect()
    holes = spark.createDataFrame([([1, None, 2],), (None,), ([],)], "ids array<int>")
    assert [bytes(r.bytes) for r in byte_bpe.decode(holes, RANKS).collect()] == [CODE.encoding.decode_bytes([1, 2]), b"", b""]
    with pytest.raises(Exception, match="no token has the id 50256"):
        byte_bpe.decode(spark.createDataFrame([([50256],)], "ids array<int>"), RANKS).collect()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = whole(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op11_byte_bpe"](spark, folder).collect())) == sorted(want)
