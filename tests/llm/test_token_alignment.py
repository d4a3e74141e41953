"""Token alignment of two vocabularies against brute force over all token pairs."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from voltline.llm import token_alignment
from voltline.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
T = token_alignment.tokenizers_of(A, B)
SCHEMA = "doc_id long, text string, slice string, a int, n_links string, _extra_0 string"
TEXTS = ["", "a", "Hello world", "É漢字かな 12ab34", "<|endoftext|> <s> it's", "x▁y", "🙂🏽 é́ \x00\x1f", "a" * 900, "漢字" * 700, " \n\t ", "\xa0　x", "ab " * 400, "zażółć gęślą jaźń " * 30, "A ligature ﬁ ﬀ"]


@pytest.fixture(scope="module")
def own():
    a, b = tokenizers.Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def brute(texts, own):
    """What the contract says, with loops."""
    a_code, b_code = own
    rows, linked = [], collections.Counter()
    for text in texts:
        text = text or ""
        data = b" " + text.encode()
        a = a_code.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_code.encode(text) if text else []
        if not text or b"".join(T.a_bytes[i] for i in a) != data or b"".join(T.b_bytes[i] for i in b) != data:
            rows.append(([], []))
            continue
        ends = []
        for ids, table in ((a, T.a_bytes), (b, T.b_bytes)):
            e = np.cumsum([len(table[i]) for i in ids]).tolist()
            ends.append(e)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for c in cuts:
            groups.append(tuple([i for i, e in zip(ids, es, strict=True) if low < e <= c] for ids, es in zip((a, b), ends, strict=True)))
            low = c
        rows.append((groups, [(x, y) for g in groups for x in g[0] for y in g[1]]))
        linked.update(set(rows[-1][1]))
    most = collections.Counter()
    for (x, _), n in linked.items():
        most[x] = max(most[x], n)
    out = []
    for groups, links in rows:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n = (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links))
        out.append((*n, sum(linked[p] == most[p[0]] for p in links), sum(linked[p] for p in links), shown))
    return out


def test_vocabulary_bytes():
    assert T.a_bytes[T.a.token_to_id("Ġ")] == b" " and T.a_bytes[T.a.token_to_id("Ċ")] == b"\n"
    assert sorted(b for b in T.a_bytes if len(b) == 1) == [bytes([i]) for i in range(256)]
    assert T.b_bytes[T.b.piece_to_id("▁")] == b" " and T.b_bytes[T.b.piece_to_id("<0x0A>")] == b"\n"


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.sampled_from("abté1 漢\n🙂▁'s."), max_size=60), st.integers(1, 9))
def test_long_texts_in_parts(text, size):
    assert T.encode_b([text], size) == [T.b.encode(text)]


@pytest.mark.parametrize("text", ["word " * 20_000, "漢字" * 40_000, "é" * 70_000, "a1 \n" * 20_000, "x" * 70_000])
def test_very_long_texts(text, own):
    assert T.encode_b([text])[0] == own[1].encode(text)
    assert T.encode_a([" " + text])[0] == own[0].encode(" " + text, add_special_tokens=False).ids


def test_units_are_encoded_once(monkeypatch):
    fresh = token_alignment.Tokenizers(A, B)
    read = []
    whole = fresh._whole
    monkeypatch.setattr(fresh, "_whole", lambda some: read.extend(some) or whole(some))
    words = [f"{a}{b}" for a in ("over", "fjord", "Äpfel") for b in range(30)]
    rng = random.Random(3)
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(40)]
    assert fresh.encode(texts) == whole(texts)
    assert sum(map(len, read)) < 2 * sum(len(w) + 1 for w in words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["  ", " ", " ", "\n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "\u200b", "▁", "a", "ing", "'s", "!", "12", "é", "漢字", "<s>", "<|endoftext|>", "\x00"]), max_size=20).map("".join))
def test_units_give_the_tokens_of_the_whole(text):
    assert T.encode([text, text + "b " + text]) == T._whole([text, text + "b " + text])


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**62), max_size=300), st.sets(st.integers(0, 2**62), max_size=20))
def test_numbering(keys, others):
    keys = np.array(sorted(keys), np.int64)
    for number in (token_alignment.Numbering.of(keys), token_alignment.Numbering.unpacked(*token_alignment.Numbering.of(keys).packed())):
        assert sorted(number(keys).tolist()) == list(range(len(keys))) and number.size == len(keys)
        assert (number(np.array(sorted(others), np.int64)) < len(keys)).all()


def test_large_groups_and_small_blocks(monkeypatch):
    """Synthetic tokens whose ends meet once in 600 bytes, with every way to cut the work."""
    rng = random.Random(5)
    sizes = np.array([1, 2, 3, 7])
    docs = []
    for total in (0, 1, 2, 600, 1201):
        side = []
        for _ in range(2):
            ids, left = [], total
            while left:
                i = rng.choice([k for k in range(4) if sizes[k] <= left])
                ids.append(i)
                left -= int(sizes[i])
            side.append(ids)
        docs.append(side)
    docs.append(([3] * 60, [0] + [1] * 209 + [0]))
    flat = [np.array([i for d in docs for i in d[s]], np.int64) for s in range(2)]
    aligned = token_alignment.Alignment(*flat, *(np.array([len(d[s]) for d in docs]) for s in range(2)), (sizes, sizes))
    want = collections.Counter()
    for n, (a, b) in enumerate(docs):
        ends = [np.cumsum(sizes[x]) if x else np.zeros(0, int) for x in (a, b)]
        cuts = np.intersect1d(*ends)
        of = [np.searchsorted(cuts, e) for e in ends]
        want.update((n, x * 4 + y) for x, g in zip(a, of[0], strict=True) for y, h in zip(b, of[1], strict=True) if g == h)
    for large, block in ((1 << 12, 1 << 19), (1, 5), (10**9, 100)):
        monkeypatch.setattr(token_alignment, "LARGE_GROUP", large)
        monkeypatch.setattr(token_alignment, "BLOCK_LINKS", block)
        got = aligned.pairs(4, 16)
        assert dict(zip(zip(got[0].tolist(), got[1].tolist(), strict=True), got[2].tolist(), strict=True)) == dict(want)


@pytest.mark.parametrize("slice_bytes", [1, 8 << 20])
def test_tables(spark, own, slice_bytes, monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", slice_bytes)
    texts = [*TEXTS, None, TEXTS[2], TEXTS[3]]
    rows = [(i, t, "own", 7, "gone", "kept") for i, t in enumerate(texts)] + [(2, TEXTS[2], "own", 7, "gone", "kept"), (None, "x y", None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = token_alignment.align_tokenizers(docs, A, B)
    assert out.columns == ["doc_id", "slice", "a", "_extra_0", *token_alignment._COUNTS, "groups"]
    got = sorted((str(r.doc_id), r.slice, r.a, *r[4:]) for r in out.collect())
    want = sorted((str(r[0]), r[2], r[3], *x) for r, x in zip(rows, brute([r[1] for r in rows], own), strict=True))
    assert [repr(x) for x in got] == [repr(x) for x in want]
    assert "Exchange hashpartitioning(slice" in out._jdf.queryExecution().executedPlan().toString()
    assert token_alignment.align_tokenizers(docs.limit(0), A, B).collect() == []


def test_tokens_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    plan = token_alignment.align_tokenizers(docs, A, B)._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroupsInArrow") : plan.index("voltline_")]
    assert "Bucketed: true" in plan and "Exchange" not in left


def test_query(spark, own):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = sorted((r.doc_id, *x[:6], hashlib.sha256(x[6].encode()).hexdigest() if x[6] else "") for r, x in zip(docs, brute([r.text for r in docs], own), strict=True))
    assert sorted(map(tuple, QUERIES["op13_token_alignment"](spark, folder).collect())) == want
