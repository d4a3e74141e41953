"""Runs of words by recompression against brute force over all stretches."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltline.llm import periodic_runs
from voltline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, collapsed int, start long, _extra_1 string"


def brute(words, least=12):
    """Every period by comparing each word with the one a period later; the smallest period of a stretch stands."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q) and (i, j + q) not in found:
                found[i, j + q] = q
            i = j + 1
    runs = sorted((s, e - s, q) for (s, e), q in found.items())
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return runs, " ".join(w for k, w in enumerate(words) if k not in gone)


def texts(seed=3):
    rng = random.Random(seed)
    some = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 1, 11, 12, 13, 40, 300)]
    some += [" ".join(f"w{rng.randrange(k)}" for _ in range(400)) for k in (1, 2, 3, 5, 50)]
    for p in (1, 2, 5, 7, 30):
        core = [f"c{rng.randrange(9)}" for _ in range(p)]
        some.append(" ".join([*"xyz", *(core * 20)[: 12 + 3 * p + rng.randrange(p)], *"uvw"]))
    some += ["a\n b\t" * 30, "É é " * 20, "same " * 3000, ("one two three " * 5 + "four ") * 9]
    fib = ["a", "ab"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    return [*some, " ".join(fib[-1]), "\n \x1c\x0b 漢 漢 " * 9]


def check(words, least):
    numbers = {w: k for k, w in enumerate(dict.fromkeys(words))}
    got = periodic_runs.runs_of(np.array([numbers[w] for w in words], np.int32), np.array([0, len(words)]), least)
    assert list(zip(*(x.tolist() for x in got[1:]), strict=True)) == brute(words, least)[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.sampled_from([2, 3, 12]))
def test_runs(words, least):
    check(words, least)


@pytest.mark.parametrize("text", texts())
def test_runs_of_texts(text):
    check(WORD.findall(text), 12)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9))
def test_extensions(seed):
    rng = random.Random(seed)
    symbols = [rng.randrange(3) for _ in range(rng.randrange(2, 150))]
    if rng.random() < 0.5:
        symbols = (symbols[: rng.randrange(1, 9)] * 99)[: len(symbols)]
    n = len(symbols)
    padded = np.array([3, *symbols, 4], np.int32)
    grammar = periodic_runs.Grammar.of(padded, 3)
    i, j = np.array([(a, b) for a in range(1, n + 1) for b in range(a + 1, n + 1)]).T if n > 1 else np.zeros((2, 0), int)
    want = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        k = 0
        while padded[a + k] == padded[b + k]:
            k += 1
        want.append(k)
    assert grammar.extend(i, j).tolist() == want


def test_small_blocks_give_the_same():
    sizes = np.array([0, 1, 2, 7, 40])
    every = [set(zip(*(np.concatenate(x).tolist() for x in zip(*periodic_runs.grid_pairs(sizes, block), strict=True)), strict=True)) for block in (3, 1 << 20)]
    want = {(t, k * p, p) for t, n in enumerate(sizes.tolist()) for p in range(1, n // 2 + 1) for k in range(n) if k * p + p < n}
    assert every[0] == every[1] == want


def test_tables(spark):
    rows = [(i, t, "own", 3, 4, "kept") for i, t in enumerate([*texts(), None])] + [(0, texts()[6], "own", 3, 4, "kept"), (None, "a " * 20, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "start", "_extra_1", "runs", "collapsed"]
    got = sorted(((r.doc_id is None, r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=repr)
    assert got == sorted(((r[0] is None, r[0] or 0, *brute(WORD.findall(r[1] or ""))) for r in rows), key=repr)
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = WORD.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        runs, rest = brute(words)
        s, k, q = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want.append((r.doc_id, len(runs), s, k, q, 1000 * k // q if runs else None, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, rest))))
    assert sorted(map(tuple, QUERIES["op12_periodic_runs"](spark, folder).collect())) == sorted(want)
