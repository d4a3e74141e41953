"""The training-data operators on small tables against brute force, with NULLs, empty and repeated rows and clashing columns."""

import collections
import hashlib
import math
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltline.llm import chain_dedup, ctw, decontaminate, language_id, line_dedup, line_quality, mixing, ngram_join, store, suffix_dedup, token_counts
from voltline.llm.components import components

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, item string, n_bytes string"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def corpus(seed=1):
    """Texts with copies, near copies, shared passages, repeated lines, and every odd case."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(3, 160)) for _ in range(24)]
    lines = "\n".join(words(rng, 8) for _ in range(5))
    passage = words(rng, 70, 5_000)
    near = base[5].split()
    texts = [*base, base[3], base[3], " ".join(near[:-1] + ["changed"]), " ".join([*near, "more"]), passage + " " + base[7], base[8] + "\n" + passage]
    texts += ["x\n" + lines + "\ny", lines, lines + "\n\n" + lines, None, "", " \n\t ", "a", "a b", "a b", "É É é", "0 0 0 0 0 0", "漢字かな" * 40, "tail " * 3000]
    rows = [(i, t, "ab"[i % 2] if i % 5 else None, ["s1", "s2", None, ""][i % 4], 1, -1, "own", "own", "own") for i, t in enumerate(texts)]
    return rows + [rows[0], (None, base[3], None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().lower().split()


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- 1 ----------------------------------------------------------------------------------------


def sets(rows, size):
    out = {}
    for r in rows:
        w = split(r[1])
        out[r[0]] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    return out


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (2, 50)])
def test_shingle_join(spark, docs, size, percent):
    rows = corpus()
    s = sets([r for r in rows if r[0] is not None], size)
    parent = {i: i for i in s}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in s:
        for b in s:
            n = len(s[a] & s[b])
            if a < b and n and 100 * n >= percent * len(s[a] | s[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    sizes = [len(sets([r], size)[r[0]]) for r in rows]
    want = sorted(((r[0], n, None if r[0] is None else top(r[0])) for r, n in zip(rows, sizes)), key=repr)
    assert found(ngram_join.join_by_shingles(docs, size=size, percent=percent), "doc_id", "n_shingles", "component_id") == want


def test_shingle_join_blocks_and_frequent_shingles(spark, monkeypatch):
    """One group of near copies on both sides of the limit, shared by all: combinations and blocks are in use."""
    monkeypatch.setattr(ngram_join, "SHORT", 3)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    s = sets(rows, 3)
    parent = list(range(60))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(60):
        for b in range(a):
            n = len(s[a] & s[b])
            if 100 * n >= 90 * len(s[a] | s[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join_by_shingles(df).collect()}
    assert got == {i: top(i) for i in range(60)} and len(set(got.values())) > 1


def test_shingle_join_in_turns_leaves_no_intermediate_tables(spark, docs, monkeypatch):
    """Sets compared in many turns give the same; what is left is what the result reads, and no list is written for a signature of one set."""
    plain = found(ngram_join.join_by_shingles(docs), "doc_id", "n_shingles", "component_id")
    monkeypatch.setattr(ngram_join, "TURN", 1000)
    paths: list[str] = []
    with store.noting(paths):
        out = ngram_join.join_by_shingles(docs)
    assert found(out, "doc_id", "n_shingles", "component_id") == plain
    left = {p for p in paths if any(Path(p.removeprefix("file:")).glob("*.parquet"))}
    assert len(paths) > 2 * len(left) and len(left) <= 8, (len(paths), len(left))


def test_table_of_frequencies_grows_with_the_corpus(spark):
    """A place holds about as many shingles in a large corpus as in a small one; its level says how many sets hold it, in their order."""
    assert [ngram_join.table_bits(n) for n in (0, 25_000_000, 125_000_000, 1_500_000_000, 7_500_000_000)] == [21, 21, 22, 26, 26]
    counts = np.arange(100_000)
    levels = ngram_join.level(counts)
    assert (np.diff(levels.astype(int)) >= 0).all() and levels[127] == 127 and levels[-1] > levels[20_000] > levels[1_000] > levels[130]
    rng = random.Random(4)
    rows = [(i, "a b c " + words(rng, 30, 500)) for i in range(300)]
    table = ngram_join.frequencies(spark.createDataFrame(rows, "key long, text string").select("text").repartition(3), 3, 16)
    want = np.zeros(1 << 16, np.int64)
    for _, tokens in ngram_join.sets_of(pa.array([t for _, t in rows]), 3):
        np.add.at(want, (tokens >> np.uint64(48)).astype(np.int64), 1)
    assert want.max() >= 300 and (table == ngram_join.level(want)).all()


def test_lists_hold_the_sets_of_shared_signatures(spark):
    """Only signatures of several different sets make lists; a copy adds nothing; sizes stand beside the smallest key."""
    text = "a b c d e f"
    df = spark.createDataFrame([(5, text), (2, text), (9, text + " g"), (7, "p q r s")], "key long, text string")
    table = np.zeros(1 << 16, np.uint8)
    rows = ngram_join.lists_of(ngram_join.postings(df, table, 0.0, 3, 50)).collect()
    assert rows and {(r["key"], r["n"], r["c"], r["lead"], r["low"], r["high"]) for r in rows} == {(2, 4, 2, 2, 4, 4), (9, 5, 2, 2, 4, 4)}


def test_signatures_of_linked_sets_meet():
    """Prefixes with combinations: any two sets within the limit share a signature, whatever the classes."""
    rng = np.random.default_rng(5)
    for trial in range(150):
        n = int(rng.integers(2, 260))
        percent = int(rng.choice([50, 80, 90]))
        universe = rng.integers(1, 1 << 62, 4 * n).astype(np.uint64)
        classes = dict(zip(universe.tolist(), rng.choice([1, 2, 3], len(universe)).tolist()))
        counts = {t: k * 100 + int(rng.integers(0, 5)) for t, k in classes.items()}
        x = np.unique(universe[:n])
        drop = ngram_join.losses(len(x), percent) // 2
        y = np.unique(np.concatenate([x[drop:], universe[n : n + drop]]))
        common, whole = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        if 100 * common < percent * whole or len(x) < 2 or np.array_equal(x, y):
            continue
        sig = [ngram_join.signatures(t, np.array([counts[v] for v in t.tolist()]), np.array([classes[v] for v in t.tolist()]), percent) for t in (x, y)]
        assert len(np.intersect1d(*sig)), (n, percent)


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(200)] + [(500, 300 + i) for i in range(80)] + [(7, None), (9, 9)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if b is not None and a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: top(i) for i in parent if top(i) != i}


# --- 2 ----------------------------------------------------------------------------------------


def test_context_tree_base_scores_and_probabilities(spark, docs):
    rows = corpus()
    learns = [r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2 for r in rows]
    counts = collections.Counter()
    for r, on in zip(rows, learns):
        if on:
            counts.update([*split(r[1]), None])
    n, v = sum(counts.values()), len(counts)
    training = language_id.learns(F.col("doc_id"), 7, 2)
    for most in (ctw.MOST_WORDS, 5):  # with five shared words nearly all are joined
        out = ctw.score_texts(docs, training, most_words=most)
        got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out.collect()), key=repr)
        want = []
        for r in rows:
            tokens = [*split(r[1]), None]
            want.append((r[0], len(tokens), sum(counts[t] > 0 for t in tokens), n, round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), 6)))
        assert got == sorted(want, key=repr)


def plain_tree(texts, depth):
    """Context-tree weighting by the book: counts by depth, context and bits so far; weights from below."""
    counts = collections.defaultdict(lambda: [0, 0])
    for t in texts:
        s = bytes(b" ".join(split(t)) + b"\xff")
        padded = b"\xff" * depth + s
        for i in range(len(s)):
            for bit in range(8):
                prefix = (1 << bit) | (s[i] >> (8 - bit))
                for d in range(depth + 1):
                    counts[d, padded[i + depth - d : i + depth], prefix][(s[i] >> (7 - bit)) & 1] += 1
    weighted = {}

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - 2 * math.lgamma(0.5)

    below = collections.defaultdict(float)
    stop = {}
    for d in range(depth, -1, -1):
        above = collections.defaultdict(float)
        for (k, context, prefix), (a, b) in counts.items():
            if k == d:
                own = kt(a, b)
                if k < depth:
                    deeper = below[context, prefix]
                    weighted[k, context, prefix] = math.log(0.5) + np.logaddexp(own, deeper)
                    stop[k, context, prefix] = math.exp(own - np.logaddexp(own, deeper))
                else:
                    weighted[k, context, prefix], stop[k, context, prefix] = own, 1.0
                if d:
                    above[context[1:], prefix] += weighted[k, context, prefix]
        below = above

    def log10(t):
        s = bytes(b" ".join(split(t)) + b"\xff")
        padded, total = b"\xff" * depth + s, 0.0
        for i in range(len(s)):
            for bit in range(8):
                prefix, one = (1 << bit) | (s[i] >> (8 - bit)), 0.5
                path = [(d, padded[i + depth - d : i + depth], prefix) for d in range(depth + 1)]
                for p in reversed(path):
                    if p in counts:  # else it says 1/2
                        a, b = counts[p]
                        one = stop[p] * (b + 0.5) / (a + b + 1) + (1 - stop[p]) * one
                total += math.log10(one if (s[i] >> (7 - bit)) & 1 else 1 - one)
        return total

    return log10


@pytest.mark.parametrize("depth", [2, 4])
def test_context_tree_weights(spark, monkeypatch, depth):
    """Against the tree by the book, also for texts that weren't learned from, and the same in any partitioning and slicing."""
    rows = [(i, t[:300] if t else t) for i, t, *_ in corpus()[:60:2]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    learned = [t for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 3]
    want = plain_tree(learned, depth)
    assert 0 < len(learned) < len(rows)
    seen = []
    for parts, size in ((1, 32 << 20), (5, 2_000)):
        monkeypatch.setattr(ctw, "SLICE_BYTES", size)
        out = ctw.score_texts(df.repartition(parts), training, depth=depth)
        seen.append(found(out, "doc_id", "score", "n_symbols"))
    assert seen[0] == seen[1]
    assert len(seen[0]) == len(rows)
    for i, score, n in seen[0]:
        assert math.isclose(score, want(dict(rows)[i]), rel_tol=1e-9), i


def test_context_tree_is_a_distribution(spark):
    """Next symbols after a context share exactly one, in contexts seen and unseen."""
    rng = np.random.default_rng(3)
    keys = np.unique(rng.choice(np.frombuffer(b"abc dz\xff", np.uint8), (400, 4)).copy().view("<u4").ravel().astype(np.uint64))
    tree = ctw.levels(keys, rng.integers(1, 50, len(keys)), 3, 0)
    for context in (0x616263, 0xFFFFFF, 0x207720, 0x010101):
        codes = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert math.isclose((10 ** ctw.log10(tree, codes)).sum(), 1, rel_tol=1e-12)


def test_context_tree_columns(spark):
    """Columns with the operator's own names pass, those of added ones are replaced."""
    rows = [(1, "a b", 7, 8, 9, "x"), (1, "a b", 7, 8, 9, "x"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long, _slice int, score int, _learns string")
    got = sorted((tuple(r[c] for c in ("doc_id", "_row", "_slice", "_learns", "n_tokens", "n_symbols")) for r in ctw.score_texts(df, F.lit(True)).collect()), key=repr)
    assert got == sorted([(1, 7, 8, "x", 3, 4)] * 2 + [(None, None, None, None, 1, 1)], key=repr)


def test_context_tree_without_training(spark, docs, empty):
    r = ctw.score_texts(docs, F.lit(False)).filter("doc_id = 1").first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and math.isclose(r["score"], -8 * r["n_symbols"] * math.log10(2))
    assert ctw.score_texts(empty, F.lit(True)).count() == 0


# --- 3 ----------------------------------------------------------------------------------------


def plain_tiles(item, document, size):
    """The greedy definition itself: the longest free common run, first in the item, then in the document."""
    used_i, used_j, out = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                n = 0
                while i + n < len(item) and j + n < len(document) and item[i + n] == document[j + n] and i + n not in used_i and j + n not in used_j:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < size:
            return out
        n, i, j = best
        used_i |= set(range(i, i + n))
        used_j |= set(range(j, j + n))
        out.append((i, j, n))


def test_tiles():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.randrange(4) for _ in range(rng.randrange(0, 22))]
        document = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        got = decontaminate.tiles(np.array(item, np.uint64), np.array(document, np.uint64), 3)
        assert sum(x[2] for x in got) == sum(x[2] for x in plain_tiles(item, document, 3))
        assert sorted(x[2] for x in got) == sorted(x[2] for x in plain_tiles(item, document, 3))


def test_contamination(spark, docs, empty):
    texts = {r[0]: r[1] for r in corpus()}
    w = texts[1].split()
    half = len(w) // 2
    items = [(1, texts[1]), (2, " ".join(w[half:] + w[:half])), (3, "a b"), (4, None), (5, words(random.Random(9), 40, 10_000)), (None, texts[2])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs, bench)
    want = []
    for r in corpus():
        hits = []
        for i, t in items:
            a, b = split(t), split(r[1])
            if i is not None and r[0] is not None and len(a) >= 5 and len(b) <= 400:
                c = sum(x[2] for x in plain_tiles(a, b, 5)) / len(a)
                if c >= decontaminate.COVERAGE:
                    hits.append((c, -i))
        want.append((r[0], bool(hits), len(hits), -max(hits)[1] if hits else None))
    assert found(out, "doc_id", "contaminated", "n_items", "item") == sorted(want, key=repr)
    assert any(x[2] == 2 for x in want)  # the reordered item too
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(empty, bench).count() == 0


# --- 4 ----------------------------------------------------------------------------------------


def test_line_quality(spark, empty):
    rng = random.Random(6)
    own = [words(rng, 60, 5_000) for _ in range(30)]
    rows = [(i, t + "\nShared  Line of 7 words right here", "h" if i % 2 else None) for i, t in enumerate(own)]
    rows += [(100 + i, "shared line of 8 words right here\nand two", "h") for i in range(6)] + [(200, None, "h"), (201, "", None), (202, ("a b c " * 40).strip(), "h"), (None, own[0], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("kept", F.lit("own")).withColumn("_body", F.lit("own"))
    got = {r["doc_id"]: r for r in line_quality.line_quality(df, most_documents=5).collect()}
    assert len(got) == len(rows) and got[0]["_body"] == "own"
    # per host: 15 texts each share the line (digits alike); the first keeps it
    assert got[0]["n_removed_words"] == 0 and got[1]["n_removed_words"] == 0
    assert got[2]["n_removed_words"] == got[3]["n_removed_words"] == got[100]["n_removed_words"] == 7
    assert got[2]["kept"] and not got[100]["kept"] and got[100]["base_failed"]
    assert got[200]["n_words"] == 0 and got[201]["base_failed"] and got[202]["base_failed"] and got[202]["n_repeat_words"] == 120
    cleaned = {r["doc_id"]: r["text"] for r in line_quality.apply_rules(df, most_documents=5).collect()}
    assert cleaned[2] == own[2] and cleaned[1] == rows[1][1] and 100 not in cleaned and 202 not in cleaned
    assert line_quality.line_quality(empty).count() == 0


# --- 5 ----------------------------------------------------------------------------------------


def test_line_dedup(spark, docs, empty):
    rng = random.Random(8)
    rows = corpus() + [(1000 + i, "\n".join(rng.choice(["p", "q q", "R", "", "s"]) for _ in range(rng.randrange(12))), *[None] * 7) for i in range(25)]
    df = spark.createDataFrame(rows, SCHEMA)
    first, want = {}, []
    parsed = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        lines = (r[1] or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.encode().split()]
        normal = [b" ".join(lines[i].encode().lower().split()) for i in at]
        parsed[r[0]] = lines, at, [tuple(normal[k : k + 3]) for k in range(len(at) - 2)]
        for k, run in enumerate(parsed[r[0]][2]):
            first[run] = min(first.get(run, (r[0], k)), (r[0], k))
    for r in rows:
        if r[0] is None:
            want.append((None, r[1], 0))
            continue
        lines, at, runs = parsed[r[0]]
        gone = {at[k + x] for k, run in enumerate(runs) if first[run] < (r[0], k) for x in range(3)}
        want.append((r[0], "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else r[1], len(gone)))
    assert found(line_dedup.dedup_lines(df), "doc_id", "text", "n_removed_lines") == sorted(want, key=repr)
    assert sum(x[2] > 0 for x in want) > 5
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_of_long_lines(spark):
    """With least_words, repeats of one and two long lines go, shorter ones stay."""
    rng = random.Random(35)
    one, short = words(rng, 60, 10_000), words(rng, 40, 10_000)
    two = [words(rng, 30, 10_000), words(rng, 20, 10_000)]
    fill = [words(rng, 30, 10_000) for _ in range(6)]
    texts = {1: [one], 2: [fill[0], one], 3: [*two, fill[1]], 4: [fill[2], *two], 5: [one], 6: [short], 7: [short, fill[3]], 8: [two[0], fill[4]], 9: [fill[5], one.upper(), "", *two]}
    df = spark.createDataFrame([(k, "\n".join(t)) for k, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed_lines"]) for r in line_dedup.dedup_lines(df, least_words=50).collect()}
    want = {k: ("\n".join(t), 0) for k, t in texts.items()} | {2: (fill[0], 1), 4: (fill[2], 2), 5: ("", 1), 9: (fill[5] + "\n", 3)}
    assert got == want


# --- 6 ----------------------------------------------------------------------------------------


def test_substring_removal(spark, docs, empty):
    rows = corpus()
    seen, want = {}, []
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (r[1] or "").encode()
        for k in range(len(b) - 49):
            seen.setdefault(b[k : k + 50], r[0])
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49 if r[0] is not None else 0):
            if seen[b[k : k + 50]] < r[0]:
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        want.append((r[0], len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    out = suffix_dedup.dedup_substrings(docs).withColumn("kept_sha256", F.sha2("kept", 256))
    assert found(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert suffix_dedup.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("slice_bytes,least", [(1, 1), (2_000, 7)])
def test_substrings_of_many_slices_and_buckets(spark, docs, monkeypatch, slice_bytes, least):
    want = found(suffix_dedup.dedup_substrings(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(suffix_dedup, "LEAST_BUCKETS", least)
    assert found(suffix_dedup.dedup_substrings(docs.repartition(3)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept") == want


def test_sampled_names_are_sent_packed(spark):
    """One row for each bucket of a slice, and little more than four bytes for a sampled name."""
    import zlib

    rng = random.Random(12)
    texts = spark.createDataFrame([(i, "".join(rng.choices("abcdefgh ", k=20_000))) for i in range(60)], "key long, text string").coalesce(1)
    sent = [r for turn in range(suffix_dedup.PASSES) for r in suffix_dedup.named(texts, 38, turn, 16, False).collect()]
    n = 60 * len([i for i in range(20_000 - 37) if i % 13 in (0, 1, 3, 9)])
    assert len(sent) <= suffix_dedup.PASSES * 16 and sum(len(r["names"]) for r in sent) == 4 * n
    assert sum(len(zlib.compress(r["keys"], 1)) + len(zlib.compress(r["at"], 1)) for r in sent) < 2 * n
    for kind in (np.int32, np.int64):
        x = np.array([3, 900, 5, -7, 2**31 - 1, 0, 65_536], kind)
        assert (suffix_dedup.unpacked(suffix_dedup.packed(x), kind) == x).all()


# --- 7 ----------------------------------------------------------------------------------------


def test_repeated_passages(spark, docs, empty):
    rng = random.Random(10)
    passage = words(rng, 80, 10_000).split()
    fuzzy = [w if i % 15 != 9 else "other" for i, w in enumerate(passage)]
    del fuzzy[40]
    rows = [(i, words(rng, 120, 10_000)) for i in range(12)]
    rows += [(20, rows[0][1][:200] + " " + " ".join(passage) + " " + words(rng, 50, 10_000)), (21, words(rng, 30, 10_000) + " " + " ".join(fuzzy)), (22, None), (23, ""), (24, " ".join(passage))]
    got = {r["doc_id"]: r for r in chain_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["n_passages"] == 0 and got[i]["others"] == [] for i in [*range(12), 22, 23])
    assert got[21]["others"] == [20] and 74 <= got[21]["n_repeated"] <= 82
    assert got[24]["n_repeated"] == 80 and got[24]["first_other"] == 20
    mixed = {r["doc_id"]: r["n_repeated"] for r in chain_dedup.repeated_passages(docs).collect()}
    texts = {r[0]: r[1] for r in corpus()}
    for i in (24, 25, 26, 27, 29):  # copies, near copies and the shared passage
        assert mixed[i] >= min(65, 0.9 * len(texts[i].split())) or len(texts[i].split()) < chain_dedup.LEAST_WORDS
    assert chain_dedup.repeated_passages(empty).count() == 0


def test_chains_are_the_best():
    """Scores against the quadratic recurrence."""
    rng = random.Random(11)
    for _ in range(40):
        n, k = rng.randrange(1, 25), 4
        places = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        x, y = (np.array(c) for c in zip(*places))
        best = []
        for j in range(len(x)):
            score = float(k)
            for i in range(j):
                if x[i] < x[j] and y[i] < y[j]:
                    step = min(k, x[j] - x[i], y[j] - y[i]) - 0.1 * (max(0, x[j] - x[i] - k) + max(0, y[j] - y[i] - k))
                    score = max(score, best[i] + step)
            best.append(score)
        got = chain_dedup.chains(x, y, k, 0.1, 1000)
        assert got[0][0] <= max(best) + 1e-9 and got[0][0] >= 0.8 * max(best)
        assert sorted(i for _, path in got for i in path) == list(range(len(x)))


def test_passage_held_twice(spark):
    """Every place of a seed counts, in the later document and in the earlier one."""
    rng = random.Random(31)
    passage, other, phrase = words(rng, 60, 10_000), words(rng, 60, 10_000), words(rng, 12, 10_000)
    fill = [words(rng, 80, 10_000) for _ in range(8)]
    rows = [(1, f"{fill[0]} {passage} {fill[1]}"), (2, f"{passage} {fill[2]} {passage} {fill[3]} {passage}")]
    rows += [(3, f"{phrase} {fill[4]} {other[:200]} {phrase} {other[200:]}"), (4, f"{phrase} {fill[5]} {phrase} {fill[6]} {other[:200]} {phrase} {other[200:]}")]
    rows += [(5, "tail " * 3000), (6, fill[7] + " " + "tail " * 2000)]
    got = {r["doc_id"]: r for r in chain_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2]["n_passages"] == 3 and 180 <= got[2]["n_repeated"] <= 186 and got[2]["others"] == [1]
    assert 70 <= got[4]["n_repeated"] <= 76 and got[4]["others"] == [3]
    assert got[6]["n_repeated"] >= 1900 and got[6]["others"] == [5]


def test_seeds_side_by_side_meet_as_one(spark):
    """Only seeds of several documents become rows; those that always stand together are one match of a pair, cut where a third document has a part."""
    rng = random.Random(34)
    passage = words(rng, 40, 10_000)
    texts = [(i, f"{words(rng, 50, 10_000)} {passage} {words(rng, 50, 10_000)}") for i in (1, 2)]
    for more, want in (([], [(50, 50, 36)]), ([(3, " ".join(passage.split()[:14]))], [(50, 50, 10), (60, 60, 26)])):
        df = spark.createDataFrame(texts + more, "key long, text string")
        near = df.join(chain_dedup.shared_places(df, 5, 1, 300), "key").select("key", "text", "spans")
        rows = chain_dedup.seed_rows(near, 5, 1)
        assert rows.filter("key = 1").count() == 36
        assert sorted((r["at"], r["other_at"], r["n"]) for r in chain_dedup.matches(rows).collect() if (r["key"], r["other"]) == (2, 1)) == want


def test_passage_whose_halves_are_elsewhere_first(spark, monkeypatch):
    """Pairs are found although all their seeds stood in other documents first; long lists in blocks too."""
    monkeypatch.setattr(chain_dedup, "BLOCK_PLACES", 4)
    rng = random.Random(32)
    parts = [words(rng, 22, 10_000) for _ in range(4)]
    passage = " ".join(parts)
    rows = [(i, f"{words(rng, 60, 10_000)} {part} {words(rng, 60, 10_000)}") for i, part in enumerate(parts)]
    rows += [(i, f"{words(rng, 50, 10_000)} {passage} {words(rng, 50, 10_000)}") for i in range(10, 22)]
    rows += [(30, rows[5][1])]
    got = {r["doc_id"]: r for r in chain_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["others"] == list(range(10, i)) for i in range(11, 22)) and all(got[i]["others"] == [] for i in (0, 1, 2, 3, 10))
    assert all(88 <= got[i]["n_repeated"] <= 94 for i in range(11, 22))
    assert got[30]["others"] == [11] and got[30]["n_repeated"] == 188


def test_passage_classes_need_no_pairs_of_large_groups(spark, monkeypatch):
    """Near copies, holders of one passage and of common lines: classes and words as from all pairs, but rows in proportion to documents."""
    monkeypatch.setattr(chain_dedup, "BLOCK_PLACES", 8)
    monkeypatch.setattr(chain_dedup, "MOST_TRIED", 64)
    rng = random.Random(35)
    passage, line, other = words(rng, 40, 10_000), words(rng, 13, 10_000), words(rng, 12, 10_000)
    copy = words(rng, 90, 10_000).split()
    half = [words(rng, 9, 10_000) for _ in range(4)]
    rows = [(i, f"{words(rng, 50, 10_000)} {passage} {words(rng, 50, 10_000)}") for i in range(30)]
    rows += [(i, " ".join(w if rng.random() > 0.04 else f"edit{rng.randrange(10**6)}" for w in copy)) for i in range(100, 130)]
    rows += [(i, f"{words(rng, 30, 10_000)} {line} {words(rng, 20 + i % 7 * 10, 10_000)} {other} {words(rng, 30, 10_000)}") for i in range(200, 230)]
    rows += [(i, f"{words(rng, 40, 10_000)} {f' w{i} '.join(half)} {words(rng, 40, 10_000)}") for i in range(300, 312)]  # no run of ten words in common
    rows += [(400, rows[5][1]), (401, "short text"), (402, "short text"), (403, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links, want = chain_dedup.passages(df).select("key", "other", "begin", "end").collect(), {}
    parent = {r[0]: r[0] for r in rows}
    for r in sorted(links):
        a, b = r["key"], r["other"]
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)
        want.setdefault(r["key"], set()).update(range(r["begin"], r["end"]))
    found = chain_dedup.class_passages(df).collect()
    assert len({(r["key"], r["other"]) for r in links}) > 900 and len({(r["key"], r["other"]) for r in found}) < 350
    got = {r["doc_id"]: r for r in chain_dedup.passage_classes(df).collect()}
    assert len(got) == len(rows)
    for key in parent:
        root = key
        while parent[root] != root:
            root = parent[root]
        assert got[key]["component_id"] == root
        assert abs(got[key]["n_repeated"] - len(want.get(key, ()))) <= 2  # words beyond the seeds that agree by chance
    assert {got[i]["component_id"] for i in range(200, 230)} == set(range(200, 230)) and got[400]["component_id"] == 0
    assert got[300]["component_id"] == got[311]["component_id"] == 300 and all(got[i]["n_passages"] == 1 for i in range(1, 30))


def test_few_words_in_common_are_told_without_alignment():
    rng = np.random.default_rng(36)
    for _ in range(200):
        a, b = rng.integers(0, 30, rng.integers(0, 60)), rng.integers(0, 30, rng.integers(0, 60))
        b = np.concatenate([a[:20], b[: rng.integers(0, 8)], a[20:]]) if rng.random() < 0.7 else b
        assert chain_dedup.alike_enough(a, b, 60, 0.7) == (chain_dedup.alike(a, b, 60) >= 0.7)


def test_recall_of_edited_passages(spark):
    """Passages of 30 to 60 words with an edit every 6 to 10 words, and exact ones of 30 to 38, are all found."""
    rng = random.Random(33)
    rows, planted = [], {}
    for i in range(240):
        passage = words(rng, rng.randrange(30, 61), 10_000).split()
        step = rng.randrange(6, 11)
        edited = [f"edit{rng.randrange(10**6)}" if j % step == step // 2 and 0 < j < len(passage) - 1 else w for j, w in enumerate(passage)]
        if i % 4 == 0:
            passage = edited = passage[: rng.randrange(30, 39)] if len(passage) > 38 else passage
        if sum(a == b for a, b in zip(passage, edited)) >= 0.7 * len(passage):
            planted[1000 + i] = i, len(passage)
        rows += [(key, f"{words(rng, 60, 10_000)} {' '.join(p)} {words(rng, 60, 10_000)}") for key, p in ((i, passage), (1000 + i, edited))]
    got = {r["doc_id"]: r for r in chain_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(planted) == 240
    missed = [k for k, (other, n) in planted.items() if got[k]["others"] != [other] or abs(got[k]["n_repeated"] - n) > 4]
    assert missed == []


def test_second_passage_after_a_long_one():
    """A long chain far behind doesn't hide near predecessors."""
    x = np.array([*range(0, 161, 8), *range(400, 496, 8)])
    got = chain_dedup.chains(x, x, 8, 0.1, 60)
    assert sorted(len(path) for _, path in got) == [12, 21]
    rng = random.Random(12)
    for _ in range(40):
        k = 4
        x, y = (np.array(c) for c in zip(*sorted({(rng.randrange(400), rng.randrange(400)) for _ in range(rng.randrange(1, 60))} | {(i, i + 3) for i in range(0, 90, 6)})))
        best = []
        for j in range(len(x)):
            steps = [best[i] + min(k, x[j] - x[i], y[j] - y[i]) - 0.1 * (max(0, x[j] - x[i] - k) + max(0, y[j] - y[i] - k)) for i in range(j) if 0 < x[j] - x[i] <= 60 and 0 < y[j] - y[i] <= 60]
            best.append(max([float(k), *steps]))
        got = chain_dedup.chains(x, y, k, 0.1, 60)
        assert math.isclose(got[0][0], max(best)) and sorted(i for _, path in got for i in path) == list(range(len(x)))


# --- 8 ----------------------------------------------------------------------------------------


def test_token_counts(spark, docs, empty):
    model = token_counts.encoder(PIECES).model
    want = sorted(((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in corpus()), key=repr)
    for chunk, overlap in ((token_counts.CHUNK_BYTES, token_counts.OVERLAP_BYTES), (64, 4)):
        assert found(token_counts.count_tokens(docs, PIECES, chunk_bytes=chunk, overlap_bytes=overlap), "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.count_tokens(empty, PIECES).count() == 0


def test_token_counts_by_chunks():
    code, rng = token_counts.encoder(PIECES), random.Random(12)
    odd = ["".join(rng.choice("abc e▁  \n\tàß漢字😀<s>01") for _ in range(900)) for _ in range(15)] + ["a" * 900, " " * 900, "the" * 300, "漢" * 400, "x" + " " * 700 + "y"]
    for t in odd:
        assert {code.count(t, c, o) for c, o in ((64, 2), (200, 20), (500, 50))} == {len(code.model.encode(t))}


# --- 9 ----------------------------------------------------------------------------------------


def all_ways(word, chance):
    """Sum over all segmentations, by trying every cut."""
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            p = chance.get(piece, chance[None] if len(piece) == 1 else 0.0)
            total[end] += total[start] * p
    return total[-1]


def test_forward_sums_all_segmentations():
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(open(PIECES, "rb").read())
    pieces = sorted({p.piece for p in spec.pieces if p.type in (1, 4) and "▁" not in p.piece[1:]})
    vocab = language_id.vocabulary(PIECES)
    rng = np.random.default_rng(0)
    probability = rng.random((vocab.size + 1, 2)) / 500
    todo = ["▁the", "▁of", "▁straightforward", "▁x漢😀y", "▁" + "na" * 120]
    got = language_id.forward(todo, vocab, probability)
    for k in range(2):
        chance = {p: probability[i, k] for i, p in enumerate(pieces)} | {None: probability[-1, k]}
        for w, g in zip(todo[:-1], got[:-1, k]):
            assert math.isclose(g, math.log(all_ways(w, chance)), rel_tol=1e-9)
    assert np.isfinite(got).all()
    uses = language_id.expected(todo[:3], np.array([2.0, 1.0, 1.0]), vocab, probability[:, 0])
    lengths = np.array([len(p) for p in pieces] + [1])
    assert math.isclose((uses * lengths).sum(), sum(n * len(w) for n, w in zip((2, 1, 1), todo)), rel_tol=1e-9)


def test_language(spark, empty):
    rng = random.Random(13)
    sounds = {"xx": ["tion", "ing", "the", "er"], "yy": ["heit", "sch", "ung", "ein"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[k]) for _ in range(rng.randrange(1, 4))) for _ in range(20)), k) for i in range(60) for k in [("xx", "yy")[i % 2]]]
    rows += [(100, None, "xx"), (101, "", "yy"), (102, "12 34 !!", "xx"), (103, "the thing", None), (None, "einheit", "yy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    training = language_id.learns(F.col("doc_id"), 3, 1)
    model = language_id.fit(df.filter(training), PIECES)
    assert model.languages == ["xx", "yy"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(df, model, PIECES).collect()}
    assert all(got[i][0] == k for i, _, k in rows[:60]) and got[103][0] == "xx" and got[None][0] == "yy"
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in got.values())
    none = language_id.fit(df.limit(0), PIECES)
    assert {r["lang_pred"] for r in language_id.identify(df, none, PIECES).collect()} == {"und"}
    assert language_id.identify(empty, model, PIECES).count() == 0


# --- 10 ---------------------------------------------------------------------------------------


def fair(sizes):
    """By sharing the excess again and again."""
    weight, capped, total = {s: i % 3 + 1 for i, s in enumerate(sizes)}, {}, sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return capped | target
        capped |= over


def test_mix(spark, docs, empty):
    rng = random.Random(14)
    names = sorted(["", "B", "a", "b", "ü", "漢", "😀"], key=lambda s: [ord(c) for c in s]) + [None]
    rows = [(i, words(rng, rng.randrange(0, 200)), names[min(int(rng.expovariate(0.6)), 7)]) for i in range(600)] + [(900, None, "a"), (901, None, "zero"), (900, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("own")).withColumn("_row", F.lit(5))
    out = mixing.mix_sources(df, block_words=16)
    got = out.collect()
    again = mixing.mix_sources(df, block_words=16)
    assert found(out, "doc_id", "size", "taken") == found(again, "doc_id", "size", "taken")
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(split(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = fair({s: sizes[s] for s in order})
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["_row"] == 5
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 24
    assert len(got) == len(rows)
    assert mixing.mix_sources(docs).count() == len(corpus()) and mixing.mix_sources(empty).count() == 0


def test_mixed_blocks(spark, empty):
    """Shards hold the words that the counts promise, and pieces say where."""
    rng = random.Random(34)
    rows = [(i, words(rng, rng.randrange(0, 90), 10**6), rng.choice(["a", "b", "b", "b", None])) for i in range(120)] + [(500, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    blocks = {(r["source"], r["slot"]): r for r in mixing.mixed_blocks(df, block_words=16, shards=5).collect()}
    out = mixing.mix_texts(df, block_words=16, shards=5).collect()
    assert {r["doc_id"]: r["taken"] for r in mixing.mix_sources(df, block_words=16, shards=5).collect()} == {r["doc_id"]: r["taken"] for r in out}
    assert {r["doc_id"]: r["text"] for r in out} == {r[0]: r[1] for r in rows}
    held = collections.Counter()
    for r in out:
        assert r["taken"] == sum(p["n_words"] for p in r["pieces"])
        for p in r["pieces"]:
            block = blocks[r["source"], p["slot"]]
            piece = r["text"].split()[p["first"] : p["first"] + p["n_words"]]
            assert block["shard"] == p["shard"] and len(piece) == p["n_words"] and f" {' '.join(piece)} " in f" {block['text']} "
            held[r["source"], p["slot"]] += p["n_words"]
    assert held == {k: len(b["text"].split()) for k, b in blocks.items()} and {b["shard"] for b in blocks.values()} == set(range(5))
    other = {(r["source"], r["slot"]): r["shard"] for r in mixing.mixed_blocks(df, block_words=16, shards=3).collect()}
    assert other.keys() == blocks.keys() and set(other.values()) == set(range(3))
    assert mixing.mixed_blocks(empty).count() == 0


def test_permutation(spark):
    df = spark.range(1000).select(mixing.permuted(F.col("id"), F.lit(1000), F.lit(7)).alias("p"), "id")
    got = [r["p"] for r in df.orderBy("id").collect()]
    assert sorted(got) == list(range(1000)) and got != list(range(1000))


# --- stages -----------------------------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline as cp

    from ..conftest import SF_DIR

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"]
    out = cp.run(spark, SF_DIR).collect()
    kept = {r["doc_id"]: r["text"] for r in line_quality.apply_rules(documents).collect()}
    lines = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(list(kept.items()), "doc_id long, text string"), least_words=line_dedup.PASSAGE_WORDS).filter("n_removed_lines < n_lines OR n_removed_lines = 0").collect()}
    s = sets([(i, t) for i, t in lines.items()], 5)
    first = {}
    for a in sorted(s):
        first[a] = a
        for b in sorted(first):
            n = len(s[a] & s[b])
            if b < a and n and 100 * n >= 80 * len(s[a] | s[b]):
                first[a] = min(first[a], first[b])
    singles = {i for i in first if first[i] == i}
    items = [split(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = set()
    for i in singles:
        w = split(lines[i])
        seeds = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        worst = max((sum(x[2] for x in plain_tiles(t, w, 5)) / len(t) for t in items if any(tuple(t[k : k + 5]) in seeds for k in range(len(t) - 4))), default=0)
        if worst < decontaminate.COVERAGE:
            clean.add(i)
    assert {r["doc_id"] for r in out} == clean
    assert sum(r["size"] for r in out) == sum(len(split(lines[i])) for i in clean)


def test_equal_keys_with_other_texts(spark):
    """Odd, but no reason to break down."""
    rng = random.Random(21)
    long = "\n".join(words(rng, 40, 9_000) for _ in range(6))
    rows = [(1, long), (2, long), (2, "short"), (2, None), (3, long.replace("\n", " "))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.dedup_lines(df).count() == suffix_dedup.dedup_substrings(df).count() == chain_dedup.repeated_passages(df).count() == len(rows)
    assert ngram_join.join_by_shingles(df).filter("component_id = 1").count() == len(rows)
    assert mixing.mix_sources(df.withColumn("source", F.lit("a"))).count() == len(rows)


def test_the_mix_does_not_follow_the_partitioning(spark, docs):
    """Reruns agree, whatever files the rows come from; slots are made by more than one task."""
    seen = []
    for n in (1, 3, 11):
        out = mixing.mix_sources(docs.repartition(n), block_words=16, shards=5)
        seen.append((found(out, "doc_id", "source", "size", "target", "taken"), found(mixing.mixed_blocks(docs.repartition(n), block_words=16, shards=5), "shard", "source", "slot", "block", "text")))
    assert seen[0] == seen[1] == seen[2]
    targets = spark.createDataFrame([("a", 1_000_000, 2_000_000.0)], "source string, source_size long, target double")
    slots = mixing.draw_slots(targets)
    tasks = slots.withColumn("t", F.spark_partition_id()).groupBy("t").count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.8 * slots.count()


def test_pairs_of_documents_meet_in_turns(spark, docs, monkeypatch):
    """Lists of units go along with pairs in turns that hold few of them, the shorter list to the longer one; passages stay the same."""
    rng = random.Random(31)
    line = words(rng, 40, 9_000)
    rows = [(i, " ".join([words(rng, rng.randrange(5, 300), 9_000), line, words(rng, 10, 9_000), *([line] if i % 3 == 0 else [])])) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    columns = ("doc_id", "n_passages", "n_repeated", "component_id")
    plain = [found(chain_dedup.passage_classes(d), *columns) for d in (df, docs)]
    assert [r[0] for r in plain[0] if r[2] >= 40] == sorted(range(1, 30), key=lambda i: repr((i,))) and {r[3] for r in plain[0]} == {0}
    monkeypatch.setattr(chain_dedup, "PAIR_UNITS", 0.2)
    monkeypatch.setattr(chain_dedup, "MATCHED", 16)
    sizes: list[int] = []
    whole = chain_dedup.stored

    def noted(frame, tidy=False):
        out = whole(frame, tidy)
        if out.columns == ["key", "other", "x0", "x1", "y0", "y1"]:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(chain_dedup, "stored", noted)
    assert [found(chain_dedup.passage_classes(d), *columns) for d in (df, docs)] == plain
    assert sum(n > 0 for n in sizes) > 4


def test_stored_tables_of_earlier_stages_go(spark):
    from voltline.llm import store

    paths: list[str] = []
    with store.noting(paths):
        one, two = (store.stored(spark.range(5)) for _ in range(2))
    store.stored(spark.range(3))
    assert len(paths) == 2
    store.removed(spark, paths, one.filter("id > 1"))
    assert one.count() == 5 and spark.read.schema("id long").parquet(paths[0]).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.schema("id long").parquet(paths[1])
