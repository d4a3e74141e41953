"""Language of a text by unigram pieces, summed over all ways to cut it.

The pieces are those of a public vocabulary. A language has a probability for each piece; a
text's probability in a language is the sum over all segmentations into pieces, by the forward
algorithm. No piece joins two words (a word is "▁" and its letters), so a text's sum is the
product of its words' sums, and each different word of a batch is worked out once. Piece
probabilities are fitted by expectation-maximisation over the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .store import shields
from .words import mix

#: Training takes all rows of a language up to about so many, chosen by a hash of their key.
SAMPLE_ROWS = 3_000
ROUNDS = 2
SMOOTHING = 0.1
#: Characters whose different words are worked out together.
BATCH_CHARS = 4 << 20
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_vocabularies: dict[str, Vocabulary] = {}
_STEP = 48  #: characters of a word that are worked on at once in training


class Vocabulary:
    """Pieces by a hash of their characters; the last id stands for any character that is no piece."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        pieces = sorted({p.piece for p in spec.pieces if p.type in (1, 4) and "▁" not in p.piece[1:]})
        self.size, self.longest = len(pieces), max(map(len, pieces))
        hashes = np.array([_whole(np.array([ord(c) for c in p], np.uint64)) for p in pieces], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), self.size - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)


def _whole(characters: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in characters:
            h = h * _BASE + mix(np.array([c], np.uint64))[0]
    return h


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def lattice(words: list[str], vocab: Vocabulary) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each end t and length l: the words that have such a piece there, and its id. `words` must be sorted by length, longest first."""
    sizes = np.array([len(w) for w in words])
    flat = mix(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64))
    start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    rolling: list[np.ndarray] = []  # of the last `longest` lengths, hashes ending at t
    for t in range(int(sizes[0]) if len(sizes) else 0):
        live = int(np.searchsorted(-sizes, -t, "left"))  # words longer than t
        character = flat[start[:live] + t]
        rolling = [character, *(h[:live] * _BASE + character for h in rolling[: vocab.longest - 1])]
        for length, h in enumerate(rolling, 1):
            ids = vocab.find(h)
            rows = np.flatnonzero(ids >= 0)
            found = ids[rows]
            if length == 1 and len(rows) < live:
                found, rows = np.where(ids < 0, vocab.size, ids), np.arange(live)
            if len(rows):
                yield t + 1, length, rows, found


def forward(words: list[str], vocab: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """log of each word's probability in each language; probability: pieces (and the unknown one) x languages."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    languages = probability.shape[1]
    out, scale = np.zeros((len(words), languages)), np.zeros((len(words), languages))
    sums: dict[int, np.ndarray] = {0: np.ones((len(words), languages))}
    ordered = [words[i] for i in order]
    sizes = np.array([len(w) for w in ordered])

    def close(t: int) -> None:
        done = slice(int(np.searchsorted(-sizes, -t, "left")), int(np.searchsorted(-sizes, -t, "right")))
        if done.start < done.stop:
            out[done] = np.log(sums[t][done]) + scale[done]
        low = sums[t].max(axis=1) < 1e-60
        low &= sums[t].max(axis=1) > 0
        if low.any():
            for s in sums.values():
                rows = np.flatnonzero(low[: len(s)])
                s[rows] *= 1e60
            scale[np.flatnonzero(low)] -= 60 * np.log(10)
        sums.pop(t - vocab.longest, None)

    now = 0
    for t, length, rows, ids in lattice(ordered, vocab):
        if t != now:
            if now:
                close(now)
            now = t
            sums[t] = np.zeros((int(np.searchsorted(-sizes, -t, "right")), languages))
        sums[t][rows] += sums[t - length][rows] * probability[ids]
    if now:
        close(now)
    result = np.empty_like(out)
    result[order] = out
    return result


def expected(words: list[str], counts: np.ndarray, vocab: Vocabulary, probability: np.ndarray) -> np.ndarray:
    """Expected uses of each piece (and the unknown one) over all segmentations of the words."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    ordered, weight = [words[i] for i in order], counts[order]
    sizes = np.array([len(w) for w in ordered])
    edges = list(lattice(ordered, vocab))
    ahead = np.zeros((sizes[0] + 1, len(words)))
    back = np.zeros_like(ahead)
    ahead[0], back[sizes, np.arange(len(words))] = 1, 1
    for t, length, rows, ids in edges:
        ahead[t][rows] += ahead[t - length][rows] * probability[ids]
    for t, length, rows, ids in reversed(edges):
        back[t - length][rows] += back[t][rows] * probability[ids]
    total = ahead[sizes, np.arange(len(words))]
    share = np.divide(weight, total, out=np.zeros(len(words)), where=total > 0)
    uses = np.zeros(vocab.size + 1)
    for t, length, rows, ids in edges:
        uses += np.bincount(ids, ahead[t - length][rows] * probability[ids] * back[t][rows] * share[rows], vocab.size + 1)
    return uses


def text_words(text: str) -> list[str]:
    return ["▁" + w for w in text.lower().split()]


class Model:
    def __init__(self, languages: list[str], probability: np.ndarray):
        self.languages, self.probability = languages, probability


def fit(labelled: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", language: str = "lang", sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language of `labelled` (rows without text or language teach nothing).

    The model is languages x vocabulary in size; it comes to the driver, the corpus doesn't.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(language).isNotNull()).select(F.col(language).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(found)
    vocab = vocabulary(vocabulary_path)
    if not languages:
        return Model([], np.zeros((vocab.size + 1, 0)))
    rate = F.lit(0.0)
    for name, n in found.items():
        rate = F.when(F.col("lang") == name, F.lit(min(1.0, sample_rows / n))).otherwise(rate)
    sample = rows.filter(F.pmod("h", F.lit(1 << 20)) < rate * (1 << 20)).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in text_words(body):
                    for i in range(0, len(w), _STEP):
                        counts[name, w[i : i + _STEP]] = counts.get((name, w[i : i + _STEP]), 0) + 1
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": list(counts.values())})

    words = sample.mapInArrow(cut, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).persist()
    probability = np.full((vocab.size + 1, len(languages)), 1.0 / (vocab.size + 1))
    for _ in range(rounds):
        shared = words.sparkSession.sparkContext.broadcast(probability)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = vocabulary(vocabulary_path)
            for batch in batches:
                names, texts, n = np.array(batch.column(0).to_pylist()), batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for k, name in enumerate(languages):
                    on = np.flatnonzero(names == name)
                    if len(on):
                        uses = expected([texts[i] for i in on], n[on], own, shared.value[:, k])
                        ids = np.flatnonzero(uses)
                        yield pa.RecordBatch.from_pydict({"k": np.full(len(ids), k, np.int32), "piece": ids.astype(np.int32), "uses": uses[ids]})

        sums = words.mapInArrow(count, "k int, piece int, uses double").groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toArrow()
        uses = np.zeros_like(probability)
        uses[sums["piece"].to_numpy(), sums["k"].to_numpy()] = sums["uses"].to_numpy()
        probability = (uses + SMOOTHING) / (uses + SMOOTHING).sum(axis=0)
    words.unpersist()
    return Model(languages, probability)


@shields("lang_pred", "score")
def identify(documents: DataFrame, model: Model, vocabulary_path: str, text: str = "text") -> DataFrame:
    """All columns of `documents` but the text, then lang_pred and score (the language's share of the likelihood).

    Only the text is read. `und` with score 0 where it is NULL, has no letter, or nothing was
    learned; of equal languages the first by name. Repeated rows are judged each; an empty table
    gives no rows; columns named lang_pred or score are replaced.
    """
    fields = [f for f in documents.schema.fields if f.name != text]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, m = vocabulary(vocabulary_path), shared.value
        for batch in batches:
            place = batch.schema.get_field_index(text)
            keep = [k for k in range(batch.num_columns) if k != place]
            first = 0
            while first < batch.num_rows:
                texts, held, n = [], 0, first
                while n < batch.num_rows and held < BATCH_CHARS:
                    texts.append(batch.column(place)[n].as_py() or "")
                    held += len(texts[-1])
                    n += 1
                names, scores = judge(texts, vocab, m)
                out = [batch.column(k).slice(first, n - first) for k in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(out, names=[batch.schema.names[k] for k in keep] + ["lang_pred", "score"])
                first = n

    return documents.mapInArrow(predict, StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def judge(texts: list[str], vocab: Vocabulary, model: Model) -> tuple[list[str], list[float]]:
    ids: dict[str, int] = {}
    lists = [[ids.setdefault(w, len(ids)) for w in text_words(t)] for t in texts]
    if not model.languages or not ids:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    logs = forward(list(ids), vocab, model.probability)
    flat = np.fromiter((i for x in lists for i in x), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in lists])
    total = np.stack([np.bincount(owner, logs[flat, k], len(texts)) for k in range(logs.shape[1])], axis=1)
    best = total.argmax(axis=1)
    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if any(map(str.isalpha, t)) else UNKNOWN for b, t in zip(best, texts, strict=True)]
    return names, [float(s) if n != UNKNOWN else 0.0 for s, n in zip(share, names, strict=True)]


def learns(key: Column, folds: int, out: int) -> Column:
    """True where the fold of the key, crc32 of its text modulo `folds`, isn't the held-out one; a NULL key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds != out, F.lit(True))
