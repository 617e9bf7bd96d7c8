"""Operator 4: toxic spans by a linear-chain conditional random field.

Two states (clean, toxic) over the words of a text. A word's features are
itself and its beginnings of four to six letters, restricted to a lexicon whose
members are significantly more frequent in toxic documents. Training tokens are
labelled toxic where a toxic document uses the lexicon. Forward-backward runs
over many texts at once, one numpy step per word position. The marginals give
offending character spans, and by a small logistic model the document's score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packs, release, spans_of, stage, turn_to

_WORD = re.compile(r"\w+")
BATCH_BYTES = 1 << 22
CACHE = 150_000


def features(word: str) -> list[str]:
    """The word, and its beginnings where it is longer."""
    return ["=" + word] + [word[:n] for n in (4, 5, 6) if len(word) > n]


@dataclass
class Crf:
    """Weights: a bias and lexicon weights for the toxic state, transitions
    [from, to], and the document model on (1, largest log-odds, log of the
    expected toxic words)."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: np.ndarray = field(default_factory=lambda: np.array([-3.0, 0.0, 0.0]))

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def _columns(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by falling length, and how many are longer than each position."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, active


def log_odds(emission: np.ndarray, at: np.ndarray, T: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log-odds of the toxic state for each word of texts
    laid end to end (offsets ``at``), and the words' log-odds given the text."""
    lengths = np.diff(at)
    order, active = _columns(lengths)
    first = at[:-1][order]
    fwd, bwd = np.empty(len(emission)), np.zeros(len(emission))
    prev = np.empty(0)
    for t, n in enumerate(active):
        i = first[:n] + t
        prev = emission[i] if t == 0 else emission[i] + np.logaddexp(T[0, 1], T[1, 1] + prev[:n]) - np.logaddexp(T[0, 0], T[1, 0] + prev[:n])
        fwd[i] = prev
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        i = first[:n] + t
        ahead = emission[i + 1] + bwd[i + 1]
        bwd[i] = np.logaddexp(T[1, 0], T[1, 1] + ahead) - np.logaddexp(T[0, 0], T[0, 1] + ahead)
    return fwd, bwd, fwd + bwd


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def document_inputs(odds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(1, largest log-odds, log of expected toxic words) of each text."""
    n, full = len(at) - 1, np.diff(at) > 0
    out = np.zeros((n, 3))
    out[:, 0] = 1
    out[:, 1] = -10
    if full.any():
        out[full, 1] = np.clip(np.maximum.reduceat(odds, at[:-1][full]), -10, 10)
        out[full, 2] = np.log1p(np.add.reduceat(_sigmoid(odds), at[:-1][full]))
    return out


class Emissions(dict):
    """Emission of each word met by a task, computed once; bounded."""

    def __init__(self, crf: Crf):
        super().__init__()
        self.crf = crf

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = self.crf.emission(word)
        return value


class Listed(dict):
    """Whether a word has a feature of the lexicon; bounded."""

    def __init__(self, index: dict):
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> bool:
        if len(self) >= CACHE:
            self.clear()
        value = self[word] = any(f in self.index for f in features(word))
        return value


def _laid_out(texts: Iterable[bytes], value: Callable[[str], float]) -> tuple[np.ndarray, np.ndarray]:
    rows = [np.fromiter(map(value, _WORD.findall(t.decode().lower())), dtype=np.float64) for t in texts]
    return np.concatenate([np.empty(0), *rows]), spans_of(np.array([len(r) for r in rows], dtype=np.int64))


def _toxic_spans(text: str, toxic: np.ndarray) -> list[dict]:
    """Character ranges, in ``text`` as it stands, of neighbouring toxic words.
    Words are those of the lowered text; where lower-casing makes several
    characters of one, each of them stands for that one."""
    out: list[dict] = []
    low = text.lower()
    place = None
    if len(low) != len(text):
        place = [i for i, c in enumerate(text) for _ in c.lower()]
        # only a final sigma depends on its neighbours, and it is one character in any case
    last = -2
    for i, m in enumerate(_WORD.finditer(low)):
        if toxic[i]:
            start, end = (m.start(), m.end()) if place is None else (place[m.start()], place[m.end() - 1] + 1)
            if last == i - 1:
                out[-1]["end"] = end
            else:
                out.append({"start": start, "end": end})
            last = i
    return out


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn_to()
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def rows() -> pa.RecordBatch:
        names = list(counts[0].keys() | counts[1].keys())
        out = pa.record_batch([pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]], names=["f", "clean", "toxic"])
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for t, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[y].update({f for w in set(_WORD.findall((t or "").lower())) for f in features(w)})
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield rows()
    yield rows()


def learn_lexicon(sample: DataFrame, max_features: int) -> list[str]:
    """Features whose document frequency is higher in toxic documents by a
    log-likelihood ratio beyond what the number of features explains."""
    total = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = total.get(0, 0), total.get(1, 0)
    if not n0 or not n1:
        return []
    counts = stage(sample.select("text", "toxic").mapInArrow(_count_features, "f string, clean long, toxic long")
                   .groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 3"), "features")
    limit = 2 * math.log(max(counts.count(), 2) * 10)
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    share = (a + b) / (n0 + n1)

    def term(x, n):
        return F.when(x > 0, x * F.log(x / (share * n))).otherwise(0.0)

    g = 2 * (term(a, n1) + term(b, n0))
    best = (counts.withColumn("g", g).where((a / n1 > 4 * (b + 0.5) / n0) & (F.col("g") > limit))
            .orderBy(F.desc("g"), "f").limit(max_features))
    return [r["f"] for r in best.select("f").collect()]


def _gradient(crf: Crf, names: list[str]):
    """Log-likelihood gradient of the words' labels, summed over a task."""
    index = {f: i + 5 for i, f in enumerate(names)}  # 0 bias, 1-4 transitions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        grad = np.zeros(5 + len(names))
        emission, listed = Emissions(crf), Listed(index)
        for labels, held in packs(batches, "toxic", "text", BATCH_BYTES):
            words = [_WORD.findall(t.decode().lower()) for t in held]
            at = spans_of(np.array([len(w) for w in words], dtype=np.int64))
            flat = [w for ws in words for w in ws]
            E = np.fromiter(map(emission.__getitem__, flat), dtype=np.float64, count=len(flat))
            marked = np.fromiter(map(listed.__getitem__, flat), dtype=bool, count=len(flat))
            y = marked & np.repeat(np.array(labels, dtype=bool), np.diff(at))
            fwd, bwd, odds = log_odds(E, at, crf.transitions)
            miss = y - _sigmoid(odds)
            grad[0] += miss.sum()
            for i in np.flatnonzero(marked):
                for f in features(flat[i]):
                    if f in index:
                        grad[index[f]] += miss[i]
            inner = np.ones(max(len(flat) - 1, 0), dtype=bool)
            edges = at[1:-1] - 1
            inner[edges[(edges >= 0) & (edges < len(inner))]] = False
            left = np.flatnonzero(inner)
            w = np.stack([i * fwd[left] + crf.transitions[i, j] + j * (E[left + 1] + bwd[left + 1]) for i in (0, 1) for j in (0, 1)])
            p = np.exp(w - np.logaddexp.reduce(w, axis=0))
            for k, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
                grad[1 + k] += ((y[left] == i) & (y[left + 1] == j)).sum() - p[k].sum()
        yield pa.record_batch([pa.array([grad.tobytes()], pa.binary())], names=["g"])
    return run


def train(sample: DataFrame, max_features: int = 4000, steps: int = 12) -> Crf:
    """Fit a CRF on ``sample`` (text, toxic); every gradient is one Spark job.
    Without both classes the model scores everything clean."""
    names = learn_lexicon(sample, max_features)
    crf = Crf(weights={f: 3.0 for f in names}, transitions=np.array([[0.0, -1.0], [0.0, 0.0]]))
    theta = np.concatenate([[crf.bias], crf.transitions.ravel(), np.full(len(names), 3.0)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1 if names else 1):
        # a task's gradient is as long as the lexicon, which is bounded
        parts = sample.mapInArrow(_gradient(crf, names), "g binary").collect()
        grad = sum(np.frombuffer(bytes(r["g"])) for r in parts) - 0.01 * theta
        m, v = 0.8 * m + 0.2 * grad, 0.9 * v + 0.1 * grad * grad
        theta = theta + 0.4 * (m / (1 - 0.8 ** step)) / (np.sqrt(v / (1 - 0.9 ** step)) + 1e-6)
        crf = Crf(dict(zip(names, theta[5:].tolist())), float(theta[0]), theta[1:5].reshape(2, 2))

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        emission = Emissions(crf)
        for labels, held in packs(batches, "toxic", "text", BATCH_BYTES):
            E, at = _laid_out(held, emission.__getitem__)
            x = document_inputs(log_odds(E, at, crf.transitions)[2], at)
            yield pa.record_batch([pa.array(labels, pa.int32()), pa.array(x[:, 1]), pa.array(x[:, 2])], names=["y", "a", "b"])

    if names:  # three numbers for each of the bounded sample's documents
        rows = sample.mapInArrow(inputs, "y int, a double, b double").toPandas()
        X, y = np.column_stack([np.ones(len(rows)), rows["a"], rows["b"]]), rows["y"].to_numpy(dtype=float)
        beta = np.zeros(3)
        for _ in range(30):
            p = _sigmoid(X @ beta)
            H = (X * (p * (1 - p))[:, None]).T @ X + np.diag([1e-3, 1e-1, 1e-1])
            beta = beta + np.linalg.solve(H, X.T @ (y - p) - np.array([1e-3, 1e-1, 1e-1]) * beta)
        crf.document = beta
    return crf


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_docs: int) -> DataFrame:
    """(text, toxic) of at most ``max_docs`` labelled documents, chosen by a
    hash of their key; the larger label where a key has several."""
    marked = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("toxic")).where("k is not null and toxic in (0, 1)")
              .groupBy("k").agg(F.max("toxic").alias("toxic")))
    ids = docs.select(F.col(key).alias("k")).where("k is not null").distinct()
    chosen = stage(marked.join(ids, "k").orderBy(F.xxhash64("k"), "k").limit(max_docs), "labelled")  # max_docs rows at most
    # rows that repeat a key are one labelled document
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")
    return stage(found.groupBy("k").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic"), "sample")


def _slices(batch: pa.RecordBatch, column: int, max_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch of about ``max_bytes`` of text, and their texts."""
    held = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    size = np.cumsum([len(t) for t in held]) // max_bytes
    cuts = np.flatnonzero(np.diff(size, prepend=-1, append=-1))
    for a, z in zip(cuts.tolist(), cuts[1:].tolist()):
        yield batch.slice(a, z - a), held[a:z]


TAGS = "score double, predicted int, n_toxic long, spans array<struct<start: int, end: int>>"


def score(docs: DataFrame, crf: Crf, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted, n_toxic, spans), one row per input row.

    ``score`` is 0 to 1, ``predicted`` 1 from 0.5 on, ``n_toxic`` the words
    with a marginal of at least 0.5 and ``spans`` the character ranges
    (start, end) of neighbouring ones. Null and empty texts have no words and
    get the model's score for that. Null and repeated keys keep their rows;
    other columns are not read.
    """
    return tag(docs.select(key, text), crf, text).drop(text)


def tag(docs: DataFrame, crf: Crf, text: str = "text") -> DataFrame:
    """``docs``, all its columns, with those of ``score``. A column of ``docs``
    that has the name of one of them is an error that names it."""
    clash = sorted({c.lower() for c in docs.columns} & {"score", "predicted", "n_toxic", "spans"})
    if clash:
        raise ValueError(f"columns that the tags would repeat: {clash}; rename them before")
    column = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to()
        emission = Emissions(crf)
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for batch, held in _slices(whole, column, BATCH_BYTES):
                E, at = _laid_out(held, emission.__getitem__)
                odds = log_odds(E, at, crf.transitions)[2]
                p = _sigmoid(document_inputs(odds, at) @ crf.document)
                n = np.diff(spans_of(odds >= 0)[at])
                spans = [_toxic_spans(held[i].decode(), odds[at[i]:at[i + 1]] >= 0) if n[i] else [] for i in range(len(held))]
                yield pa.record_batch([*batch.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(spans, spans_type)],
                                      names=[*batch.schema.names, "score", "predicted", "n_toxic", "spans"])
                del E, odds, held
        release()

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{columns}, {TAGS}")
