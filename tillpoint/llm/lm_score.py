"""Operator 10: language-model scores by a weighted backoff automaton.

The model is a smoothed bigram model as an automaton: a state for each word
(and one for the start of a text), an arc for each bigram seen in training, and
from every state a failure arc, with its own weight, to the root, whose arcs are
the unigrams. A text is one walk from left to right that carries the state and
adds up log-probabilities.

    p(w | h) = (1 - b) c(h w) / c(h) + b p(w),   p(w) = (c(w) + 1) / (N + V + 1)

so the arc (h, w) weighs log10 p(w | h) and the failure arc of h log10 b. b
depends on the size class of c(h) (powers of two) and is fitted by expectation
maximisation on training bigrams with their own count left out, from histograms
of fixed size.

The automaton grows with the corpus and is never whole in one place: texts are
packed into blocks, a table in the shared folder; the blocks exchange their
distinct n-grams, counts are added up by hash, and each block receives the
counts of its own n-grams, which is the part of the automaton its texts can
reach. Words and bigrams are told apart by 64 bits of hash; a part of the exchange
is a range of hashes, so that a block's sorted hashes are sent as small steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, packs, partitions, rows, spans_of, stage

BLOCK_BYTES = 1 << 22
CLASSES = 40  # size classes of c(h)
BINS, _EDGE = 96, 12.0  # of log2(p_ml / p(w)) from -12 to 12; one more bin has p_ml = 0
START = np.uint64(0x5354415254)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_END = b" "  # no word holds a space
SPACE = b" \t\n\r\x0b\x0c"
PIECE = 1 << 22


def _zip(x: np.ndarray, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=dtype)


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Words of an A-Z lower-cased text, in bounded pieces cut at white space."""
    data, at = data.lower(), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACE:
            end += 1
        yield data[at:end].split()
        at = end


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, held in packs(batches, "key", "text", BLOCK_BYTES):
        index: dict[bytes, int] = {_END: 0}
        texts = []
        for text in held:
            ids = [np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.uint32, count=len(words)) for words in _words(text)]
            texts.append(np.concatenate([*ids, np.zeros(1, dtype=np.uint32)]))
        tokens = np.concatenate(texts)
        counts = np.bincount(tokens, minlength=len(index))
        order = np.argsort(-counts, kind="stable")  # frequent words first: small numbers compress
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), dtype=np.uint64, count=len(index))[order]
        yield pa.record_batch([
            pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([[k["doc"] for k in keys]], pa.list_(pa.int64())),
            pa.array([[k["train"] for k in keys]], pa.list_(pa.bool_())), pa.array([_zip(np.array([len(t) for t in texts], dtype=np.int64))]),
            pa.array([_zip(rank[tokens])]), pa.array([len(index)], pa.int64()), pa.array([_zip(hashes)])],
            names=["block", "docs", "train", "sizes", "tokens", "v", "words"])


BLOCK = "block long, docs array<long>, train array<boolean>, sizes binary, tokens binary, v long, words binary"


class Block:
    """Texts as word numbers; ``words`` has the words' hashes (none once the
    counts are there). Number 0 to v - 1 are words (the end token among them),
    v is the start state."""

    def __init__(self, row: dict):
        self.docs, self.train = row["docs"], np.array(row["train"], dtype=bool)
        self.at = spans_of(_unzip(row["sizes"], np.int64))
        self.tokens = _unzip(row["tokens"], np.uint32).astype(np.int64)
        self.words = _unzip(row["words"], np.uint64)
        self.v = row["v"]
        before = np.empty(len(self.tokens), dtype=np.int64)
        before[1:] = self.tokens[:-1]
        before[self.at[:-1]] = self.v
        self.before = before
        self.learn = np.repeat(self.train, np.diff(self.at))

    def unigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, training counts) of the words and, last, the start."""
        counts = np.bincount(self.tokens[self.learn], minlength=self.v + 1)
        counts[self.v] = self.train.sum()
        h = np.append(self.words, START) * _MIX
        return h ^ (h >> np.uint64(31)), counts

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct pairs before * v + word, number of each token's)."""
        return np.unique(self.before * self.v + self.tokens, return_inverse=True)

    def bigram_hashes(self, pairs: np.ndarray) -> np.ndarray:
        h = np.append(self.words, START)[pairs // self.v] * _MIX
        h = (h ^ (h >> np.uint64(29))) + self.words[pairs % self.v]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(31))


def _grouped(h: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its n-grams in hash order). Parts are ranges of hashes."""
    order = np.argsort(h, kind="stable")
    part = ((h[order] >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)
    own, cut = np.unique(part, return_index=True)
    cut = [*cut.tolist(), len(order)]
    for p, a, z in zip(own.tolist(), cut, cut[1:]):
        yield p, order[a:z]


def _steps(h: np.ndarray) -> bytes:
    """Sorted hashes as the steps between them, byte by byte: the high bytes of
    small steps are zeros, which compress."""
    return _zip(np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T, 1)


def _from_steps(x: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(_unzip(x, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


SENT = "part int, block long, n int, grams binary, count binary"


def _send(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            b = Block(row)
            pairs, inverse = b.bigrams()
            grams = {1: b.unigrams(), 2: (b.bigram_hashes(pairs), np.bincount(inverse[b.learn], minlength=len(pairs)))}
            for n, (h, counts) in grams.items():
                sent = [(p, h[i], counts[i]) for p, i in _grouped(h, parts)]
                yield pa.record_batch([
                    pa.array([p for p, _, _ in sent], pa.int32()), pa.array([row["block"]] * len(sent), pa.int64()), pa.array([n] * len(sent), pa.int32()),
                    pa.array([_steps(v) for _, v, _ in sent], pa.binary()),
                    pa.array([_zip(c.astype(np.uint32), 1) for _, _, c in sent], pa.binary())], names=[c.split()[0] for c in SENT.split(", ")])
    return run


COUNTED = "block long, part int, n int, count binary, types long"


def _add_up(table: pa.Table) -> pa.Table:
    """Global counts of each block's n-grams of one part and order; ``types``
    (on the first row) is how many distinct ones training has."""
    sent = [_from_steps(x) for x in table["grams"].to_pylist()]
    value = np.concatenate(sent)
    own = np.concatenate([_unzip(x, np.uint32) for x in table["count"].to_pylist()]).astype(np.int64)
    _, inverse = np.unique(value, return_inverse=True)
    total = np.zeros(inverse.max() + 1, dtype=np.int64)
    np.add.at(total, inverse, own)
    pieces = np.split(total[inverse], np.cumsum([len(x) for x in sent])[:-1])
    types = [int((total > 0).sum())] + [0] * (len(pieces) - 1)
    return pa.table({"block": table["block"], "part": table["part"], "n": table["n"],
                     "count": pa.array([_zip(x) for x in pieces], pa.binary()), "types": pa.array(types, pa.int64())})


def _joined(parts: int):
    """Blocks with the global counts of their words and distinct bigrams."""
    def run(key: tuple, blocks: pa.Table, counted: pa.Table) -> pa.Table:
        held = list(rows(blocks.to_batches()))  # one
        found: dict = {1: {}, 2: {}}
        for r in rows(counted.to_batches()):
            found[r["n"]][r["part"]] = r["count"]
        for row in held:
            b = Block(row)
            pairs, _ = b.bigrams()
            for n, h in ((1, b.unigrams()[0]), (2, b.bigram_hashes(pairs))):
                counts = np.zeros(len(h), dtype=np.int64)
                for p, i in _grouped(h, parts):
                    counts[i] = _unzip(found[n][p], np.int64)
                row[f"c{n}"] = _zip(counts)
            row["words"] = _zip(np.empty(0, dtype=np.uint64))
        names = [c.split()[0] for c in BLOCK.split(", ")]
        out = {c: [r[c] for r in held] for c in [*names, "c1", "c2"]}
        types = {"block": pa.int64(), "v": pa.int64(), "docs": pa.list_(pa.int64()), "train": pa.list_(pa.bool_())}
        return pa.table({c: pa.array(v, types.get(c, pa.binary())) for c, v in out.items()})
    return run


def _size_class(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64), CLASSES - 1)


def _histogram(n_tokens: int, n_types: int):
    """Training bigrams by size class and log2 ratio of p_ml, own count left
    out, to p(w)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist = np.zeros((CLASSES, BINS + 1))
        for row in rows(batches):
            b, c1, c2 = Block(row), _unzip(row["c1"], np.int64), _unzip(row["c2"], np.int64)
            pairs, inverse = b.bigrams()
            own = np.bincount(inverse[b.learn], minlength=len(pairs))
            use = np.flatnonzero(own)
            h, w = pairs[use] // b.v, pairs[use] % b.v
            ch = c1[h]
            ratio = (c2[use] - 1) / np.maximum(ch - 1, 1) / ((c1[w] + 1) / (n_tokens + n_types + 1))
            with np.errstate(divide="ignore"):
                log = np.log2(ratio)
            bin_ = np.where(ratio > 0, np.clip((np.where(ratio > 0, log, 0) + _EDGE) * BINS / (2 * _EDGE), 0, BINS - 1), BINS).astype(np.int64)
            np.add.at(hist, (_size_class(ch), bin_), own[use])
        size, bin_ = np.nonzero(hist)
        yield pa.record_batch([pa.array(size), pa.array(bin_), pa.array(hist[size, bin_].astype(np.int64))], names=["size", "bin", "n"])
    return run


def fit_backoff(hist: np.ndarray, steps: int = 60) -> np.ndarray:
    """b of each size class: expectation maximisation on the histogram."""
    ratio = np.append(2.0 ** ((np.arange(BINS) + 0.5) * (2 * _EDGE) / BINS - _EDGE), 0.0)
    b = np.full((CLASSES, 1), 0.5)
    total = hist.sum(axis=1, keepdims=True) + 2  # one imagined event on each side
    for _ in range(steps):
        b = ((hist * (b / (b + (1 - b) * ratio))).sum(axis=1, keepdims=True) + 1) / total
    return np.clip(b[:, 0], 1e-4, 1 - 1e-9)


def walk(b: Block, c1: np.ndarray, c2: np.ndarray, n_tokens: int, n_types: int, backoff: np.ndarray) -> np.ndarray:
    """log10 probability of each text: all texts of the block take a step of
    their walk at a time, carrying their states."""
    pairs, _ = b.bigrams()
    root = np.log10((c1[:b.v] + 1) / (n_tokens + n_types + 1))
    state_b = np.append(np.where(c1[:b.v] > 0, backoff[_size_class(c1[:b.v])], 1.0), backoff[_size_class(c1[b.v:])] if c1[b.v] else 1.0)
    failure = np.log10(state_b)  # an unseen state falls to the root at no cost
    arcs = pairs[c2 > 0]  # state * v + word, in order
    h, w = arcs // b.v, arcs % b.v
    weight = np.log10((1 - state_b[h]) * c2[c2 > 0] / np.maximum(c1[h], 1) + state_b[h] * 10 ** root[w])
    lengths = np.diff(b.at)
    order = np.argsort(-lengths, kind="stable")
    first = b.at[:-1][order]
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(int(lengths.max(initial=0))), side="right")
    state, total = np.full(len(order), b.v), np.zeros(len(order))
    for t, n in enumerate(active):
        word = b.tokens[first[:n] + t]
        arc = state[:n] * b.v + word
        i = np.searchsorted(arcs, arc)
        i[i == len(arcs)] = 0
        seen = arcs[i] == arc if len(arcs) else np.zeros(n, dtype=bool)
        total[:n] += np.where(seen, weight[i] if len(arcs) else 0.0, failure[state[:n]] + root[word])
        state[:n] = word
    out = np.empty(len(order))
    out[order] = total
    return out


def _score(n_tokens: int, n_types: int, backoff: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            b, c1, c2 = Block(row), _unzip(row["c1"], np.int64), _unzip(row["c2"], np.int64)
            c = c1[b.tokens]
            base = np.add.reduceat(np.log10((c + 1) / (n_tokens + n_types + 1)), b.at[:-1])
            known = np.add.reduceat((c > 0).astype(np.int64), b.at[:-1])
            yield pa.record_batch([
                pa.array(b.docs, pa.int64()), pa.array(b.train), pa.array(np.diff(b.at)), pa.array(known), pa.array(np.full(len(b.docs), n_tokens)),
                pa.array(base), pa.array(walk(b, c1, c2, n_tokens, n_types, backoff))],
                names=["doc", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", mod: int = 7, held: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score), one
    row per input row.

    Rows whose crc32(key as text) modulo ``mod`` is not ``held`` are learned
    from, all are scored, whole. A-Z lower-cased; words are what white space
    parts, then one end token. Null and empty texts are the end token alone.
    Rows with a null key are scored and not learned from (held_out null); rows
    that repeat a key are learned from each time. Without training rows every
    token has the add-one probability of an empty corpus (1). Other columns
    are not read; no rows: no rows.
    """
    spark = docs.sparkSession
    train = F.coalesce(crc_mod(key, mod) != held, F.lit(False))
    keyed = docs.select(F.struct(F.col(key).cast("long").alias("doc"), train.alias("train")).alias("key"), F.col(text).alias("text"))
    blocks = stage(keyed.mapInArrow(_encode, BLOCK), "lm-blocks")
    parts = 4 * partitions(spark)  # several to a partition, so that they even out
    counted = stage(blocks.mapInArrow(_send(parts), SENT).groupBy("part", "n").applyInArrow(_add_up, COUNTED), "lm-counts")
    model = stage(blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_joined(parts), BLOCK + ", c1 binary, c2 binary"), "lm-model")
    n_types = counted.where("n = 1").agg(F.sum("types")).first()[0] or 0
    n_tokens = model.mapInArrow(_training_tokens, "n long").agg(F.sum("n")).first()[0] or 0
    # the start state is counted among the one-grams; it is no token
    starts = model.where(F.exists("train", lambda t: t)).limit(1).count()
    n_types -= starts
    hist = np.zeros((CLASSES, BINS + 1))
    for r in model.mapInArrow(_histogram(n_tokens, n_types), "size long, bin long, n long").groupBy("size", "bin").agg(F.sum("n").alias("n")).collect():
        hist[r["size"], r["bin"]] = r["n"]  # CLASSES * (BINS + 1) rows at most
    out = model.mapInArrow(_score(n_tokens, n_types, fit_backoff(hist)),
                           "doc long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select(F.col("doc").alias(key), F.when(F.col("doc").isNotNull(), ~F.col("train")).alias("held_out"),
                      "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _training_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [int(np.diff(spans_of(_unzip(s.as_py(), np.int64)))[np.array(t.as_py(), dtype=bool)].sum()) for s, t in zip(batch.column("sizes"), batch.column("train"))]
        yield pa.record_batch([pa.array(n, pa.int64())], names=["n"])
