"""Operator 11: alignment of two tokenizers' ids over the same bytes.

The token ends of each tokenizer, as byte offsets, are the keys of a dictionary
to the token's number. The keys that both dictionaries have, sorted, slice both id
lists into groups; within each slice every pair of overlapping tokens is a link. The
unit of all this is the stretch between single spaces, and one met lately is not
aligned again.

How often an id pair is linked is counted over all documents. Documents are
packed into blocks, a table in the shared folder that holds for each document how
often each of the block's pairs occurs in it; blocks exchange their distinct pairs by
hash, and each receives the counts of its own. Pairs that belong to one id spread
over all parts of the exchange; only each part's highest count of each B id is
brought together, in a table no longer than B's vocabulary.
"""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_by_worker, packs, release, rows, spans_of, stage

BLOCK_BYTES = 1 << 22
PIECE = 1 << 20  # characters that are cut into units at a time, about
CACHE = 250_000  # units of each generation of a worker's cache
LONG_UNIT = 200  # characters of a unit that is not worth keeping
PART_PAIRS = 200_000  # pairs of all blocks that meet in one part of the exchange, about
_MIX = np.uint64(0x9E3779B97F4A7C15)

# texts of these characters: the pre-token pattern means the same to both libraries
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ‐-‧€]")
# fixed value: the byte-level tokenizer's pre-token pattern
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Tokenizer A. ``raw`` has the bytes of each id."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are plain text
        special = set(self.whole.get_added_tokens_decoder())
        alphabet = _byte_alphabet()
        vocabulary = self.whole.get_vocab()
        self.raw = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.raw[i] = token.encode() if i in special else bytes(alphabet[c] for c in token)
        ranks = {self.raw[i]: i for i in vocabulary.values() if i not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if _OTHER.search(text):
            return self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.fast.encode_ordinary(text)


class PieceBpe:
    """Tokenizer B, which puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # a text is cut before a space: no piece goes on behind one
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this model goes on behind a space")
        self.raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


#: What the alignment of a stretch of text comes to: how many tokens of A and of B and
#: how many groups it has, the groups as text (``a1,a2|b1;a3|b2,b3``) and its linked id
#: pairs (A's id above 32 bits of B's, 8 bytes each).
Unit = tuple[int, int, int, str, bytes]


class Aligner:
    """Aligns texts by units. A text is cut at its single spaces between other
    characters, where a token of either tokenizer starts whatever stands before, so
    a unit's tokens do not depend on its neighbours. Units not met lately are put
    together with single spaces and aligned as one text. Those met lately are in
    ``recent``, those before in ``older``: when ``recent`` is full it becomes
    ``older``."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a), PieceBpe(path_b)
        self.size_a, self.size_b = (np.array([len(r) for r in t.raw], dtype=np.int64) for t in (self.a, self.b))
        self.shown_a, self.shown_b = ([str(i) for i in range(len(t.raw))] for t in (self.a, self.b))
        self.recent: dict[str, Unit | None] = {}
        self.older: dict[str, Unit | None] = {}

    def align(self, texts: Iterable[bytes]) -> Iterator[list[Unit]]:
        """The units of each text in order; none if a text is empty or the tokens'
        bytes are not the text's."""
        done: list[list[Unit | None]] = []
        held: list[tuple[int, list[str]]] = []  # of a text's number, units to look up
        size = 0
        for i, data in enumerate(texts):
            done.append([])
            try:
                text = data.decode()
            except UnicodeDecodeError:  # no tokenizer gives such bytes back
                done[i].append(None)
                continue
            for piece in self._pieces(text):
                held.append((i, _CUT.split(piece)))
                size += len(piece)
                if size > PIECE:
                    self._look_up(held, done)
                    held, size = [], 0
        self._look_up(held, done)
        for units in done:
            yield [] if None in units else units

    def _pieces(self, text: str) -> Iterator[str]:
        """Bounded pieces of a text, cut between units."""
        at = 0
        while len(text) - at > PIECE:
            cut = _CUT.search(text, at + PIECE)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.end()
        if text:
            yield text[at:]

    def _look_up(self, held: list[tuple[int, list[str]]], done: list[list[Unit | None]]) -> None:
        units = set().union(*(u for _, u in held))
        long = {u for u in units if len(u) > LONG_UNIT}
        kept = dict(self._aligned(long))
        units -= long
        new = units.difference(self.recent)
        if len(self.recent) + len(new) > CACHE:
            self.recent, self.older = {}, self.recent
            new = units
        older = self.older
        self.recent.update({u: older[u] for u in new if u in older})
        self.recent.update(self._aligned(u for u in new if u not in older))
        for i, own in held:
            done[i] += [kept[u] if u in kept else self.recent[u] for u in own] if kept else map(self.recent.__getitem__, own)

    def _aligned(self, units: Iterable[str]) -> Iterator[tuple[str, Unit | None]]:
        """Units with their alignment: plain ones together, so are the others but
        those with white space at an end, which single spaces would run into."""
        together: tuple[list[str], list[str]] = ([], [])
        for u in units:
            if u[:1].isspace() or u[-1:].isspace() or not u:
                yield from self._as_one([u])
            else:
                together[_OTHER.search(u) is not None].append(u)
        for some in together:
            if some:
                yield from self._as_one(some)

    def _as_one(self, units: list[str]) -> Iterator[tuple[str, Unit | None]]:
        text = " ".join(units)
        a, b = self.a.encode(" " + text), self.b.encode(text)
        whole = (" " + text).encode()
        if any(b"".join(map(t.raw.__getitem__, ids)) != whole for t, ids in ((self.a, a), (self.b, b))):
            if len(units) == 1:
                yield units[0], None
            else:  # some unit's bytes are not its tokens': halve until it stands alone
                yield from self._as_one(units[:len(units) // 2])
                yield from self._as_one(units[len(units) // 2:])
            return
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        at_a, at_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        ends_a, ends_b = dict(zip(at_a.tolist(), count(1))), dict(zip(at_b.tolist(), count(1)))
        common = sorted(ends_a.keys() & ends_b.keys())
        shown, i, k = [], 0, 0
        sa, sb = list(map(self.shown_a.__getitem__, a)), list(map(self.shown_b.__getitem__, b))
        for j, m in zip(map(ends_a.__getitem__, common), map(ends_b.__getitem__, common)):
            shown.append(sa[i] + "|" + sb[k] if j - i == 1 == m - k else ",".join(sa[i:j]) + "|" + ",".join(sb[k:m]))
            i, k = j, m
        # within a slice, each stretch of bytes between one token end and the next, whichever
        # tokenizer's, lies in one token of A and one of B, and no two stretches in the same two
        stretch = np.union1d(at_a, at_b)
        links = (ids_a[np.searchsorted(at_a, stretch)] << 32 | ids_b[np.searchsorted(at_b, stretch)]).tobytes()
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        cuts = [spans_of(np.diff(np.searchsorted(x, ends, side="right"), prepend=0)) for x in (at_a, at_b, np.array(common), stretch)]
        n_a, n_b, n_groups, _ = (np.diff(c).tolist() for c in cuts)
        g, n = cuts[2].tolist(), (8 * cuts[3]).tolist()
        yield from zip(units, zip(n_a, n_b, n_groups, (";".join(shown[x:z]) for x, z in zip(g, g[1:])), (links[x:z] for x, z in zip(n, n[1:]))))


_CUT = re.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker process."""
    return Aligner(path_a, path_b)


kept_by_worker("token_align", aligner.cache_clear)


def _zip(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=dtype)


DOC = "keys array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>"
BLOCK = f"block long, {DOC}, n_pairs long, distinct binary, pairs binary, times binary, codes binary"


def _encode(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for keys, held in packs(batches, "key", "text", BLOCK_BYTES):
            counts, digests, found = [], [], []
            for units in tool.align(held):
                n_a, n_b, n_groups, shown, links = zip(*units) if units else ((),) * 5
                pairs = np.frombuffer(b"".join(links), dtype=np.int64)
                counts.append((sum(n_a), sum(n_b), sum(n_groups), len(pairs)))
                digests.append(hashlib.sha256(";".join(shown).encode()).hexdigest() if units else "")
                found.append(np.unique(pairs, return_counts=True))
            codes, own = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            times = np.concatenate([n for _, n in found])
            common = np.argsort(-np.bincount(own, minlength=len(codes)), kind="stable")  # pairs of many documents first: small numbers
            rank = np.empty(len(codes), dtype=np.int64)
            rank[common] = np.arange(len(codes))
            own, at = rank[own], spans_of(np.array([len(c) for c, _ in found]))
            order = np.argsort(np.repeat(np.arange(len(found)), np.diff(at)) * max(len(codes), 1) + own, kind="stable")
            steps = np.diff(own[order], prepend=0)  # small, but at the start of a document
            lists = [pa.array([keys], pa.list_(pa.string())), *(pa.array([list(c)], pa.list_(pa.int64())) for c in zip(*counts)), pa.array([digests], pa.list_(pa.string()))]
            yield pa.record_batch([
                pa.array([uuid.uuid4().int >> 65], pa.int64()), *lists, pa.array([len(codes)], pa.int64()), pa.array([_zip(np.diff(at))]),
                pa.array([_zip(steps.astype(np.int32))]), pa.array([_zip(times[order].astype(np.uint32))]), pa.array([_zip(codes[common])])],
                names=[c.split()[0] for c in BLOCK.split(", ")])
        release()
    return run


class Counts:
    """A block's documents as (pair numbers, times), end to end."""

    def __init__(self, row: dict):
        self.at = spans_of(_unzip(row["distinct"], np.int64))
        self.pairs = np.cumsum(_unzip(row["pairs"], np.int32), dtype=np.int64)
        self.times = _unzip(row["times"], np.uint32).astype(np.int64)
        self.codes = _unzip(row["codes"], np.int64)

    def totals(self) -> np.ndarray:
        return np.bincount(self.pairs, weights=self.times, minlength=len(self.codes)).astype(np.int64)

    def per_document(self, value: np.ndarray) -> np.ndarray:
        """Sum of value[pair] * times of each document; exact in integers."""
        return np.diff(spans_of(value[self.pairs] * self.times)[self.at])


def _dealt(codes: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its pairs in order of their codes)."""
    h = codes.astype(np.uint64) * _MIX
    part = (h >> np.uint64(40)) % np.uint64(parts)
    order = np.lexsort((codes, part))
    own, cut = np.unique(part[order], return_index=True)
    cut = [*cut.tolist(), len(order)]
    for p, i, j in zip(own.tolist(), cut, cut[1:]):
        yield p, order[i:j]


SENT = "part long, block long, codes binary, count binary"


def _send(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            block = Counts(row)
            total = block.totals()
            sent = [(p, block.codes[i], total[i]) for p, i in _dealt(block.codes, parts)]
            yield pa.record_batch([
                pa.array([p for p, _, _ in sent], pa.int64()), pa.array([row["block"]] * len(sent), pa.int64()),
                pa.array([_zip(np.diff(c, prepend=0)) for _, c, _ in sent], pa.binary()), pa.array([_zip(n) for _, _, n in sent], pa.binary())],
                names=[c.split()[0] for c in SENT.split(", ")])
    return run


COUNTED = "block long, part long, count binary, best_ids binary, best binary"


def _add_up(table: pa.Table) -> pa.Table:
    """Corpus counts of each block's pairs of one part; on the first row, the
    highest of each B id within the part."""
    codes = [np.cumsum(_unzip(x, np.int64)) for x in table["codes"].to_pylist()]
    own = np.concatenate([_unzip(x, np.int64) for x in table["count"].to_pylist()])
    known, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(known), dtype=np.int64)
    np.add.at(total, inverse, own)
    ids, place = np.unique(known & 0xFFFFFFFF, return_inverse=True)
    best = np.zeros(len(ids), dtype=np.int64)
    np.maximum.at(best, place, total)
    pieces = np.split(total[inverse], np.cumsum([len(c) for c in codes])[:-1])
    n = len(pieces) - 1
    return pa.table({"block": table["block"], "part": table["part"], "count": pa.array([_zip(x) for x in pieces], pa.binary()),
                     "best_ids": pa.array([ids.tobytes(), *[None] * n], pa.binary()), "best": pa.array([best.tobytes(), *[None] * n], pa.binary())})


def _best_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows(batches):
        yield pa.record_batch([pa.array(np.frombuffer(row[c], dtype=np.int64)) for c in ("best_ids", "best")], names=["b", "best"])


ALIGNED = "key string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _score(parts: int, best: np.ndarray):
    """Documents of a block, from the corpus counts of its pairs and the highest
    count of each B id."""
    def run(key: tuple, blocks: pa.Table, counted: pa.Table) -> pa.Table:
        found = {r["part"]: r["count"] for r in rows(counted.to_batches())}
        row = next(rows(blocks.to_batches()))
        block = Counts(row)
        count = np.zeros(len(block.codes), dtype=np.int64)
        for p, i in _dealt(block.codes, parts):
            count[i] = _unzip(found[p], np.int64)
        is_best = (count == best[block.codes & 0xFFFFFFFF]).astype(np.int64)
        return pa.table({"key": pa.array(row["keys"], pa.string()), **{c: pa.array(row[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": block.per_document(is_best), "count_sum": block.per_document(count), "groups_sha256": pa.array(row["digests"], pa.string())})
    return run


def align_texts(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one
    row per input row: tokens, groups and links of each text by the byte-level
    tokenizer file ``path_a`` (a space put before the text) and the piece model
    ``path_b``; links whose id pair is as frequent over all rows as any pair of
    its B id; the links' pairs' frequencies added up.

    Texts are aligned whole. Null and empty texts, and texts that either
    tokenizer does not give back byte for byte, have no tokens: zeros and an
    empty digest. Rows that repeat a key, or have none, are rows like any other.
    Other columns are not read; no rows: no rows.
    """
    keyed = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    blocks = stage(keyed.mapInArrow(_encode(path_a, path_b), BLOCK), "align-blocks")
    # as many parts as the blocks' pairs fill to about PART_PAIRS each
    parts = int((blocks.agg(F.sum("n_pairs")).first()[0] or 0) // PART_PAIRS) + 1
    counted = stage(blocks.mapInArrow(_send(parts), SENT).groupBy("part").applyInArrow(_add_up, COUNTED), "align-counts")
    highest = (counted.where("best_ids is not null").select("best_ids", "best").mapInArrow(_best_rows, "b long, best long")
               .groupBy("b").agg(F.max("best").alias("best")).collect())  # at most B's vocabulary
    best = np.zeros(max((r["b"] for r in highest), default=0) + 1, dtype=np.int64)
    best[[r["b"] for r in highest]] = [r["best"] for r in highest]
    out = blocks.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_score(parts, best), ALIGNED)
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)


GROUPS = "key string, place long, a array<int>, b array<int>, bytes binary"


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, place, a, b, bytes): the groups of each text in order, with the ids of
    both tokenizers and the bytes they stand for (the first ones begin with the
    space before the text). Texts without tokens have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for keys, held in packs(batches, "key", "text", BLOCK_BYTES):
            for k, units in zip(keys, tool.align(held), strict=True):
                first = 0
                for at in range(0, len(units), 20_000):
                    some = units[at:at + 20_000]
                    groups = [[list(map(int, side.split(","))) for side in g.split("|")] for u in some for g in u[3].split(";")]
                    yield pa.record_batch([
                        pa.array([k] * len(groups), pa.string()), pa.array(range(first, first + len(groups)), pa.int64()),
                        pa.array([a for a, _ in groups], pa.list_(pa.int32())), pa.array([b for _, b in groups], pa.list_(pa.int32())),
                        pa.array([b"".join(map(tool.a.raw.__getitem__, a)) for a, _ in groups], pa.binary())],
                        names=[c.split()[0] for c in GROUPS.split(", ")])
                    first += len(groups)

    keyed = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    out = keyed.mapInArrow(run, GROUPS)
    return out.withColumn("key", F.col("key").cast(docs.schema[key].dataType)).withColumnRenamed("key", key)
