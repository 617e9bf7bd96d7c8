"""Operator 5: exact repeated-substring removal by a common-prefix-aware
distributed merge sort of suffixes.

Every ``length``-byte string holds an anchor: the K-byte gram with the smallest
hash among its grams. Equal strings have their anchors at the same place, so
only suffixes that start at anchors need sorting (about one byte in 18), and of
these only the ones whose gram occurs in two documents.

1. Documents are packed into blocks, a table in the shared folder.
2. Blocks exchange their anchors' gram hashes; grams of one document drop out.
3. Each block sorts the remaining suffixes and sends them as front-coded runs
   (length of the prefix shared with the one before, then the rest), with the
   bytes left of the anchor and the smallest document of equal entries.
4. A loser tree merges the runs of all blocks. It keeps the prefix lengths
   shared with the last winner, so known prefixes are never compared again.
5. The merged order and its shared prefixes give, for each place of the anchor
   within a string, the smallest document that has the string. The blocks
   receive these and cut their documents.

Equality is decided on bytes to the right and a 64-bit hash of at most 34 bytes
to the left; hashes otherwise only choose candidates.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, packs, partitions, rows, spans_of, stage

K = 16
BLOCK_BYTES = 1 << 23
CHUNK = 1 << 20
NONE = np.iinfo(np.int64).max
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = np.random.default_rng(16).integers(1, 1 << 63, 256, dtype=np.uint64)


def _zip(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unzip(x: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), dtype=dtype)


def _slide(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over windows of ``width``, by doubling."""
    done = 1
    while 2 * done <= width:
        x = of(x[:-done], x[done:])
        done *= 2
    if done < width:
        x = of(x[:len(x) - (width - done)], x[width - done:])
    return x


def find_anchors(T: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Anchor positions in texts laid end to end (offsets ``at``): the grams
    of smallest hash (all that tie) in any ``length``-byte string."""
    n, w = len(T), length - K + 1
    if n < length:
        return np.empty(0, dtype=np.int64)
    h = _TABLE[T]
    step = 1
    while step < K:  # hash of 2, 4, 8, 16 bytes
        h = h[:len(h) - step] * (_MIX + np.uint64(2 * step)) + h[step:]
        step *= 2
    h = (h ^ (h >> np.uint64(31))) * _MIX | np.uint64(1)
    low = _slide(h, w, np.minimum)  # of the string that starts there
    starts = np.zeros(len(low) + 1, dtype=np.int32)
    # strings must end within their text
    np.add.at(starts, np.minimum(at[:-1], len(low)), 1)
    np.add.at(starts, np.minimum(np.maximum(at[1:] - length + 1, at[:-1]), len(low)), -1)
    low = np.where(np.cumsum(starts[:-1]) > 0, low, np.uint64(0))
    pad = np.zeros(w - 1, dtype=np.uint64)
    high = _slide(np.concatenate([pad, low, pad]), w, np.maximum)  # over the strings that hold the gram
    return np.flatnonzero(high == h)


def _pack_blocks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, held in packs(batches, "doc", "text", BLOCK_BYTES):
            sizes = np.array([len(t) for t in held], dtype=np.int64)
            at = spans_of(sizes)
            # documents of a null key take no part
            known = np.array([k is not None for k in keys])
            found, i = [np.empty(0, dtype=np.int64)], 0
            while i < len(held):
                j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, side="right")) - 1)
                T = np.frombuffer(b"".join(held[i:j]), dtype=np.uint8)
                own = find_anchors(T, at[i:j + 1] - at[i], length)
                found.append(own + at[i])
                i = j
            anchors = np.concatenate(found)
            anchors = anchors[known[np.searchsorted(at, anchors, side="right") - 1]]
            ids = np.array([k if k is not None else 0 for k in keys], dtype=np.int64)
            yield pa.record_batch([
                pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([_zip(ids)]), pa.array([_zip(known)]), pa.array([_zip(sizes)]),
                pa.array([_zip(np.diff(anchors, prepend=0).astype(np.uint32))]),
                pa.array([zstandard.ZstdCompressor(level=3).compress(b"".join(held))])],
                names=["block", "ids", "known", "sizes", "anchors", "body"])
    return run


BLOCK = "block long, ids binary, known binary, sizes binary, anchors binary, body binary"


class Block:
    """A block's arrays: bytes, document offsets, ids, anchors and the
    document and gram hash of each anchor."""

    def __init__(self, row: dict):
        self.T = _unzip(row["body"], np.uint8)
        self.ids, self.known = _unzip(row["ids"], np.int64), _unzip(row["known"], bool)
        self.at = spans_of(_unzip(row["sizes"], np.int64))
        self.anchors = np.cumsum(_unzip(row["anchors"], np.uint32), dtype=np.int64)

    def grams(self) -> np.ndarray:
        out = np.empty(len(self.anchors), dtype=np.uint64)
        for i in range(0, len(out), 1 << 18):
            g = self.T[self.anchors[i:i + (1 << 18), None] + np.arange(K)].view("<u8")
            x = (g[:, 0] * _MIX) ^ (g[:, 0] >> np.uint64(29))
            x = (x + g[:, 1]) * _MIX
            x = (x ^ (x >> np.uint64(32))) * _MIX
            out[i:i + (1 << 18)] = x ^ (x >> np.uint64(29))
        return out

    def docs(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, positions, side="right") - 1


def _part_and_value(grams: np.ndarray, parts: int) -> np.ndarray:
    """Sortable (part << 32) + 32-bit value of each gram hash."""
    part = (grams & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
    return (part << np.uint64(32)) | (grams >> np.uint64(32))


def _send_grams(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            b = Block(row)
            key = _part_and_value(b.grams(), parts)
            order = np.argsort(key, kind="stable")
            key, ids = key[order], b.ids[b.docs(b.anchors[order])]
            if not len(key):
                continue
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            many = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
            key = key[first]
            part = (key >> np.uint64(32)).astype(np.int32)
            own, cut = np.unique(part, return_index=True)
            cut = [*cut.tolist(), len(part)]
            yield pa.record_batch([
                pa.array(own), pa.array(np.full(len(own), row["block"])),
                pa.array([key[a:z].astype(np.uint32).tobytes() for a, z in zip(cut, cut[1:])], pa.binary()),
                pa.array([np.packbits(many[a:z]).tobytes() for a, z in zip(cut, cut[1:])], pa.binary())], names=["part", "block", "grams", "many"])
    return run


def _shared_grams(table: pa.Table) -> pa.Table:
    """Of a part, the grams of two documents or more, for each block."""
    grams = [np.frombuffer(x, dtype=np.uint32) for x in table["grams"].to_pylist()]
    many = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(g)).astype(bool) for x, g in zip(table["many"].to_pylist(), grams)]
    value, inverse, count = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = count > 1
    shared[inverse[np.concatenate(many)]] = True
    keep = np.split(shared[inverse], np.cumsum([len(g) for g in grams])[:-1])
    out = [g[k].tobytes() for g, k in zip(grams, keep)]
    return pa.table({"block": table["block"], "part": table["part"], "grams": pa.array(out, pa.binary())})


class Entries:
    """A block's distinct anchored suffixes whose grams are shared, by part
    and in byte order, and the anchors that have each."""

    def __init__(self, b: Block, shared: list[tuple[int, bytes]], parts: int, length: int):
        wanted = np.sort(np.concatenate([np.empty(0, dtype=np.uint64), *[
            (np.uint64(part) << np.uint64(32)) | np.frombuffer(g, dtype=np.uint32).astype(np.uint64) for part, g in shared]]))
        key = _part_and_value(b.grams(), parts)
        i = np.minimum(np.searchsorted(wanted, key), max(len(wanted) - 1, 0))
        take = wanted[i] == key if len(wanted) else np.zeros(len(key), dtype=bool)
        pos, part = b.anchors[take], (key[take] >> np.uint64(32)).astype(np.int64)
        doc = b.docs(pos)
        side = length - K
        self.right_len = np.minimum(length, b.at[doc + 1] - pos).astype(np.uint8)
        self.left_len = np.minimum(side, pos - b.at[doc]).astype(np.uint8)
        T = np.concatenate([b.T, np.zeros(length, dtype=np.uint8)])
        right = T[pos[:, None] + np.arange(length)]
        right[np.arange(length) >= self.right_len[:, None]] = 0
        left = T[np.maximum(pos[:, None] - 1 - np.arange(side), 0)]
        left[np.arange(side) >= self.left_len[:, None]] = 0
        # one line of bytes per suffix: right, left, lengths; compared as big-endian words
        lines = np.zeros((len(pos), -(-(length + side + 2) // 8) * 8), dtype=np.uint8)
        lines[:, :length], lines[:, length:length + side] = right, left
        lines[:, length + side], lines[:, length + side + 1] = self.right_len, self.left_len
        words = lines.view(">u8").astype(np.uint64)
        order = np.lexsort((*words.T[::-1], part))
        words, part = words[order], part[order]
        new = np.ones(len(pos), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (words[1:] != words[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        ids = b.ids[doc]
        self.entry = np.empty(len(pos), dtype=np.int64)  # of each anchor
        self.entry[order] = np.cumsum(new) - 1
        self.pos, self.id = pos, ids
        self.part = part[first]
        self.lines = lines[order][first]
        self.low = np.minimum.reduceat(ids[order], first) if len(first) else np.empty(0, dtype=np.int64)
        self.high = np.maximum.reduceat(ids[order], first) if len(first) else np.empty(0, dtype=np.int64)
        self.length, self.side = length, side

    def runs(self) -> Iterator[tuple[int, int, dict]]:
        """(part, first entry, front-coded run)."""
        own, cut = np.unique(self.part, return_index=True)
        cut = [*cut.tolist(), len(self.part)]
        for part, a, z in zip(own.tolist(), cut, cut[1:]):
            right = self.lines[a:z, :self.length]
            differ = np.concatenate([right[1:] != right[:-1], np.ones((z - a - 1, 1), dtype=bool)], axis=1)
            shared = np.concatenate([[0], differ.argmax(axis=1)]).astype(np.uint8)
            rest = right[np.arange(self.length) >= shared[:, None]]
            yield part, a, {"n": z - a, "shared": _zip(shared), "rest": _zip(rest), "left": _zip(self.lines[a:z, self.length:self.length + self.side + 2]),
                            "low": _zip(self.low[a:z]), "high": _zip(self.high[a:z])}


RUN = "part int, block long, first long, n long, shared binary, rest binary, left binary, low binary, high binary"


def _send_runs(parts: int, length: int):
    def run(key: tuple, blocks: pa.Table, shared: pa.Table) -> pa.Table:
        out = []
        for row in rows(blocks.to_batches()):
            e = Entries(Block(row), list(zip(shared["part"].to_pylist(), shared["grams"].to_pylist())), parts, length)
            out += [{"part": part, "block": row["block"], "first": first, **r} for part, first, r in e.runs()]
        types = {"part": pa.int32(), "block": pa.int64(), "first": pa.int64(), "n": pa.int64()}
        names = [c.split()[0] for c in RUN.split(", ")]
        return pa.table({c: pa.array([r[c] for r in out], types.get(c, pa.binary())) for c in names})
    return run


def merge_runs(runs: list[tuple[np.ndarray, bytes]], length: int) -> tuple[list[int], list[int], list[int]]:
    """Loser-tree merge of front-coded runs (shared prefix lengths, rests):
    (run, place in run, prefix shared with the one before) in byte order.

    A node keeps the loser and the prefix it shares with the winner that
    passed. Of two contenders the one sharing more with the last winner is
    smaller; bytes are compared only from an equal shared length on.
    """
    k = len(runs)
    shared = [r[0].tolist() for r in runs]
    rests = [r[1] for r in runs]
    place, used = [0] * k, [length] * k
    text = [r[:length] for r in rests]
    tree_run, tree_shared = [-1] * k, [0] * k
    out_run, out_place, out_shared = [], [], []

    def fight(a: int, la: int, b: int, lb: int) -> tuple[int, int, int, int]:
        """(winner, its prefix, loser, its prefix); -1 marks an ended run."""
        if la != lb:
            return (a, la, b, lb) if la > lb else (b, lb, a, la)
        if la < 0:
            return a, la, b, lb
        x, y = text[a][la:], text[b][la:]
        if x == y:
            return (a, la, b, length) if a < b else (b, lb, a, length)
        h = length - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8
        return (a, la, b, h) if x < y else (b, lb, a, h)

    best, prefix = 0, 0
    for run in range(k):  # a contender climbs until it meets an empty node
        best, prefix, node = run, 0, (run + k) >> 1
        while node and tree_run[node] >= 0:
            best, prefix, tree_run[node], tree_shared[node] = fight(best, prefix, tree_run[node], tree_shared[node])
            node >>= 1
        if node:
            tree_run[node], tree_shared[node] = best, prefix
    while k and prefix >= 0:
        i = place[best]
        out_run.append(best)
        out_place.append(i)
        out_shared.append(prefix)
        i += 1
        place[best] = i
        if i < len(shared[best]):
            prefix = shared[best][i]
            cut = used[best]
            end = used[best] = cut + length - prefix
            text[best] = text[best][:prefix] + rests[best][cut:end]
        else:
            prefix = -1
        node = (best + k) >> 1
        while node:
            other, have = tree_run[node], tree_shared[node]
            if have > prefix:
                tree_run[node], tree_shared[node], best, prefix = best, prefix, other, have
            elif have == prefix and prefix >= 0:
                best, prefix, tree_run[node], tree_shared[node] = fight(best, prefix, other, have)
            node >>= 1
    return out_run, out_place, out_shared


def smallest_documents(shared: np.ndarray, left: np.ndarray, low: np.ndarray, length: int) -> np.ndarray:
    """For each merged suffix and each place o of its anchor in a string, the
    smallest document that has the string (NONE where a text is too short).
    left: the bytes left of the anchor outwards, then both lengths."""
    n, side = len(low), length - K
    right_len, left_len = left[:, side].astype(np.int64), left[:, side + 1].astype(np.int64)
    out = np.full((n, side + 1), NONE, dtype=np.int64)
    h = np.zeros(n, dtype=np.uint64)
    for o in range(side + 1):
        if o:
            h = (h + left[:, o - 1].astype(np.uint64) + np.uint64(1)) * _MIX
            h ^= h >> np.uint64(32)
        need = length - o
        group = np.cumsum(shared < need)
        ok = np.flatnonzero((right_len >= need) & (left_len >= o))
        if not len(ok):
            continue
        out[ok, o] = low[ok]
        g = group[ok]
        mates = np.bincount(g, minlength=1)[g] > 1
        ok, g = ok[mates], g[mates]
        if not len(ok):
            continue
        order = np.lexsort((h[ok], g))
        ok, g = ok[order], g[order]
        hh = h[ok]
        first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (hh[1:] != hh[:-1])]))
        least = np.minimum.reduceat(low[ok], first)
        out[ok, o] = np.repeat(least, np.diff(np.append(first, len(ok))))
    return out


ANSWER = "block long, first long, entry binary, place binary, doc binary"


def _merge(length: int):
    side = length - K

    def run(table: pa.Table) -> pa.Table:
        sent = table.to_pylist()
        zd = zstandard.ZstdDecompressor()
        runs = [(_unzip(r["shared"], np.uint8), zd.decompress(r["rest"])) for r in sent]
        which, place, shared = (np.array(x, dtype=np.int64) for x in merge_runs(runs, length))
        start = spans_of(np.array([r["n"] for r in sent], dtype=np.int64))
        at = start[which] + place

        def all_of(c, dtype):
            return np.concatenate([_unzip(r[c], dtype) for r in sent])

        left = all_of("left", np.uint8).reshape(-1, side + 2)[at]
        low, high = all_of("low", np.int64)[at], all_of("high", np.int64)[at]
        least = smallest_documents(shared, left, low, length)
        use = least.min(axis=1, initial=NONE) < high  # some document of the entry has an earlier one
        back = np.empty(len(at), dtype=np.int64)
        back[at] = np.arange(len(at))
        out = []
        for i, r in enumerate(sent):
            own = back[start[i]:start[i + 1]]
            entry = np.flatnonzero(use[own])
            m = least[own[entry]]
            change = np.ones(m.shape, dtype=bool)
            change[:, 1:] = m[:, 1:] != m[:, :-1]
            e, o = np.nonzero(change)
            out.append({"block": r["block"], "first": r["first"], "entry": _zip(entry[e].astype(np.uint32)), "place": _zip(o.astype(np.uint8)), "doc": _zip(m[e, o])})
        names = [c.split()[0] for c in ANSWER.split(", ")]
        return pa.table({c: pa.array([r[c] for r in out], pa.int64() if c in ("block", "first") else pa.binary()) for c in names})
    return run


def _removed(b: Block, e: Entries, answers: list[dict], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of maximal removed runs, positions in the block."""
    side = length - K
    starts = [np.empty(0, dtype=np.int64)]
    if answers and len(e.part):
        entry = np.concatenate([_unzip(a["entry"], np.uint32).astype(np.int64) + a["first"] for a in answers])
        place = np.concatenate([_unzip(a["place"], np.uint8) for a in answers]).astype(np.int64)
        doc = np.concatenate([_unzip(a["doc"], np.int64) for a in answers])
        order = np.argsort(entry * (side + 1) + place, kind="stable")
        slot = (entry * (side + 1) + place)[order]
        doc = doc[order]
        has = np.zeros(len(e.part), dtype=bool)
        has[entry] = True
        row = np.cumsum(has) - 1
        first = row[entry[order]] * (side + 1) + place[order]
        flat = np.repeat(doc, np.diff(np.append(first, has.sum() * (side + 1)))).reshape(-1, side + 1) if len(slot) else np.empty((0, side + 1), dtype=np.int64)
        mine = np.flatnonzero(has[e.entry])
        for i in range(0, len(mine), 1 << 16):
            own = mine[i:i + (1 << 16)]
            x, o = np.nonzero(flat[row[e.entry[own]]] < e.id[own, None])
            starts.append(np.unique(e.pos[own][x] - o))
    s = np.unique(np.concatenate(starts))
    if not len(s):
        return s, s, s
    doc = b.docs(s)
    new = np.flatnonzero(np.concatenate([[True], (s[1:] - s[:-1] > length) | (doc[1:] != doc[:-1])]))
    end = s[np.append(new[1:], len(s)) - 1] + length
    return doc[new], s[new], end


def _whole_characters(T: np.ndarray, a: int, z: int) -> tuple[int, int]:
    """The kept range a..z without characters that it cuts."""
    while a < z and T[a] & 0xC0 == 0x80:
        a += 1
    back = z
    while back > a and T[back - 1] & 0xC0 == 0x80:
        back -= 1
    if back > a and T[back - 1] >= 0xC0:
        lead = int(T[back - 1])
        if z - back + 1 < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
            z = back - 1
    return a, z


def _cut(parts: int, length: int):
    kept_type = pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())]))

    def run(key: tuple, blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = {c: [] for c in ("doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text_sha256", "kept")}
        found = answers.to_pylist()
        for row in rows(blocks.to_batches()):
            b = Block(row)
            shared = [(r["part"], r["grams"]) for r in found if r["grams"] is not None]
            e = Entries(b, shared, parts, length)
            doc, start, end = _removed(b, e, [r for r in found if r["entry"] is not None], length)
            body = b.T.tobytes()
            cut = np.searchsorted(doc, np.arange(len(b.ids) + 1))
            for i, (id_, known) in enumerate(zip(b.ids.tolist(), b.known.tolist())):
                a, z = int(b.at[i]), int(b.at[i + 1])
                own = [(int(start[j]), int(end[j])) for j in range(cut[i], cut[i + 1])]
                edges = [a, *[x for span in own for x in span], z]
                ranges = [(x, y) for x, y in zip(edges[::2], edges[1::2]) if x < y]
                sha = hashlib.sha256()
                for x, y in ranges:
                    sha.update(body[x:y])
                whole = [_whole_characters(b.T, x, y) for x, y in ranges] if own else []
                for c, value in zip(out, (id_ if known else None, z - a, sum(y - x for x, y in own), len(own), sha.hexdigest(),
                                          hashlib.sha256(body[a:z]).hexdigest() if own else None,
                                          [{"start": x - a, "n": y - x} for x, y in whole if x < y])):
                    out[c].append(value)
        types = {"kept_sha256": pa.string(), "text_sha256": pa.string(), "kept": kept_type}
        return pa.table({c: pa.array(v, types.get(c, pa.int64())) for c, v in out.items()})
    return run


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, text_sha256, kept), one
    row per input row.

    A byte goes when a ``length``-byte string over it also starts in a document
    with a smaller key; strings are judged on the input. ``kept`` lists the
    kept byte ranges (start, n) of documents that lose something, shrunk to
    whole characters, and ``text_sha256`` their input's hash; both are empty or
    null otherwise. Null texts are empty. Rows of one key do not count against
    each other; rows with a null key neither lose bytes nor cost others any.
    Other columns are not read; no rows: no rows. ``length``: 17 to 200.
    """
    if not K < length <= 200:
        raise ValueError("length must be 17 to 200")
    spark = docs.sparkSession
    blocks = stage(docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(_pack_blocks(length), BLOCK), "blocks")
    parts = 4 * partitions(spark)  # several to a partition, so that they even out
    shared = stage(blocks.mapInArrow(_send_grams(parts), "part int, block long, grams binary, many binary")
                   .groupBy("part").applyInArrow(_shared_grams, "block long, part int, grams binary"), "shared-grams")
    runs = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_runs(parts, length), RUN)
    answers = runs.groupBy("part").applyInArrow(_merge(length), ANSWER)
    both = shared.select("block", "part", "grams").unionByName(answers, allowMissingColumns=True)
    return (blocks.groupBy("block").cogroup(both.groupBy("block"))
            .applyInArrow(_cut(parts, length), "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                               "text_sha256 string, kept array<struct<start: long, n: long>>")
            .withColumnRenamed("doc", key))


def cut_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes cut from its texts, all rows and columns
    kept, ``n_chars`` (if there) brought up to date where a text changed.
    Characters that a cut goes through are dropped. See ``repeated_bytes``."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # own names: none can clash with the result's
    k, t = (names[docs.columns.index(c)] for c in (key, text))
    found = (repeated_bytes(docs, key, text, length).where("n_removed > 0").dropDuplicates([key, "text_sha256"])
             .select(F.col(key).alias("id"), F.col("text_sha256").alias("sha"), "kept"))
    found = broadcast_if_small(stage(found, "cuts"), 200_000)  # a few ranges a row
    own = docs.toDF(*names)
    joined = own.join(found, (own[k].cast("long") == found["id"]) & (F.sha2(own[t].cast("binary"), 256) == found["sha"]), "left")
    body = own[t].cast("binary")
    parts = F.transform("kept", lambda r: F.substring(body, (r["start"] + 1).cast("int"), r["n"].cast("int")).cast("string"))
    joined = joined.withColumn(t, F.when(F.col("kept").isNotNull(), F.array_join(parts, "")).otherwise(own[t]))
    if n_chars in docs.columns:
        n = names[docs.columns.index(n_chars)]
        joined = joined.withColumn(n, F.when(F.col("kept").isNotNull(), F.char_length(t).cast(docs.schema[n_chars].dataType)).otherwise(F.col(n)))
    return joined.select(*names).toDF(*docs.columns)
