"""Operator 13: conversation structure repair by generalised LR parsing.

The role grammar ``C -> | T | s T``, ``T -> P | T P``, ``P -> u a`` becomes an
LR(0) table. A parse keeps a graph-structured stack: stacks share their tails,
and of equal stack tops over the same tail only the least (cost, audit) stays.
Each row of a conversation is kept (0), reroled to user or assistant (3) or
deleted (4), and empty turns may be inserted before it (3 each); a truncated row
that stays costs 3 more, a blank or repeated one must go.

The grammar's recursion is on the left, so few stacks exist between two rows and
what a run of rows does is a table (stack before, stack after) -> least (cost,
audit), which composes. So a conversation of any length is split: rows are
ranged over tasks in order, each task sums up its runs, and the tables of a
conversation's runs are joined in order. Equal costs are ordered by rank, not by
comparing audits: after the same number of rows no audit is a prefix of another.

Identical rows are counted before any shuffle, and a row knows by a join with
the first turn of its (conversation, role, text hash) whether it was seen
earlier. Text moves once, when repaired conversations are written out in order.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, release, stage

# fixed values: the grammar, the edits' costs, and white space
GRAMMAR = [("C", ""), ("C", "T"), ("C", "sT"), ("T", "P"), ("T", "TP"), ("P", "ua")]
RULES = [("Z", "C"), *GRAMMAR]
EDIT_COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"


# --- the LR table -------------------------------------------------------------

def _closure(items: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
    todo = list(items)
    while todo:
        rule, dot = todo.pop()
        right = RULES[rule][1]
        for i, (left, _) in enumerate(RULES):
            if dot < len(right) and left == right[dot] and (i, 0) not in items:
                items.add((i, 0))
                todo.append((i, 0))
    return frozenset(items)


@functools.cache
def table() -> tuple[dict[tuple[int, str], int], dict[int, list[int]]]:
    """LR(0) table of the grammar: (state, symbol) -> state, and the rules that
    each state may reduce by (more than one action: the parse keeps them all)."""
    states, goto = [_closure({(0, 0)})], {}
    for n, state in enumerate(states):  # grows meanwhile
        for symbol in sorted({RULES[r][1][d] for r, d in state if d < len(RULES[r][1])}):
            to = _closure({(r, d + 1) for r, d in state if RULES[r][1][d:d + 1] == symbol})
            if to not in states:
                states.append(to)
            goto[n, symbol] = states.index(to)
    return goto, {n: sorted(r for r, d in s if d == len(RULES[r][1])) for n, s in enumerate(states)}


Stack = tuple  # (state, stack below) or (0, None): equal stacks are one node


def _reduced(stack: Stack) -> Iterator[Stack]:
    """The stack and all that it may be reduced to; the last state is the top."""
    goto, reduces = table()
    yield stack
    for rule in reduces[stack[0]]:
        left, right = RULES[rule]
        below = stack
        for _ in right:
            below = below[1]
        if (below[0], left) in goto:
            yield from _reduced((goto[below[0], left], below))


@functools.cache
def shifted(stack: Stack, symbol: str) -> tuple[Stack, ...]:
    goto, _ = table()
    if (stack[0], symbol) not in goto:
        return ()
    return tuple(s for s in _reduced((goto[stack[0], symbol], stack)) if any((s[0], t) in goto for t in "sua"))


@functools.cache
def accepts(stack: Stack) -> bool:
    goto, _ = table()
    return any(s == (goto[0, "C"], START) for s in _reduced(stack))


START: Stack = (0, None)
Moves = tuple[tuple[Stack, int, str], ...]


def _merge(into: dict[Stack, tuple[int, str]], stack: Stack, weight: tuple[int, str]) -> bool:
    if stack in into and into[stack] <= weight:
        return False
    into[stack] = weight
    return True


@functools.cache
def _inserted(stack: Stack) -> Moves:
    """Stacks reached by inserted turns alone, none included, by least weight."""
    best, todo = {stack: (0, "")}, [stack]
    while todo:
        top = todo.pop(0)
        cost, audit = best[top]
        for symbol in ROLES:
            for to in shifted(top, symbol):
                if _merge(best, to, (cost + EDIT_COST["I"], audit + "I")):
                    todo.append(to)
    return tuple((s, c, a) for s, (c, a) in best.items())


@functools.cache
def moves(stack: Stack, kind: str) -> Moves:
    """What one row does to a stack. kind: 'd' must go; else the role's initial
    ('x': none of the grammar's), in upper case if the row is truncated."""
    best: dict[Stack, tuple[int, str]] = {}
    more = TRUNCATED_COST if kind.isupper() else 0
    for top, cost, audit in _inserted(stack):
        _merge(best, top, (cost + EDIT_COST["D"], audit + "D"))
        if kind != "d":
            for symbol, edit in [(kind.lower(), "K"), *((s, "R") for s in ROLES)]:
                for to in shifted(top, symbol):
                    _merge(best, to, (cost + EDIT_COST[edit] + more, audit + edit))
    return tuple((s, c, a) for s, (c, a) in best.items())


@functools.cache
def _finish(stack: Stack) -> tuple[int, str]:
    return min((c, a) for s, c, a in _inserted(stack) if accepts(s))


@functools.cache
def stacks() -> tuple[Stack, ...]:
    """Every stack that rows can lead to; a parse's tables number them."""
    found, todo = {START}, [START]
    while todo:
        stack = todo.pop()
        new = {to for kind in "dsuaxSUAX" for to, _, _ in moves(stack, kind)} - found
        found |= new
        todo += new
    return tuple(sorted(found, key=repr))


# --- parsing ------------------------------------------------------------------

class Parse:
    """The least weight of each stack after the rows so far. An entry is (cost,
    rank of its audit among the entries, audit as links to its past)."""

    def __init__(self, start: Stack = START):
        self.tops: dict[Stack, tuple[int, int, tuple]] = {start: (0, 0, ())}

    def step(self, options) -> None:
        """options(stack): (stack after, cost, audit added) of the next rows."""
        best: dict[Stack, tuple] = {}
        for stack, (cost, rank, link) in self.tops.items():
            for to, more, audit in options(stack):
                weight = (cost + more, rank, audit)
                if to not in best or weight < best[to][0]:
                    best[to] = (weight, link)
        # audits differ at the rank before, or else in what was added
        order = {w: i for i, w in enumerate(sorted({w[1:] for w, _ in best.values()}))}
        self.tops = {s: (w[0], order[w[1:]], (link, w[2])) for s, (w, link) in best.items()}

    def rows(self, kinds: str) -> Parse:
        for kind in kinds:
            self.step(lambda stack, kind=kind: moves(stack, kind))
        return self

    def ends(self) -> list[tuple[Stack, int, str]]:
        return [(s, cost, _audit(link)) for s, (cost, _, link) in self.tops.items()]

    def least(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest whole repair, ties by least audit."""
        cost, _, added, link = min((c + _finish(s)[0], rank, _finish(s)[1], link) for s, (c, rank, link) in self.tops.items())
        return cost, _audit(link) + added


def _audit(link: tuple) -> str:
    parts = []
    while link:
        link, part = link
        parts.append(part)
    return "".join(reversed(parts))


# --- Spark --------------------------------------------------------------------

FAULTS = ["blank", "duplicate", "truncated"]


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, digest, copies, kind, blank, duplicate, truncated): the
    distinct rows of each conversation with how often they stand there, what the
    parse sees of them ('d': must go), and how many rows have which first fault.

    Null roles and texts are one space; rows stand by turn (null first), role and
    text hash; identical rows stand together and all but the first of them
    repeat."""
    clean = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _or_space(role).alias("role"), _or_space(text).alias("text"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    seen = clean.select("conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                        (last == "").alias("is_blank"), (~last.isin(".", "!", "?")).alias("is_cut"))
    names = ["conv", "turn", "role", "digest", "is_blank", "is_cut"]
    counted = stage(seen.groupBy(*names).agg(F.count(F.lit(1)).alias("copies")), "turns")
    firsts = stage(counted.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.bool_or(F.col("turn").isNull()).alias("null_first"), F.min("turn").alias("first")), "first-turns")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    is_first = F.when(F.col("null_first"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("x"))
    goes = F.col("is_blank") | ~is_first
    zero = F.lit(0).cast("long")
    return counted.join(firsts, same).select(
        "conv", "turn", "role", "digest", "copies", initial.alias("initial"),
        F.when(goes, F.lit("d")).when(F.col("is_cut"), F.upper(initial)).otherwise(initial).alias("kind"),
        F.when(F.col("is_blank"), F.col("copies")).otherwise(zero).alias("blank"),
        F.when(F.col("is_blank"), zero).otherwise(F.col("copies") - F.when(is_first, 1).otherwise(0)).alias("duplicate"),
        F.when(~goes & F.col("is_cut"), 1).otherwise(0).cast("long").alias("truncated"))


def _or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


RUN = "conv string, at long, first string, last string, illegal long, tops array<struct<start:int,to:int,cost:long,audit:string>>"
_LEGAL = {"su", "ua", "au"}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows are in order: one row for each run of rows of a
    conversation. The first run may go on from another task, so it is summed up
    for every stack that may stand before it."""
    number = {s: i for i, s in enumerate(stacks())}
    done: list[tuple] = []
    conv, at, kinds, initials, runs = None, None, [], [], 0

    def close() -> None:
        nonlocal runs
        row, ends = "".join(kinds), []
        for start in stacks() if runs == 0 else [START]:
            ends += [{"start": number[start], "to": number[s], "cost": c, "audit": a} for s, c, a in _ends(start, row)]
        shown = "".join(initials)
        illegal = sum(shown[i:i + 2] not in _LEGAL for i in range(len(shown) - 1))
        done.append((conv, at, shown[:1], shown[-1:], illegal, ends))
        runs += 1

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "at", "kind", "initial", "copies")]
        for c, a, kind, initial, copies in zip(*columns):
            if not kinds or c != conv:
                if kinds:
                    close()
                conv, at, kinds, initials = c, a, [], []
            kinds.append(kind + "d" * (copies - 1))
            initials.append(initial * copies)
        if len(done) > 5000:
            yield _batch(done, RUN)
            done = []
    if kinds:
        close()
    if done:
        yield _batch(done, RUN)
    release()


def _ends(start: Stack, kinds: str) -> list[tuple[Stack, int, str]]:
    return _short_ends(start, kinds) if len(kinds) < 64 else Parse(start).rows(kinds).ends()


@functools.lru_cache(maxsize=20_000)
def _short_ends(start: Stack, kinds: str) -> list[tuple[Stack, int, str]]:
    return Parse(start).rows(kinds).ends()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {RUN: [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                   pa.list_(pa.struct([("start", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))],
             REPAIR: [pa.string(), pa.int64(), pa.int64(), pa.string()]}[schema]
    names = ["conv", "at", "first", "last", "illegal", "tops"] if schema == RUN else ["conv", "illegal", "cost", "audit"]
    return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)


REPAIR = "conv string, illegal long, cost long, audit string"


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's runs are in order: one row per conversation."""
    known = stacks()
    done: list[tuple] = []
    conv, parse, illegal, last = None, None, 0, ""

    def close() -> None:
        cost, audit = parse.least()
        done.append((conv, illegal, cost, audit))

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "first", "last", "illegal", "tops")]
        for c, first, final, inner, tops in zip(*columns):
            if parse is None or c != conv:
                if parse:
                    close()
                conv, parse, illegal, last = c, Parse(), 0, ""
            options: dict[Stack, list] = {}
            for t in tops:
                options.setdefault(known[t["start"]], []).append((known[t["to"]], t["cost"], t["audit"]))
            parse.step(lambda stack: options.get(stack, ()))
            illegal += inner + (last != "" and last + first not in _LEGAL)
            last = final
        if len(done) > 5000:
            yield _batch(done, REPAIR)
            done = []
    if parse:
        close()
    if done:
        yield _batch(done, REPAIR)
    release()


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per
    conversation of ``rows``: its faults and its cheapest repair.

    A row's first fault counts: blank, seen earlier (role and text), truncated.
    ``illegal`` counts neighbours, as they stand, that no repair would leave.
    ``audit`` has an initial for each edit in order (Keep, Rerole, Delete,
    Insert). Roles count by their first letter; a role without one, or with
    another one, cannot stay as it is. Null conversation ids are a conversation;
    null roles and texts are one space; null turns come first and are left out of
    ``gaps``; rows of one turn stand by role and text hash. Other columns are not
    read; no rows: no rows.
    """
    kind = rows.schema[conv].dataType
    seen = stage(turns(rows, conv, turn, role, text).withColumn("conv", F.col("conv").cast("string")), "turn-kinds")
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    ordered = seen.select("conv", "turn", "role", "digest", "kind", "initial", "copies").repartitionByRange(partitions(rows.sparkSession), *order)
    runs = stage(ordered.sortWithinPartitions(*order).select("conv", F.monotonically_increasing_id().alias("at"), "kind", "initial", "copies")
                 .mapInArrow(_runs, RUN), "turn-runs")
    joined = (runs.repartition(partitions(rows.sparkSession), "conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "at")
              .mapInArrow(_joined, REPAIR))
    per_turn = seen.groupBy("conv", "turn").agg(*(F.sum(c).alias(c) for c in FAULTS))  # one row a turn: turns are then counted, not collected
    sums = per_turn.groupBy(F.col("conv").alias("c")).agg(*(F.sum(c).alias(c) for c in FAULTS), F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0).cast("long"))
    return (joined.join(sums, F.col("conv").eqNullSafe(F.col("c")))
            .select(F.col("conv").cast(kind).alias(conv), gaps.alias("gaps"), *FAULTS, "illegal", "cost", "audit"))


def _edited(roles: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of a repaired conversation, from its (role, text) rows
    in order, as they come."""
    place = 1 - (len(audit) - audit.count("D")) % 2  # an odd number of turns: the first is a system turn
    for edit in audit:
        role, text = next(roles) if edit != "I" else ("", "")
        if edit == "D":
            continue
        turn = role if edit == "K" else ROLES["au"[place % 2]]
        yield edit, turn, text
        place += 1


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, Iterator]]:
    """(conversation, its repaired rows): a task's rows are in order, each
    conversation's audit before its rows, and are read as they are needed."""
    def flat():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")))

    source = flat()
    ahead = next(source, None)

    def own(conv):
        nonlocal ahead
        while ahead is not None and ahead[0] == conv and ahead[1] is None:
            yield ahead[2], ahead[3]
            ahead = next(source, None)

    while ahead is not None:
        conv, audit = ahead[0], ahead[1]
        ahead = next(source, None)
        rows = own(conv)
        yield conv, _edited(rows, audit)
        for _ in rows:  # whatever the reader left
            pass
    release()


def _in_order(rows: DataFrame, repaired: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation in a run of its own: its audit, then its rows in order. The only step that moves text."""
    clean = rows.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"), _or_space(role).alias("role"), _or_space(text).alias("text"))
    null = F.lit(None)
    body = clean.select("conv", F.lit(1).alias("part"), null.cast("string").alias("audit"), "turn", "role", "text",
                        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    heads = repaired.select(F.col(conv).cast("string").alias("conv"), F.lit(0).alias("part"), "audit", null.cast("long").alias("turn"), F.lit("").alias("role"),
                            F.lit("").alias("text"), F.lit(b"").alias("digest"))
    both = body.unionByName(heads).repartition(partitions(rows.sparkSession), "conv")
    return both.sortWithinPartitions(F.col("conv").asc_nulls_first(), "part", F.col("turn").asc_nulls_first(), "role", "digest").select("conv", "audit", "role", "text")


def repaired_rows(rows: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, position, edit, role, text): the repaired conversations, row by row,
    from ``rows`` and what ``repair`` found for them. Conversations of which
    nothing is left have no rows. Nulls and ties as in ``repair``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for key, edits in _conversations(batches):
            for n, (edit, turn_role, body) in enumerate(edits):
                held.append((key, n, edit, turn_role, body))
                size += len(body)
                if size > 1 << 22 or len(held) > 10_000:
                    yield _rows(held)
                    held, size = [], 0
        if held:
            yield _rows(held)

    out = _in_order(rows, repaired, conv, turn, role, text).mapInArrow(run, "conv string, position long, edit string, role string, text string")
    return out.withColumnRenamed("conv", conv).withColumn(conv, F.col(conv).cast(rows.schema[conv].dataType))


def _rows(held: list[tuple]) -> pa.RecordBatch:
    conv, position, edit, role, text = zip(*held)
    return pa.record_batch([pa.array(list(c), t) for c, t in zip((conv, position, edit, role, text), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                           names=["conv", "position", "edit", "role", "text"])


def repaired_digests(rows: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``repaired`` with ``repaired_sha256``: of the repaired rows ``role:text``,
    joined by line ends. A hash is sequential by nature: each conversation's text
    streams through one task, in memory a batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for key, edits in _conversations(batches):
            digest, mark = hashlib.sha256(), ""
            for _, turn_role, body in edits:
                digest.update(f"{mark}{turn_role}:{body}".encode())
                mark = "\n"
            held.append((key, digest.hexdigest()))
            if len(held) > 10_000:
                yield pa.record_batch([pa.array(list(c), pa.string()) for c in zip(*held)], names=["key", "repaired_sha256"])
                held = []
        if held:
            yield pa.record_batch([pa.array(list(c), pa.string()) for c in zip(*held)], names=["key", "repaired_sha256"])

    staged = stage(repaired, "repairs")
    digests = _in_order(rows, staged, conv, turn, role, text).mapInArrow(run, "key string, repaired_sha256 string")
    return staged.join(digests, staged[conv].cast("string").eqNullSafe(F.col("key"))).drop("key")
