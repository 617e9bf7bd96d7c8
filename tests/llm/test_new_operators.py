"""Operators 11 to 13 against brute force, with awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from tillpoint.llm import conversation_repair, queries, token_align
from tillpoint.llm.conversation_repair import Parse, repair, repaired_digests, repaired_rows
from tillpoint.llm.quality_rules import frequent_lines, quality_rules, remove_frequent_lines
from tillpoint.llm.token_align import align_texts, aligned_groups, aligner

from .helpers import DOCS, awkward_rows

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- 11

ODD = ["a  b", "tab\there", "line\n\nend \n", " lead", "trail ", " ", "\n", "don't we'll 12,5 $3", "ﬁ Ａ 日本語 ü", "<|endoftext|> <s> </s> <0x0A>", "▁", "a▁b",
       "emoji 🙂🙂", " x ", "a\r\nb\x0bc\x0cd\x85e", "\x00", "ab" * 300, "x  y", "é", "…“quoted”—dash"]


def align_brute(texts):
    """(n_a, n_b, groups, links) of each text by the tokenizers as they are."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    raw = dict(zip(token_align._byte_alphabet(), token_align._byte_alphabet().values()))

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    result = []
    for text in texts:
        result.append((0, 0, "", []))
        if not text:
            continue
        whole = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a = [bytes(raw[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        parts_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) and b.is_byte(i) else p.replace("▁", " ").encode() for p, i in zip(pieces, ids_b)]
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            continue
        sa, sb = spans(parts_a), spans(parts_b)
        ends = sorted({z for _, z in sa} & {z for _, z in sb})
        groups, low = [], 0
        for z in ends:
            groups.append(",".join(str(i) for i, s in zip(ids_a, sa) if low <= s[0] and s[1] <= z) + "|"
                          + ",".join(str(i) for i, s in zip(ids_b, sb) if low <= s[0] and s[1] <= z))
            low = z
        links = [(i, j) for i, s in zip(ids_a, sa) for j, t in zip(ids_b, sb) if s[0] < t[1] and t[0] < s[1]]
        result[-1] = (len(ids_a), len(ids_b), ";".join(groups), links)
    return result


def test_alignment_equals_brute_force(spark):
    texts = [r[1] for r in awkward_rows() if len(r[1] or "") < 2000] + ODD
    rows = [(i if i != 3 else None, t, "x", 1.0) for i, t in enumerate(texts)] + [(0, texts[0], "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, best double").repartition(3)
    want = align_brute([r[1] for r in rows])
    count = Counter(p for *_, links in want for p in links)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    lines = [(r[0], n_a, n_b, len(groups.split(";")) if groups else 0, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
              hashlib.sha256(groups.encode()).hexdigest() if groups else "") for r, (n_a, n_b, groups, links) in zip(rows, want)]
    got = align_texts(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(lines, key=repr)
    assert sum(1 for x in want if x[2]) > 60 and sum(1 for x in want if not x[2]) > 3


def test_blocks_and_parts_change_nothing(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    whole = sorted(map(tuple, align_texts(docs, A, B).collect()))
    monkeypatch.setattr(token_align, "BLOCK_BYTES", 40)
    monkeypatch.setattr(token_align, "PART_PAIRS", 10)
    assert sorted(map(tuple, align_texts(docs, A, B).collect())) == whole


def test_units_are_where_tokens_start(monkeypatch):
    rng = random.Random(3)
    words = [w for r in awkward_rows() for w in (r[1] or "").split()] + ["don't", "12,5", "日本", "a\nb", "\n", "x  y", ".", "'s", "\t", "\u3000", "\x85", "x\n", "▁"]
    texts = [" ".join(rng.choice(words[:-1] if n % 5 else words) for _ in range(200)) for n in range(30)] + ODD
    want = align_brute(texts)
    for piece, cache, long in ((1 << 20, 150_000, 200), (50, 40, 200), (1 << 20, 150_000, 3)):
        monkeypatch.setattr(token_align, "PIECE", piece)
        monkeypatch.setattr(token_align, "CACHE", cache)
        monkeypatch.setattr(token_align, "LONG_UNIT", long)
        for units, (n_a, n_b, groups, links) in zip(token_align.Aligner(A, B).align(t.encode() for t in texts), want):
            assert (sum(u[0] for u in units), sum(u[1] for u in units), ";".join(u[3] for u in units)) == (n_a, n_b, groups)
            assert sum(u[2] for u in units) == len(groups.split(";")) * bool(groups)
            pairs = np.frombuffer(b"".join(u[4] for u in units), dtype=np.int64).tolist()
            assert sorted(pairs) == sorted(i << 32 | j for i, j in links)


def test_bytes_that_are_no_text_have_no_tokens():
    assert [len(x) for x in token_align.Aligner(A, B).align([b"a b", b"a \xff b", b"", b"b"])] == [2, 0, 0, 1]


def test_both_ways_of_the_byte_tokenizer_agree():
    rng = random.Random(4)
    tool = aligner(A, B).a
    letters = [c for c in map(chr, [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC])] + [" "] * 40 + list("'sltre") * 5
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        assert not token_align._OTHER.search(text)
        assert tool.fast.encode_ordinary(text) == tool.whole.encode(text, add_special_tokens=False).ids


def test_groups_give_the_text_back(spark):
    rows = [(i, t) for i, t in enumerate([*ODD, None, ""])]
    got = aligned_groups(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    tool = aligner(A, B)
    for i, t in rows:
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        if own:
            assert b"".join(bytes(r["bytes"]) for r in own) == (" " + t).encode()
            assert all(b"".join(tool.b.raw[k] for k in r["b"]) == bytes(r["bytes"]) for r in own)
        else:
            assert not t or "▁" in t


def test_alignment_of_no_rows(spark, empty_docs):
    assert align_texts(empty_docs, A, B).collect() == []


# --- 12

def normal(line):
    return " ".join(w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(line))


def quality_brute(rows, limit, most_lost, min_words):
    """rows: (id, text, host)"""
    freq = Counter(k for _, t, h in rows for k in {(h or "", normal(x)) for x in (t or "").split("\n") if WORD.search(x)})
    out = []
    for i, t, h in rows:
        t, h = t or "", h or ""
        w = WORD.findall(t)
        windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        n = Counter(windows)
        repeat = {k + j for k, x in enumerate(windows) if n[x] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        lost = sum(len(WORD.findall(x)) for x in lines if freq[h, normal(x)] > limit)
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat), failed, lost,
                    not failed and not (lost > most_lost * len(w) or len(w) - lost < min_words)))
    return out


def quality_rows(seed=2):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(["the", "Of", "and", "né", "x#", "<b>", "ok", "日本"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 12))) for _ in range(30)]
    rows = []
    for i in range(120):
        text = "\n".join(rng.choice(lines[:8]) if rng.random() < 0.4 else rng.choice(lines) + str(rng.randint(0, 9) if rng.random() < 0.5 else "") for _ in range(rng.randint(0, 14)))
        if i % 7 == 0:
            text = text.upper().replace(" ", "  ") + " \t"
        if i % 11 == 0:
            text += "\n" + " ".join(str(k % 9) for k in range(rng.randint(5, 60)))
        rows.append((i if i % 13 else None, text, rng.choice(["s", "s", "t", None, ""])))
    rows += [(500, None, "s"), (501, "", "t"), (502, "\n\n \t\n", "s"), (503, "one", "s"), (503, "one", "s"), (504, "a b c d e f g h " * 2, "s"), (505, "w " * 8, "s"), (506, "w " * 9, None)]
    rows += [(600, " ".join(f"w{k % 5000}" for k in range(30_000)), "s"), (601, "ü" * 100_000, "t"), (602, "\n".join(lines) + " #" * 50, "u")]
    return rows


@pytest.mark.parametrize("limit, most_lost", [(3, 0.5), (8, 0.25), (1000, 0.5)])
def test_quality_rules_equal_brute_force(spark, limit, most_lost):
    rows = quality_rows()
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, source string, row int, high string").repartition(4)
    got = quality_rules(docs, limit=limit, most_lost=most_lost)
    want = quality_brute(rows, limit, most_lost, 20)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    if limit == 3:
        assert any(not r[8] and not r[6] for r in want) and any(r[8] for r in want) and any(r[7] and r[8] for r in want)


def test_frequent_lines_are_counted_and_removed(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, row string").repartition(3)
    freq = Counter(k for _, t, h in rows for k in {(h or "", normal(x)) for x in (t or "").split("\n") if WORD.search(x)})
    got = [tuple(r) for r in frequent_lines(docs, limit=3).collect()]
    assert got == sorted([(h, x, n) for (h, x), n in freq.items() if n > 3], key=lambda r: (-r[2], r[0], r[1].encode()))

    def cut(t, h):
        if t is None:
            return None
        return "\n".join(x for x in t.split("\n") if not WORD.search(x) or freq[h or "", normal(x)] <= 3)

    cleaned = remove_frequent_lines(docs, limit=3)
    assert cleaned.columns == docs.columns
    assert sorted(map(tuple, cleaned.collect()), key=repr) == sorted([(i, cut(t, h), h, "x") for i, t, h in rows], key=repr)


def test_quality_of_no_rows(spark, empty_docs):
    assert quality_rules(empty_docs).collect() == []
    assert remove_frequent_lines(empty_docs).collect() == []


# --- 13

GRAMMAR = re.compile("(s?(ua)+)?")


def least_edit(rows, memo=None):
    """(cost, audit, repaired) of (initial, must go, truncated, role, text) rows, by
    search over the grammar's four places."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    names = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(len(rows), -1, -1):
        for inserts in (3, 2, 1, 0):
            for at in after:
                options = [(0, "", ())] if i == len(rows) and at in (0, 3) else []
                for r, to in after[at].items():
                    if inserts < 3 and r in names and (i, inserts + 1, to) in best:
                        c, a, x = best[i, inserts + 1, to]
                        options.append((c + 3, "I" + a, ((names[r], ""), *x)))
                if i < len(rows):
                    first, goes, cut, role, text = rows[i]
                    c, a, x = best.get((i + 1, 0, at), (None, None, None))
                    if c is not None:
                        options.append((c + 4, "D" + a, x))
                    for r, to in after[at].items() if not goes else ():
                        c, a, x = best.get((i + 1, 0, to), (None, None, None))
                        if c is not None and r == first:
                            options.append((c + 3 * cut, "K" + a, ((role, text), *x)))
                        if c is not None and r in names:
                            options.append((c + 3 + 3 * cut, "R" + a, ((names[r], text), *x)))
                if options:
                    best[i, inserts, at] = min(options, key=lambda o: o[:2])
    return best[0, 0, 0]


def repair_brute(rows):
    """rows: (conv, turn, role, text) as they stand."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults, items = set(), Counter(), []
        for _, role, text in own:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else ""
            faults[fault] += 1
            seen.add((role, text))
            items.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated", role, text))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(items))
        cost, audit, repaired = least_edit(items)
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in repaired))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, repaired)
    return out


def digest(repaired):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()


def conversations(seed=1, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "what", "Why?", "", " \n\t", "cut off", None, "Done. ", "é", "long " * 50 + "."]
    rows = []
    for conv in range(n):
        for k in range(rng.randint(1, 9)):
            turn = None if rng.random() < 0.1 else rng.choice([k, k, k, 3, -2])
            rows.append((conv if conv else None, turn, rng.choice(["user", "assistant"] * 3 + ["system", "tool", "", None, "User", "sys"]), rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}."))
    rows += [(1000, k, "user" if k % 2 == 0 else "assistant", f"{k % 50}{'.' if k % 7 else ''}") for k in range(1500)]  # long, many repeats
    rows += [(1001, 5, "user", "same.")] * 400 + [(1002, None, None, None)] * 3
    return rows


def check_repair(spark, rows, parts):
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, audit string, copies int").repartition(parts)
    found = repair(frame)
    got = {r["conv_id"]: tuple(r)[1:] for r in repaired_digests(frame, found).collect()}
    want = repair_brute(rows)
    assert got == {k: (*v[:7], digest(v[7])) for k, v in want.items()}
    lines = {}
    for r in repaired_rows(frame, found).collect():
        lines.setdefault(r["conv_id"], []).append((r["position"], r["role"], r["text"]))
    assert {k: [x[1:] for x in sorted(v)] for k, v in lines.items()} == {k: list(v[7]) for k, v in want.items() if v[7]}


def test_repair_equals_brute_force(spark):
    check_repair(spark, conversations(), 4)


def test_a_conversation_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        check_repair(spark, [(7, k // 3, ["user", "assistant", "system", "x"][k * k % 4], f"{k % 200}{'.' if k % 5 else ''}") for k in range(900)], 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_parse_of_every_short_conversation():
    for n in range(5):
        for kinds in itertools.product("dsuaxSUAX", repeat=n):
            rows = [(k.lower(), k == "d", k.isupper(), "", "") for k in kinds]
            assert Parse().rows("".join(kinds)).least() == least_edit(rows)[:2], kinds


def test_parts_of_a_conversation_join(spark):
    rng = random.Random(9)
    for _ in range(60):
        kinds = "".join(rng.choice("dsuaxSUAX") for _ in range(rng.randint(2, 40)))
        cut = rng.randint(1, len(kinds) - 1)
        whole = Parse().rows(kinds[:cut])
        whole.step(lambda stack: conversation_repair._ends(stack, kinds[cut:]))
        assert whole.least() == Parse().rows(kinds).least()


def test_repair_of_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = repair(empty)
    assert found.collect() == [] and repaired_digests(empty, found).collect() == []


def test_registered_repair_query(spark, tmp_path):
    rows = conversations(seed=4, n=60) + [(2000, 1, "user", "a."), (2001, None, None, None)]
    k = next(k for k in range(500) if zlib.crc32(f"{3000 + k}:0".encode()) % 20 == 0)
    rows.append((3000 + k, 0, "user", "dropped."))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = []
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if fault == 4 else r, "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x)
        damaged += [] if fault == 0 else [row] * (2 if fault == 3 else 1)
    want = {k: (*v[:7], digest(v[7])) for k, v in repair_brute(damaged).items()}
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: want.get(c, nothing) for c in {r[0] for r in rows}} and got[3000 + k] == nothing


def test_registered_document_queries(spark, tmp_path):
    rows = awkward_rows()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_quality_rules(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(quality_brute([(r[0], r[1], r[3]) for r in rows], 30, 0.5, 20), key=repr)
    want = align_brute([r[1] if len(r[1] or "") < 2000 else None for r in rows])
    got = queries.op11_token_alignment(spark, str(tmp_path)).collect()
    shown = {(r["doc_id"], r["n_a"], r["n_b"], r["n_links"], r["groups_sha256"]) for r in got}
    assert len(got) == len(rows)
    for r, (n_a, n_b, groups, links) in zip(rows, want):
        if len(r[1] or "") < 2000:
            assert (r[0], n_a, n_b, len(links), hashlib.sha256(groups.encode()).hexdigest() if groups else "") in shown


def test_pre_tokens_are_cut_as_the_tokenizers_own_pattern_does():
    import random
    import re

    from tillpoint.llm import tokens

    own = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{tokens._LETTER}]+|[{tokens._NUMBER}]|[^\s{tokens._LETTER}{tokens._NUMBER}]+")
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choices("'strevmld aé9½_-\t\nſ$", k=rng.randint(0, 12)))
        assert tokens._PRE.findall(text) == own.findall(text)


def test_pre_tokens_that_fit_the_cache_are_encoded_once(monkeypatch):
    from tillpoint.llm import tokens

    words = ["".join(w) for w in itertools.islice(itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=4), 300_000)]
    texts = [" ".join(words[i:i + 1000]) for i in range(0, len(words), 1000)]
    encoder = tokens.WordBpe(P.path("word_bpe_49k.json"))
    learnt = []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: learnt.append(text.count(" ") + 1) or ids(text))
    once = list(encoder.encode(texts))
    assert list(encoder.encode(texts)) == once
    assert sum(learnt) == len(words)


def test_pre_tokens_beyond_the_cache_are_learnt_again(monkeypatch):
    from tillpoint.llm import tokens

    rng = random.Random(2)
    texts = [" ".join("".join(rng.choices("abc.", k=rng.randint(1, 4))) for _ in range(30)) for _ in range(300)]
    want = list(tokens.WordBpe(P.path("word_bpe_49k.json")).encode(texts))
    monkeypatch.setattr(tokens, "CACHE", 120)
    monkeypatch.setattr(tokens, "PIECE", 200)
    encoder = tokens.WordBpe(P.path("word_bpe_49k.json"))
    assert list(encoder.encode(texts)) == want
    assert len(encoder.known) <= 120
