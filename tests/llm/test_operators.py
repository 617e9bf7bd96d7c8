"""The numbered operators against brute force, with awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import xxhash

from tillpoint.llm.decontaminate import contained_items
from tillpoint.llm.embed_dedup import RECALL, TILE, embedding_dedup, plan_tables, recall
from tillpoint.llm.lm_score import score_texts
from tillpoint.llm.merkle import audit, record_digests
from tillpoint.llm.packing import pack, plan_bins
from tillpoint.llm.simhash import fingerprint, simhash_dedup
from tillpoint.llm.suffix_dedup import cut_texts, merge_runs, repeated_bytes
from tillpoint.llm.token_scan import END, scan_flat, write_flat
from tillpoint.llm.tokens import WordBpe
from tillpoint.llm.url_filter import build_trie, filter_urls, longest_match

from .helpers import awkward_rows, components

TOKENIZER = P.path("word_bpe_49k.json")
ROWS = [(r[0], r[1] or "") for r in awkward_rows()]


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


# --- 1

def shingles(text):
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return {" ".join(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_contained_items_equal_brute_force(spark, docs):
    rng = random.Random(1)
    source = [t for _, t in ROWS if len(t.split()) > 20]
    items = [(1, source[0]), (2, " ".join(source[1].split()[3:30])), (3, source[-2]), (4, None), (5, ""), (6, "word"), (7, "no such text at all here")]
    for k in range(8, 30):  # some words changed
        w = rng.choice(source).split()[:rng.randint(8, 50)]
        w[rng.randrange(len(w))] = "changed"
        items.append((k, " ".join(w)))
    got = contained_items(docs, spark.createDataFrame(items, "item_id long, text string"))
    want = set()
    for i, t in ROWS:
        own = shingles(t)
        for j, q in items:
            s = shingles(q or "")
            if i is not None and s and len(s & own) >= math.ceil(0.8 * len(s) - 1e-9):
                want.add((i, j, len(s), len(s & own)))
    assert {tuple(r)[:4] for r in got.collect()} == want and len(want) > 5


def test_short_items_are_found_in_long_texts(spark):
    words = [f"w{i}" for i in range(40)]
    long_item = " ".join(words[20:30])
    items = [(1, "W3, w4 w5"), (2, "w7"), (3, "w3 w5"), (4, long_item), (5, "w10 w11 w12 w13"), (6, "a b"), (7, "...")]
    docs = [(1, " ".join(words)), (2, "w3 w4 w5"), (3, "w4 w5"), (4, "a-b"), (None, " ".join(words)), (5, None)]
    got = contained_items(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == {(1, 1, 1, 1, 1.0), (1, 2, 1, 1, 1.0), (1, 4, 6, 6, 1.0), (1, 5, 1, 1, 1.0), (2, 1, 1, 1, 1.0), (4, 6, 1, 1, 1.0)}


def test_decontaminate_runs_no_python(spark, docs):
    items = spark.createDataFrame([(1, ROWS[0][1])], "item_id long, text string")
    plan = contained_items(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- 2

def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    X = [b + rng.standard_normal(16) * s for b in base for s in (0, 0, 0.05, 0.1, 0.2)]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate(X)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [float("inf")] + [1.0] * 15), (None, rows[0][1])]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dedup(df).collect()}
    A = np.array([x for _, x in rows])
    n = np.sqrt((A * A).sum(1))
    G = (A @ A.T) / np.outer(n, n) >= 0.9
    np.fill_diagonal(G, False)
    comp = components(range(len(rows)), zip(*map(list, np.nonzero(G))))
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (G[i].sum(), comp[i], comp[i] == i)
    for i in range(900, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["component_id"] is None and not got[None]["kept"]
    assert recall(0.9, 8, 24) > 0.999
    assert embedding_dedup(df.limit(0)).count() == 0


def test_extreme_and_repeated_vectors_link(spark):
    huge, tiny, low = 1e200, 1e-200, 5e-324
    rows = [(1, [huge, huge, 0.0]), (2, [huge, huge, huge / 10]), (3, [tiny, tiny, 0.0]), (4, [2 * tiny, 2 * tiny, 0.0]), (5, [low, low, 0.0]), (6, [-1.0, -1.0, 0.0]),
            (7, [1.7e308, 1.7e308, 0.0]), (8, [0.0, 1e-300, 1e300]), (1, [huge, huge, 0.0])]
    got = embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == [(i, 5, 1, i == 1) for i in (1, 1, 2, 3, 4, 5)] + [(6, 0, 6, True), (7, 5, 1, False), (8, 0, 8, True)]


def test_comparisons_for_a_vector_stay_bounded():
    assert plan_tables(0, 0.9) == plan_tables(50_000, 0.9) and plan_tables(50_000, 0.9)[1] == 8
    for n in (1_000, 50_000, 1_000_000, 10_000_000, 60_000_000):
        tables, bits = plan_tables(n, 0.9)
        assert recall(0.9, bits, tables) >= RECALL
        assert tables * n / 2 ** bits <= 110 * TILE  # others met, on average
    assert plan_tables(10_000_000, 0.9)[0] * 10_000_000 / 2 ** plan_tables(10_000_000, 0.9)[1] < 24 * 10_000_000 / 2 ** 8 / 15


def test_more_bits_and_tables_find_the_same_links(spark, monkeypatch):
    from tillpoint.llm import embed_dedup

    rng = np.random.default_rng(5)
    rows = [(i, (b + rng.standard_normal(12) * s).tolist()) for i, (b, s) in enumerate((b, s) for b in rng.standard_normal((40, 12)) for s in (0, 0.05, 0.15))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted(map(tuple, embedding_dedup(df).collect()))
    monkeypatch.setattr(embed_dedup, "TILE", 2)  # many tiles; bits from 120 / 2
    assert sorted(map(tuple, embedding_dedup(df).collect())) == want
    monkeypatch.setattr(embed_dedup, "plan_tables", lambda *_: (80, 12))
    assert sorted(map(tuple, embedding_dedup(df).collect())) == want


def test_vectors_of_one_id_keep_their_own_links(spark):
    u, v, w = [[float(k == j) for k in range(8)] for j in range(3)]
    near = [[x + 0.1 * (k == 7) for k, x in enumerate(e)] for e in (u, v, w)]
    rows = [(1, u), (1, v), (2, near[0]), (3, near[1]), (4, v), (5, [x + 0.1 for x in v]), (6, w), (2, near[2])]
    got = embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = Counter({(1, 1, 1, True): 1, (1, 3, 1, True): 1, (2, 1, 1, False): 1, (2, 1, 2, True): 1, (3, 3, 1, False): 1, (4, 3, 1, False): 1,
                    (5, 3, 1, False): 1, (6, 1, 2, False): 1})
    assert Counter(tuple(r) for r in got) == want


# --- 3

def test_audit_finds_each_damaged_record(spark):
    rows = [(f"w{i % 3}", (i // 3) * 700, f"record {i}") for i in range(3000)]
    theirs = [(f, o, r.upper() if i in (5, 2000) else r) for i, (f, o, r) in enumerate(rows) if i != 77] + [("w0", 10 ** 7, "extra"), (None, 3, "x")]
    a, b = (record_digests(spark.createDataFrame(t, "file string, offset long, record string"), "file", "offset", "record") for t in (rows + rows[:2], theirs + rows[:2]))
    got = {(r["file"], r["offset"], r["status"]) for r in audit(a, b).collect()}
    assert got == {(*rows[5][:2], "changed"), (*rows[2000][:2], "changed"), (*rows[77][:2], "missing"), ("w0", 10 ** 7, "extra")}
    assert audit(a, a).count() == 0 and audit(a.limit(0), b.limit(0)).count() == 0
    assert audit(a.limit(0), b.where("file = 'w1'")).where("status = 'extra'").count() == 1000


# --- 5

def brute_repeats(rows, n=50):
    seen, out = {}, Counter()
    for i, t in rows:
        t = t.encode()
        for p in range(len(t) - n + 1):
            if i is not None:
                seen[t[p:p + n]] = min(seen.get(t[p:p + n], i), i)
    for i, t in rows:
        t = t.encode()
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - n + 1):
            if i is not None and seen[t[p:p + n]] < i:
                gone[p:p + n] = True
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~gone])
        out[i, len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_repeated_bytes_equal_brute_force(docs):
    got = Counter(tuple(r) for r in repeated_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    want = brute_repeats(ROWS)
    assert got == want and any(k[2] for k in want)


def test_cut_texts_keeps_rows_columns_and_characters(docs, empty_docs):
    got = cut_texts(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[41]["text"] == "" and by[41]["n_chars"] == 0  # a copy of 40
    assert by[40]["text"] == dict(ROWS)[40] and by[61]["text"] is None
    assert by[66]["text"] == ""
    assert cut_texts(empty_docs).count() == 0


def test_loser_tree_merges_and_tells_shared_prefixes():
    rng = random.Random(3)
    runs, all_ = [], []
    for k in range(7):
        own = sorted({bytes(rng.choice(b"ab") for _ in range(20)) for _ in range(rng.randint(1, 60))})
        shared = [0] + [next((i for i in range(20) if x[i] != y[i]), 20) for x, y in zip(own, own[1:])]
        runs.append((np.array(shared), b"".join(x[s:] for x, s in zip(own, shared))))
        all_.append(own)
    run, place, shared = merge_runs(runs, 20)
    got = [all_[r][p] for r, p in zip(run, place)]
    assert got == sorted(x for own in all_ for x in own)
    assert shared[1:] == [next((i for i in range(20) if x[i] != y[i]), 20) for x, y in zip(got, got[1:])]


# --- 6

def test_url_rules_by_a_plain_search(spark):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "xa.com", "net", "z.net"]
    paths = ["/", "/x", "/x/", "/x/y", "/xy/"]
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p) for h in hosts for p in paths if rng.random() < 0.5}.values())
    trie = build_trie(rules)
    for _ in range(2000):
        host = ".".join(rng.choice(["a", "b", "xa", "com", "net", "z"]) for _ in range(rng.randint(1, 4)))
        path = "/" + rng.choice(["", "x", "x/", "x/y", "xy/z", "x/y/z", "q"])
        fit = [(len(h + p), h.count("."), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, 0, None, None))
        assert longest_match(trie, host, path) == (best[2], best[3])
    assert longest_match(build_trie([("block", "a", "/"), ("allow", "a", "/")]), "a", "/") == ("a/", "block")


def test_url_parts_and_default(spark):
    df = spark.createDataFrame([(1, "HTTP://A.Com/X?y"), (2, None), (3, "no scheme"), (None, "x://h#f"), (5, "x://h"), (5, "x://h")], "page_id long, url string")
    got = [tuple(r) for r in filter_urls(df, [("block", "com", "/X")]).collect()]
    assert got == [(1, "a.com", "/X", "com/X", "block"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
                   (None, "h", "", None, "allow"), (5, "h", "", None, "allow"), (5, "h", "", None, "allow")]
    assert filter_urls(df.limit(0), []).count() == 0


# --- 7, 8

def test_tokenizer_pieces_equal_the_tokenizer():
    rng = random.Random(6)
    letters = "abAB zZéÉßÿŸſŒıİ'sS't're'LL.,!?-_<|>endoftext\t\n\r\x0b\x1c\x85\xa0\xad²½ªº×÷ŉΣσς中文é🙂0123 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [t for _, t in ROWS]
    assert list(WordBpe(TOKENIZER).encode(texts)) == [np.array(i, dtype="<u4").tobytes() for i in ids_of(texts)]


def test_added_tokens_in_a_text_are_the_tokenizer_s(spark, scratch):
    from tokenizers import Tokenizer

    texts = ["hello <|endoftext|> world", "<|startoftext|>", "a<|endoftext|>b", "<|EndOfText|> x", "é中<|endoftext|>", "<| endoftext |>", "hello world", None]
    plain = Tokenizer.from_file(TOKENIZER)
    want = [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert want[0] == [3306, 49407, 1002]
    assert list(WordBpe(TOKENIZER).encode(texts)) == [np.array(i, dtype="<u4").tobytes() for i in want]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in pack(df, TOKENIZER).collect()}
    assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 0], dtype="<u4").tobytes())) for i, w in enumerate(want)}
    write_flat(df, f"{scratch}/flat", TOKENIZER)
    assert sorted(r["n_tokens"] for r in scan_flat(spark, f"{scratch}/flat").collect()) == sorted(map(len, want))


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_separator_scan_round_trip(spark, docs, scratch, block):
    write_flat(docs, f"{scratch}/flat", TOKENIZER, rows_per_file=20)
    got = scan_flat(spark, f"{scratch}/flat", block=block).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(i) for i in ids_of([t for _, t in ROWS]))
    files = {}
    for r in got:
        files.setdefault(r["file"], []).append((r["document"], r["start"], r["n_tokens"]))
    for rows in files.values():  # documents follow each other, one end id between them
        rows.sort()
        assert [d for d, _, _ in rows] == list(range(len(rows)))
        assert [s for _, s, _ in rows] == [0, *[s + n + 1 for _, s, n in rows[:-1]]]


def test_scan_of_foreign_files(spark, scratch):
    import os

    os.mkdir(f"{scratch}/f")
    for name, ids in {"open": [1, 2, END, END, 5, 6, 7], "empty": [], "ends": [END]}.items():
        with open(f"{scratch}/f/{name}.bin", "wb") as f:
            f.write(np.array(ids, dtype=">u2").tobytes())
    got = sorted((r["file"][-8:], r["document"], r["start"], r["n_tokens"]) for r in scan_flat(spark, f"{scratch}/f", block=3).collect())
    assert got == [("ends.bin", 0, 0, 0), ("open.bin", 0, 0, 2), ("open.bin", 1, 3, 0), ("open.bin", 2, 4, 3)]


def test_packing_is_whole_and_gapless(docs, empty_docs):
    got = pack(docs, TOKENIZER, size=256).collect()
    want = Counter()
    for (i, _), ids in zip(ROWS, ids_of([t for _, t in ROWS])):
        ids = [*ids, 0]
        want.update((i, k, s, len(ids[s:s + 256]), zlib.crc32(np.array(ids[s:s + 256], dtype="<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 256)))
    assert Counter(tuple(r)[:5] for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in bins.values():
        rows.sort()
        assert [o for o, _ in rows] == [sum(n for _, n in rows[:i]) for i in range(len(rows))] and sum(n for _, n in rows) <= 256
    assert len(bins) <= 1.03 * sum(k[3] * n for k, n in want.items()) / 256 + 1
    assert pack(empty_docs, TOKENIZER).count() == 0


def test_best_two_replaces_the_smallest():
    # greedy: 6 + 3 leaves a gap of 1; two of 2 fit the expanded gap exactly
    entries, bins = plan_bins({6: 1, 3: 1, 2: 2}, 10)
    first = {e[0] for e in entries if e[4] == 0}
    assert first == {6, 2} and bins == 2


# --- 9

def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def test_simhash_components_equal_brute_force(docs, empty_docs):
    fps = [(i, brute_fingerprint(t)) for i, t in ROWS]
    known = [(i, f) for i, f in fps if i is not None]
    comp = components({i for i, _ in known}, [(a, b) for a, x in known for b, y in known if a < b and (x ^ y).bit_count() <= 3])
    got = Counter(tuple(r) for r in simhash_dedup(docs).collect())
    assert got == Counter((i, f"{f:016x}", comp[i] if i is not None else None, comp[i] == i if i is not None else None) for i, f in fps)
    assert simhash_dedup(empty_docs).count() == 0


def test_near_fingerprints_across_tiles(spark, monkeypatch):
    from tillpoint.llm import simhash

    monkeypatch.setattr(simhash, "TILE", 8)
    rng = random.Random(8)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:40]:  # chains of near ones
        for _ in range(6):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    want = components(range(len(fps)), [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3])
    for n in (1000, 3_000_000):  # three segments, four segments
        links = [(r["a"], r["b"]) for r in simhash.near_links(df, 3, n).collect()]
        assert components(range(len(fps)), links) == want


def test_long_text_fingerprint_is_cut_in_pieces(monkeypatch):
    from tillpoint.llm import simhash

    text = " ".join(f"w{i % 97}" for i in range(3000))
    whole = fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PIECE", 50)
    assert fingerprint(text.encode()) == whole == brute_fingerprint(text)


# --- 10

def test_language_model_scores(docs, empty_docs):
    toks = [(i, [*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), b" "]) for i, t in ROWS]
    train = [t for i, t in toks if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for i, t in toks)
    rows = score_texts(docs).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in rows if r["doc_id"] is not None)
    assert score_texts(empty_docs).count() == 0


def test_walk_equals_the_formula(spark):
    """score by the documented formula, with the model's own backoff weights."""
    from tillpoint.llm import lm_score

    texts = [(i, t) for i, t in enumerate(["a b a b c", "a b", "c c c a", "b a b a", "q r", ""] * 3)]
    seen = {}
    fit = lm_score.fit_backoff
    try:
        lm_score.fit_backoff = lambda h: seen.setdefault("b", fit(h))
        got = {r["doc_id"]: r for r in score_texts(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    finally:
        lm_score.fit_backoff = fit
    toks = {i: [*t.split(), "</s>"] for i, t in texts}
    train = [t for i, t in toks.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    uni = Counter(w for t in train for w in t)
    big = Counter(p for t in train for p in zip(["<s>", *t], t))
    n, v = sum(uni.values()), len(uni)
    uni_h = uni + Counter({"<s>": len(train)})
    for i, t in toks.items():
        total = 0
        for h, w in zip(["<s>", *t], t):
            p = (uni[w] + 1) / (n + v + 1)
            if uni_h[h]:
                b = seen["b"][int(math.log2(uni_h[h]))]
                p = (1 - b) * big[h, w] / uni_h[h] + b * p
            total += math.log10(p)
        assert abs(got[i]["score"] - total) < 1e-6
