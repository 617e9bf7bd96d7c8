"""The registered queries without SQL, and the pipeline as a whole, against brute
force on a small folder."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillpoint.llm import queries
from tillpoint.llm.toxicity import score

from .helpers import DOCS, components, words
from .test_operators import brute_fingerprint, brute_repeats, ids_of, shingles
from .test_toxicity_pipeline import toxic_rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ITEM_WORDS = 25


def rows_of_the_folder(seed=21):
    """ASCII texts: toxic ones, copies, near copies, shared passages, benchmark items
    inside, short, empty and null ones. Ids are unique."""
    rng = random.Random(seed)
    plain = lambda n: " ".join(w.replace("é", "e").replace("ü", "u") for w in words(rng, n))
    items = [(k, plain(ITEM_WORDS)) for k in range(1, 5)] + [(9, None)]
    passage, copy, base = plain(70), plain(90), plain(400)
    texts = [t for _, t, _ in toxic_rows(150)]
    texts = [t.encode("ascii", "ignore").decode() for t in texts]
    texts += [plain(rng.randint(1, 120)) for _ in range(60)]
    texts += [copy] * 4 + [base, base + " tail", base + " other end"]
    texts += [f"{plain(12)} {passage}\n{plain(8)}" for _ in range(6)]
    texts += [f"{plain(30)} {items[k][1]} {plain(10)}" for k in (0, 1, 1, 3)] + [items[2][1]]
    texts += ["", None, "word", " \n\t ", plain(3000)]
    labels = [(i, 1, y) for i, _, y in toxic_rows(150)] + [(3000, 0, 1), (None, 1, 1)]
    return [(i, t) for i, t in enumerate(texts)], items, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items, labels = rows_of_the_folder()
    path = str(tmp_path_factory.mktemp("docs"))
    table = [(i, t, "en", f"s{i % 3}", None if t is None else len(t), "x", "y") for i, t in rows]
    spark.createDataFrame(table, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, [(i, t or "") for i, t in rows], items


def brute_simhash(rows):
    """{id: (fingerprint, component)}"""
    fp = {i: brute_fingerprint(t) for i, t in rows}
    ids = sorted(fp)
    links = [(a, b) for a in ids for b in ids if a < b and bin(fp[a] ^ fp[b]).count("1") <= 3]
    comp = components(ids, links)
    return {i: (fp[i], comp[i]) for i in ids}


def brute_pieces(rows):
    out = {}
    for (i, _), ids in zip(rows, ids_of([t for _, t in rows])):
        ids = [*ids, 0]
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            out[i, k // 2048] = (k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()))
    return out


def check_packing(got, rows):
    """Pieces exactly; sequences without gaps, within their length, and few."""
    want = brute_pieces(rows)
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(n for _, n, _ in want.values())
    assert math.ceil(total / 2048) <= len(bins) <= 1.1 * total / 2048 + 2


def test_op4_scores_every_row_by_one_model(spark, folder):
    path, rows, _ = folder
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, path).collect()}
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    again = {r["doc_id"]: r["score"] for r in score(docs, queries.toxicity_model(docs, labels)).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5)
        assert abs(r["score"] - again[i]) < 1e-9  # fitting is the same from run to run
    held = [(got[i]["predicted"], y) for i, _, y in toxic_rows(150) if got[i]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_op7_counts_are_the_tokenizers(spark, folder):
    path, rows, _ = folder
    got = queries.op7_token_counts(spark, path).collect()
    assert Counter(r["n_tokens"] for r in got) == Counter(len(ids) for ids in ids_of([t for _, t in rows]))
    files = defaultdict(list)
    for r in got:
        files[r["part"], r["file"]].append((r["document"], r["start"], r["n_tokens"]))
    for own in files.values():
        at = 0
        for k, (number, start, n) in enumerate(sorted(own)):
            assert (number, start) == (k, at)
            at += n + 1


def test_op8_packs_the_tokenizers_pieces(spark, folder):
    path, rows, _ = folder
    check_packing(queries.op8_best_two_fit(spark, path).collect(), rows)


def test_op9_fingerprints_and_components(spark, folder):
    path, rows, _ = folder
    want = brute_simhash(rows)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in queries.op9_simhash(spark, path).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(rows) - 3


def test_op10_base_scores_and_a_proper_model(spark, folder):
    path, rows, _ = folder
    toks = {i: [*WORD.findall(t.encode().lower()), b" "] for i, t in rows}
    train = [t for i, t in toks.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    got = {r["doc_id"]: r for r in queries.op10_lm_score(spark, path).collect()}
    for i, t in toks.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(c[w] > 0 for w in t), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert abs(r["base_score"] - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-6
        assert r["score"] <= 0
    twice = [i for i, t in rows if t and [x for _, x in rows].count(t) > 1]
    once = [i for i, t in rows if 40 < len(toks[i]) < 130 and [x for _, x in rows].count(t) == 1]
    gain = lambda i: (got[i]["score"] - got[i]["base_score"]) / got[i]["n_tokens"]
    assert min(map(gain, twice)) > np.mean(list(map(gain, once)))  # what occurs again is likelier than its words alone


def brute_cut(rows, n=50):
    """Texts without their bytes in 50-byte strings that a smaller id has."""
    seen = {}
    for i, t in sorted(rows):
        for p in range(len(t) - n + 1):
            seen.setdefault(t[p:p + n], i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - n + 1):
            if seen[t[p:p + n]] < i:
                gone[p:p + n] = True
        out.append((i, "".join(c for c, g in zip(t, gone) if not g)))
    want = {k[0]: k[4] for k in brute_repeats(rows, n)}
    assert all(hashlib.sha256(t.encode()).hexdigest() == want[i] for i, t in out)
    return out


def test_pipeline_is_its_stages_by_brute_force(spark, folder):
    path, rows, items = folder
    toxic = {r["doc_id"] for r in queries.op4_toxicity(spark, path).collect() if r["predicted"]}
    left = [(i, t) for i, t in rows if i not in toxic]
    comp = brute_simhash(left)
    left = [(i, t) for i, t in left if comp[i][1] == i]
    cut = brute_cut(left)
    assert sum(a != b for (_, a), (_, b) in zip(left, cut)) >= 4
    benchmark = [shingles(t) for _, t in items if t]
    left = [(i, t) for i, t in cut if not any(len(s & shingles(t)) >= 0.8 * len(s) - 1e-9 for s in benchmark)]
    assert len(cut) - len(left) >= 3
    check_packing(queries.pipeline(spark, path).collect(), left)
