"""The random field, and the pipeline's stages one by one."""

import itertools
import random
import zlib

import numpy as np
import pytest

from tillpoint.llm import toxicity
from tillpoint.llm.toxicity import Crf, log_odds, score, tag, train

from .helpers import DOCS, awkward_rows, words


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    T = rng.standard_normal((2, 2))
    lengths = [1, 4, 0, 6]
    at = np.concatenate([[0], np.cumsum(lengths)])
    E = rng.standard_normal(at[-1])
    odds = log_odds(E, at, T)[2]
    for a, z in zip(at, at[1:]):
        w = {y: sum(E[a + t] * s for t, s in enumerate(y)) + sum(T[i, j] for i, j in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=z - a)}
        for t in range(z - a):
            one = np.logaddexp.reduce([v for y, v in w.items() if y[t]])
            zero = np.logaddexp.reduce([v for y, v in w.items() if not y[t]])
            assert abs(odds[a + t] - (one - zero)) < 1e-9


def toxic_rows(n=300, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w, y = words(rng, rng.randint(5, 60)), int(i % 5 == 0)
        if y:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["vilax", "grobul", "stinkor"]) + rng.choice(["", "en", "s,"]))
        rows.append((i, " ".join(w), y))
    return rows


def test_held_out_accuracy_and_spans(spark):
    rows = toxic_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    crf = train(df.where("doc_id < 200").select("text", "toxic"), steps=6)
    got = {r["doc_id"]: r for r in score(df, crf).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if i >= 200]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    text = {i: t for i, t, _ in rows}
    for i in (200, 205, 210):
        for s in got[i]["spans"]:
            assert any(k in text[i][s["start"]:s["end"]] for k in ("vilax", "grobul", "stinkor"))


def test_scores_of_awkward_rows(docs, empty_docs):
    crf = Crf(weights={"=word": 9.0}, document=np.array([-3.0, 0.5, 0.5]))
    got = score(docs, crf).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert score(empty_docs, crf).count() == 0
    assert {r["doc_id"]: r["spans"] for r in got}[62][0].asDict() == {"start": 0, "end": 4}


def test_training_without_both_classes(spark, empty_docs):
    crf = train(empty_docs.selectExpr("text", "cast(n_chars as int) as toxic"))
    assert crf.weights == {}


def write(spark, folder, rows, items, labels):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_take_effect(spark, scratch):
    import corpus_pipeline as cp

    toxic = [(1000 + i, t, "en", "s", len(t), "x", "y") for i, t, _ in toxic_rows(200)]
    labels = [(1000 + i, 1, y) for i, _, y in toxic_rows(200)] + [(1, None, None), (None, 1, 1)]
    rows = awkward_rows() + toxic
    leak = next(t for i, t, *_ in rows if i == 3 or (i is not None and i < 40 and len(t.split()) > 30))
    write(spark, scratch, rows, [(1, leak), (2, None)], labels)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    steps = dict(cp.STAGES)
    assert list(steps) == ["toxicity", "simhash", "suffix_dedup", "decontaminate", "best_two_fit"]

    clean = steps["toxicity"](spark, docs, scratch)
    assert clean.columns == docs.columns
    gone = {r["doc_id"] for r in docs.select("doc_id").subtract(clean.select("doc_id")).collect()}
    bad = {1000 + i for i, _, y in toxic_rows(200) if y}
    assert len(bad & gone) > 0.9 * len(bad) and len(gone - bad) < 6

    single = steps["simhash"](spark, docs, scratch)
    ids = [r["doc_id"] for r in single.select("doc_id").collect()]
    assert single.columns == docs.columns and set(range(40, 46)) & set(ids) == {40}
    assert ids.count(66) <= 1 and ids.count(None) == 2

    cut = steps["suffix_dedup"](spark, docs, scratch)
    assert cut.columns == docs.columns and cut.count() == docs.count()

    kept = steps["decontaminate"](spark, docs, scratch)
    leaked = {i for i, t, *_ in rows if t == leak}
    assert {r["doc_id"] for r in docs.select("doc_id").subtract(kept.select("doc_id")).collect()} == leaked
    assert kept.columns == docs.columns

    out = cp.run(spark, scratch)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 50


def test_crc_is_of_the_id_as_text(spark):
    from tillpoint.llm.common import crc_mod

    got = spark.range(50).select("id", crc_mod("id", 5).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_near_copies_are_judged_by_row(spark, scratch):
    """An id with several texts: each row goes or stays with its own component."""
    import corpus_pipeline as cp

    rng = random.Random(11)
    a, b, c, d = (" ".join(words(rng, 400)) for _ in range(4))
    near = [t + " x" for t in (a, b, c, d)]
    rows = [(7, a), (7, b), (9, near[1]), (3, near[0]), (5, c), (8, near[2]), (8, d), (8, near[3]), (8, d), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", "y") for i, t in rows], DOCS)
    got = cp.drop_near_copies(spark, docs, scratch)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([(3, near[0]), (7, b), (5, c), (8, d), (None, a)], key=repr)


def test_contaminated_rows_go_whatever_their_id(spark, scratch):
    import corpus_pipeline as cp

    rng = random.Random(12)
    item, one, two = (" ".join(words(rng, 30)) for _ in range(3))
    rows = [(None, f"{one} {item}"), (None, one), (4, f"{item} {two}"), (4, two), (4, None), (5, item), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", "y") for i, t in rows], DOCS)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    got = cp.drop_contaminated(spark, docs, scratch)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(None, one), (4, two), (4, None), (6, "")], key=repr)


def test_spans_are_of_the_text_as_it_stands(spark):
    crf = Crf(weights={"=bad": 9.0, "=wörse": 9.0}, document=np.array([-3.0, 0.5, 0.5]))
    texts = ["İstanbul is a bad place", "a BAD İİ Wörse İ bad wörse", "İ bad", "ΣΑΣ bad ΟΔΟΣ", "bad İ", "İbad bad"]
    got = {r["doc_id"]: r["spans"] for r in score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), crf).collect()}
    found = {i: [texts[i][s["start"]:s["end"]] for s in got[i]] for i in got}
    assert found == {0: ["bad"], 1: ["BAD", "Wörse", "bad wörse"], 2: ["bad"], 3: ["bad"], 4: ["bad"], 5: ["bad bad"]}


def test_tags_name_a_clash(spark):
    df = spark.createDataFrame([(1, "x", 0.5)], "doc_id long, text string, Score double")
    with pytest.raises(ValueError, match="score"):
        tag(df, Crf())
    assert score(df, Crf()).count() == 1


def test_gradient_equals_finite_differences(spark):
    rows = [(t, y) for _, t, y in toxic_rows(25, 8)]
    names = ["=vilax", "=grobul", "stin", "=the"]
    theta = np.array([-1.5, 0.1, -0.7, 0.3, 0.2, 1.0, 0.5, 2.0, -0.5])

    def model(x):
        return Crf(dict(zip(names, x[5:].tolist())), float(x[0]), x[1:5].reshape(2, 2))

    def likelihood(x):
        """Log-likelihood of the words' labels, by the sum over all labellings in
        its recursive form."""
        crf, total = model(x), 0.0
        for text, y in rows:
            ws = toxicity._WORD.findall(text.lower())
            labels = [int(y and any(f in crf.weights for f in toxicity.features(w))) for w in ws]
            E = [crf.emission(w) for w in ws]
            total += sum(e for e, k in zip(E, labels) if k) + sum(crf.transitions[i, j] for i, j in itertools.pairwise(labels))
            a = np.array([0.0, E[0]])
            for e in E[1:]:
                a = np.array([np.logaddexp(a[0] + crf.transitions[0, j], a[1] + crf.transitions[1, j]) + j * e for j in (0, 1)])
            total -= np.logaddexp(*a)
        return total

    frame = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    parts = frame.mapInArrow(toxicity._gradient(model(theta), names), "g binary").collect()
    got = sum(np.frombuffer(bytes(r["g"])) for r in parts)
    step = 1e-5
    want = [(likelihood(theta + step * e) - likelihood(theta - step * e)) / (2 * step) for e in np.eye(len(theta))]
    assert np.allclose(got, want, atol=1e-4)


def test_score_is_the_model_of_the_marginals(spark):
    rows = [(i, t) for i, (_, t, _) in enumerate(toxic_rows(20, 9))] + [(100, ""), (101, None)]
    crf = Crf({"=vilax": 4.0, "grob": 3.0}, -3.0, np.array([[0.0, -1.0], [-0.5, 1.0]]), np.array([-2.0, 0.7, 1.1]))
    for r in score(spark.createDataFrame(rows, "doc_id long, text string"), crf).collect():
        ws = toxicity._WORD.findall((dict(rows)[r["doc_id"]] or "").lower())
        E = np.array([crf.emission(w) for w in ws])
        odds = log_odds(E, np.array([0, len(ws)]), crf.transitions)[2]  # enumerated above
        x = [1, np.clip(odds.max(), -10, 10), np.log1p((1 / (1 + np.exp(-odds))).sum())] if len(ws) else [1, -10, 0]
        assert abs(r["score"] - 1 / (1 + np.exp(-np.dot(x, crf.document)))) < 1e-9
        assert r["n_toxic"] == (odds >= 0).sum()
