import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockmill.llm import classifier as C
from llm_cases import DOCS, prose


def corpus():
    rng, docs, labels = random.Random(1), [], []
    for k in range(400):
        good = rng.random() < 0.7
        text = prose(k, 30 + k % 50)
        if not good:
            text = " ".join(w.upper() + "!!" for w in text.split()) if k % 2 else text.replace(" ", "$$$ ")
        docs.append((k, text, "en", "s", 0))
        labels.append((k, int(good), 0))
    return docs, labels


def test_learns_and_scores_held_out(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = C.classify(frame, truth).collect()
    known = {d: q for d, q, _ in labels}
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    again = C.classify(frame.repartition(7), truth.repartition(2)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    other = truth.withColumn("quality", F.when(C.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    settings = C.ClassifierSettings(epochs=1)
    first, second = (sorted(map(tuple, C.classify(frame, t, settings).collect())) for t in (truth, other))
    assert first == second


def test_bounds_of_the_sample(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    settings = C.ClassifierSettings(max_rows=50, max_bytes=5000)
    sample = C.training_sample(frame, truth, settings)
    assert 5 < len(sample) <= 50 and sum(len(t.encode()) for t, _ in sample) <= 5000


def test_a_long_text_costs_only_its_own_place(spark):
    docs, labels = corpus()
    long = [(k, (t + " ") * 1000 if k % 10 == 0 else t, *rest) for k, t, *rest in docs]
    settings = C.ClassifierSettings(max_bytes=400_000)
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    wanted = {r[0] for r in truth.filter(~C.held_out(F.col("doc_id"))).select("doc_id").collect()}
    sample = [t for t, _ in C.training_sample(spark.createDataFrame(long, DOCS), truth, settings)]
    assert len(sample) == len(wanted) and sum(len(t.encode()) for t in sample) <= 400_000
    assert {t for k, t, *_ in docs if k in wanted and k % 10} <= set(sample)
    assert all(len(t.encode()) <= 400_000 // 128 for t in sample)
    frame = spark.createDataFrame([("ab" * 500 + "é" * 1000 + "yz" * 500,)], "text string")
    got = frame.select(C.spread_pieces(F.col("text"), 640)).first()[0]
    assert len(got.encode()) <= 640 and got.startswith("ab") and got.endswith("yz") and "é" in got


def test_scores_are_the_model(spark):
    docs, labels = corpus()
    settings = C.ClassifierSettings(epochs=2)
    model = C.train([t for _, t, *_ in docs], [q for _, q, _ in labels], settings)
    frame = spark.createDataFrame(docs[:40], DOCS)
    for row in C.score_documents(frame, model, settings, 0.3).collect():
        features, share = C.text_features(docs[row["doc_id"]][1].encode().split(), settings)
        want = 1 / (1 + np.exp(-(share @ model.scores[features].astype(float) + model.bias)))
        assert row["score"] == pytest.approx(want, abs=1e-4)


def test_edge_rows(spark, edges, nothing):
    truth = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (None, 1, 0), (6, None, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")
    rows = C.classify(edges, truth).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = truth.limit(0)
    assert {r["score"] for r in C.classify(edges, none).collect()} == {0.5}
    assert C.classify(nothing, truth).count() == 0


def test_one_sample_whatever_the_partitioning(spark):
    """Several texts and labels under one id: the text with the least hash, the largest label."""
    rows = [(k % 40, f"text {k} " * (1 + k % 7), "en", "s", 0) for k in range(400)]
    truth = spark.createDataFrame([(k % 40, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    settings = C.ClassifierSettings(max_bytes=2000)
    found = set()
    for parts in (1, 3, 8, 16):
        frame = spark.createDataFrame(rows, DOCS).repartition(parts, "text")
        sample = C.training_sample(frame, truth.repartition(parts), settings)
        assert sum(len(t.encode()) for t, _ in sample) <= 2000
        found.add(tuple(sample))
    assert len(found) == 1 and len(next(iter(found))) > 10
