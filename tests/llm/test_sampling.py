"""The bounded sample filters before it shuffles; language sets have no cap."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from crystalflow.llm import language, sampling


def test_rows_go_before_the_shuffle_by_label(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(40_000).select("id", F.when(F.col("id") % 20 == 0, "rare").otherwise("hot").alias("label"))
        sample = sampling.lowest_hashes(rows, "id", F.col("label"), 300)
        plan = sample._jdf.queryExecution().executedPlan().toString()
        got = sample.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r["label"] for r in got) == ["hot"] * 300 + ["rare"] * 300
    want = rows.withColumn("turn", F.shiftrightunsigned(F.xxhash64("id"), 11)).orderBy("turn").where("label = 'hot'").limit(300)
    assert {r["id"] for r in want.collect()} == {r["id"] for r in got if r["label"] == "hot"}


def test_many_labels_are_joined(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW_LABELS", 1)
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("label"))
    assert sampling.lowest_hashes(rows, "id", F.col("label"), 5).count() == 35


def test_six_languages_in_one_text():
    """Six languages of letters of their own: all six are found, with their shares."""
    alphabets = ["abcd", "efgh", "ijkl", "mnop", "qrst", "uvwx"]
    random = np.random.default_rng(1)
    texts = [" ".join("".join(random.choice(list(a), 6)) for _ in range(400)) for a in alphabets]
    slots = 1 << 12
    counts = np.stack([np.bincount(language.trigrams([t], slots)[0], minlength=slots) + 0.5 for t in texts], axis=1)
    model = language.Model([f"l{k}" for k in range(6)], np.log(counts / counts.sum(axis=0)))
    mixed = " ".join(w for k, t in enumerate(texts) for w in t.split()[: 10 * (k + 1)])
    shares = language.infer([mixed, texts[2], "abcd"], model)
    assert np.allclose(shares[0], np.arange(1, 7) / 21, atol=0.02)
    assert shares[1].argmax() == 2 and shares[1].max() > 0.99 and shares[2].argmax() == 0


def test_mixture_against_a_plain_loop():
    likelihood = np.array([[0.9, 0.1, 0.3], [0.2, 0.7, 0.1], [0.5, 0.5, 0.5], [0.05, 0.6, 0.4]])
    share = np.full(3, 1 / 3)
    for _ in range(9):
        joint = [[s * l for s, l in zip(share, row, strict=True)] for row in likelihood]
        share = np.mean([[j / sum(row) for j in row] for row in joint], axis=0)
    found, total = language._mixture(likelihood, np.array([0]), np.zeros(4, int), np.full((1, 3), 1 / 3), 9)
    assert np.allclose(found[0], share)
    assert np.isclose(total[0], np.log((likelihood * share).sum(axis=1)).sum())
