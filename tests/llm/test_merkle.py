"""The Merkle manifest against plain loops: logs, roots, proofs, several rounds, edge cases."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from crystalflow.llm import merkle


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def levels_of(nodes, arity):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + arity]) for k in range(0, len(out[-1]), arity)])
    return out


def siblings(levels, i, arity):
    out = []
    for nodes in levels[:-1]:
        start = i - i % arity
        out += [n for k, n in enumerate(nodes[start : start + arity], start) if k != i]
        i //= arity
    return out


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 63, 64, 65, 513, 4096])
def test_log_positions(count):
    leaves = [sha(str(k)).encode() for k in range(count)]
    log = merkle.append_all(leaves, merkle.height(count))
    levels = levels_of([d.decode() for d in leaves], merkle.ARITY)
    assert len(log) == sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for k, node in enumerate(nodes):
            assert log[merkle.position(level, k, count)].decode() == node


@pytest.fixture
def small_builders(monkeypatch):
    monkeypatch.setattr(merkle, "ARITY", 2)
    monkeypatch.setattr(merkle, "RISE", 2)
    monkeypatch.setattr(merkle, "SPAN", 4)


def check(made, rows, arity, changed):
    """rows: (group, id, digest), any order."""
    groups = sorted({g for g, _, _ in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([d for _, _, d in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))], arity) for g in groups}
    upper = levels_of([trees[g][-1][0] for g in groups], arity)
    want = []
    for t, g in enumerate(groups):
        for i, (_, key, digest) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            proof = siblings(trees[g], i, arity) + siblings(upper, t, arity)
            want.append((key, digest, trees[g][-1][0], upper[-1][0], sha(*proof), key not in changed))
    found = merkle.prove(made, "digest", "changed")
    got = [(r["id"], r["digest"], r["subroot"], r["root"], r["proof_sha256"], r["verified"]) for r in found.collect()]
    assert sorted(got) == sorted(want)
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in found.collect())
    logs = {}
    for r in merkle.log_of(made).collect():
        logs.setdefault(r["tree"], {})[r["position"]] = r["digest"]
    for t, g in enumerate(groups):
        assert sorted(logs[t]) == list(range(sum(map(len, trees[g]))))
        assert set(logs[t].values()) == {n for nodes in trees[g] for n in nodes}


def test_rounds_groups_and_hot_group(spark, small_builders):
    rows = [("hot", k, sha("h", str(k))) for k in range(75)] + [(f"g{k}", 1000 + k, sha(str(k))) for k in range(6)]
    rows += [(None, 2000 + k, sha("n", str(k))) for k in range(5)] + [("é", 3000 + k, sha("é", str(k))) for k in range(4)]
    changed = {3, 74, 1002, 2001, 3003}
    df = spark.createDataFrame(rows, "g string, id long, digest string").repartition(5)
    df = df.withColumn("changed", F.when(F.col("id").isin(list(changed)), F.sha2(F.lit("other"), 256)))
    made = merkle.build(df, "g", ["id"], "digest")
    assert len(made.rounds) == 4
    check(made, rows, 2, changed)


def test_many_groups_take_several_rounds_above(spark, small_builders):
    rows = [(f"g{k:03d}", k, sha(str(k))) for k in range(40)]
    df = spark.createDataFrame(rows, "g string, id long, digest string").withColumn("changed", F.lit(None).cast("string"))
    made = merkle.build(df, "g", ["id"], "digest")
    assert len(made.upper.rounds) == 3
    check(made, rows, 2, set())


def test_edges(spark):
    kind = "g string, id long, digest string, changed string"
    empty = merkle.build(spark.createDataFrame([], kind), "g", ["id"], "digest")
    assert merkle.root(empty) is None and merkle.prove(empty, "digest", "changed").count() == 0
    one = merkle.prove(merkle.build(spark.createDataFrame([("a", 1, sha("x"), None)], kind), "g", ["id"], "digest"), "digest", "changed").first()
    assert one["root"] == one["subroot"] == one["folded_root"] == sha("x") and one["proof_sha256"] == sha()
    twice = [(None, None, sha("x"), None), (None, None, sha("x"), None), (None, 1, sha("y"), None)]
    rows = merkle.prove(merkle.build(spark.createDataFrame(twice, kind), "g", ["id"], "digest"), "digest", "changed").collect()
    assert len(rows) == 3 and {r["root"] for r in rows} == {sha(sha("x"), sha("x"), sha("y"))} and all(r["verified"] for r in rows)


def test_field_text(spark):
    row = spark.createDataFrame([(None, "", "é\n", 12)], "a string, b string, c string, d long")
    texts = row.select(*[merkle.field_text(F.col(c)).alias(c) for c in "abcd"]).first()
    assert tuple(texts) == ("-", "0:", "3:é\n", "2:12")
    digest = row.withColumn("tree", F.lit(1)).select(merkle.leaf_digest([F.col(c) for c in "abcd"])).first()[0]
    assert digest == sha("-0:3:é\n2:12")
