"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from crystalflow.llm import classifier, jaccard, language, line_dedup, packing, rules, sharding, token_files, tokens, top_k, trie_bpe
from crystalflow.operators.scratch import new_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
TEXTS = {
    0: None,
    1: "",
    2: " \n\n\t ",
    3: LONG,
    4: "one two three four five six seven eight nine ten eleven\nsecond line here\nthird line here\nfourth",
    5: "one two three four five six seven eight nine ten eleven\nsecond line here\nthird line here\nfourth",
    6: "áb c 　 \U0001f600 <|endoftext|> x  y   z\u0000",
    7: "!!! ???",
}
CLASHING = "id long, set_id long, bucket int, start long, slot long, label int, n long, ids string, dedup_id long, n_removed long, quality int, band int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else None, "s", len(t or "")) for k, t in TEXTS.items()]
    rows += [rows[4], (None, "a text without an id of its own", None, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = [c.split() for c in CLASHING.split(", ")]
    return plain.withColumns({n: F.lit(1).cast({"long": "bigint"}.get(t, t)) for n, t in extra})


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(3, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 0), (3, 1, 0), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


OPERATORS = {
    "packing": lambda d, _: packing.pack(d, BYTE),
    "rules": lambda d, lab: rules.judge(d, rules.fit(d, lab)),
    "classifier": lambda d, lab: classifier.score(d, classifier.fit(d, lab)),
    "trie_bpe": lambda d, _: trie_bpe.encode(d, BYTE, decoded=True),
    "language": lambda d, _: language.identify(d, language.fit(d)),
    "sharding": lambda d, _: sharding.shard(d, 4),
    "line_dedup": lambda d, _: line_dedup.dedup_lines(d),
    "jaccard": lambda d, _: jaccard.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"packing", "jaccard"}))
def test_every_row_comes_out_once(docs, labels, name):
    out = [r["doc_id"] for r in OPERATORS[name](docs, labels).collect()]
    assert sorted(map(str, out)) == sorted(map(str, [*TEXTS, 4, None]))


def test_packing(docs):
    pieces = OPERATORS["packing"](docs, None).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    assert [(p["start"], p["length"], bytes(p["ids"])) for p in by_doc[0]] == [(0, 1, b"\0\0\0\0")]
    assert len(by_doc[4]) == 2 * len(by_doc[5])
    assert sorted(p["sequence_id"] for p in pieces) == list(range(len(pieces)))
    assert {p["length"] for p in by_doc[3]} >= {1024}


def test_language(docs):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in OPERATORS["language"](docs, None).collect()}
    assert [found[k] for k in (0, 1, 2, 7)] == [("und", 0.0)] * 4
    assert found[4][0] == "en"


def test_rules(docs, labels):
    found = {r["doc_id"]: r for r in OPERATORS["rules"](docs, labels).collect()}
    for k in (0, 1, 2):
        assert found[k]["n_words"] == 0 and found[k]["base_failed"] and not found[k]["kept"]
    assert found[7]["n_words"] == 2
    assert found[6]["word_chars"] == sum(len(w) for w in "áb c 　 \U0001f600 <|endoftext|> x y z\u0000".split(" "))


def test_classifier_without_labels(docs, labels):
    weights = classifier.fit(docs, labels.limit(0))
    assert {r["score"] for r in classifier.score(docs, weights).collect()} == {0.5}


def test_sharding(docs):
    rows = OPERATORS["sharding"](docs, None).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    shard_of = {}
    for r in rows:
        shard_of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())
    assert {r["doc_id"]: r["size"] for r in rows}[0] == 1


def test_line_dedup(docs):
    found = {}
    for r in OPERATORS["line_dedup"](docs, None).collect():
        found.setdefault(r["doc_id"], []).append((r["text"], r["n_removed"]))
    assert found[0] == [(None, 0)] and found[1] == [("", 0)]
    assert found[4] == [(TEXTS[4], 0)] * 2  # rows of one id are one document
    assert found[5] == [("", 4)]


def test_jaccard(docs):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in OPERATORS["jaccard"](docs, None).collect()}
    assert None not in found
    assert [found[k] for k in (0, 1, 2)] == [(0, 0), (0, 1), (0, 2)]
    assert found[7] == (1, 7) and found[5][1] == 4 and found[3][1] == 3


def test_token_files(spark, docs):
    folder = new_path(spark, "tokens")
    token_files.write_tokens(docs, folder, WORD, tokens.WORD_END, end_id=1)
    rows = token_files.read_tokens(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [0, 1, 2, 3, 4, 4, 5, 6, 7]
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist()
    assert all(np.frombuffer(bytes(r["ids"]), "<u4")[-1] == 1 for r in rows)
    empty = new_path(spark, "tokens")
    token_files.write_tokens(docs.limit(0), empty, WORD, tokens.WORD_END, end_id=1)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_decode(spark, docs):
    encoded = trie_bpe.encode(docs, BYTE)
    back = {r["doc_id"]: r["text"] for r in trie_bpe.decode(encoded, BYTE).collect()}
    assert all(back[k] == (t or "") for k, t in TEXTS.items())
    odd = spark.createDataFrame([(1, None), (2, [222])], "doc_id long, ids array<int>")
    assert [r["text"] for r in trie_bpe.decode(odd, BYTE).orderBy("doc_id").collect()] == ["", "�"]


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [-1.0]), (9, []), (1, [1.0, 0.0]), (100, [1.0, -0.0005])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("bucket", F.lit(1))
    found = top_k.top_k(vectors, F.col("vec_id") % 100 == 0, 4).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found}
    one = 1024 * 1024
    assert [got[0, r] for r in (1, 2, 3, 4)] == [(1, one), (1, one), (2, one), (100, one)]
    assert [got[100, r] for r in (1, 2, 3, 4)] == [(0, one), (1, one), (1, one), (2, one)]
    assert top_k.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_pipeline_stages(spark, docs, labels, tmp_path):
    """What each stage keeps of the odd rows, given all of them."""
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = {}
    for name, stage in stages.items():
        out = stage(spark, docs, str(tmp_path))
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.columns == out.columns and empty.count() == 0
        assert name == "packing" or out.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = out.collect()
    ids = {name: sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) for name, rows in kept.items()}
    assert not {0, 1, 2, 7} & set(ids["language_id"])  # null, empty or without letters
    assert 3 in ids["language_id"]  # its trigrams are nearly all that was learned
    short = stages["language_id"](spark, docs.where("doc_id <> 3"), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in short) == [4, 4, 5]
    assert not {0, 1, 2, 6, 7} & set(ids["quality_rules"])  # too few words
    assert ids["line_dedup"] == [0, 1, 2, 3, 4, 4, 6, 7]  # 5 is left without a word
    assert len(kept["line_dedup"]) == 9  # the row without an id stays
    assert ids["jaccard_join"] == [0, 1, 2, 3, 4, 4, 6, 7] and len(kept["jaccard_join"]) == 8
    texts = {r["doc_id"]: r["text"] for r in kept["jaccard_join"]}
    assert all(texts[k] == TEXTS[k] for k in texts)
    assert {r["doc_id"] for r in kept["packing"]} == {None, *TEXTS}
    assert all(len(r["ids"]) == 4 * r["length"] for r in kept["packing"])
