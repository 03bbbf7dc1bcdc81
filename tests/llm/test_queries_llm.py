"""The registered queries against SQL, the tokenizers library or plain loops, on the small tables."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from compare import connect, differences

import __spark_entry__ as driver
import corpus_pipeline
from crystalflow.llm import jaccard, queries

SMALL = driver.SMALL
QUERIES = queries.QUERIES
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


def encoded(name, texts):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    found = tokenizer.encode_batch(list(texts.values()), add_special_tokens=False)
    return tokenizer, {k: e.ids for k, e in zip(texts, found, strict=True)}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), queries.SQL[name]) is None


def test_op1(spark, texts):
    _, ids = encoded("byte_bpe_50k.json", texts)
    rows = QUERIES["op1_packing"](spark, SMALL).collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
    assert parts.keys() == ids.keys()
    for k, own in parts.items():
        whole, at = [*ids[k], 0], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(whole) and r["length"] & (r["length"] - 1) == 0
            assert r["ids_crc32"] == crc(whole[at : at + r["length"]])
            at += r["length"]
        assert at == len(whole)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    by_id = sorted(rows, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_id] == sorted((r["length"] for r in rows), reverse=True)


def test_op2(spark, texts):
    for r in QUERIES["op2_quality_rules"](spark, SMALL).collect():
        text = texts[r["doc_id"]]
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_op2_keeps_good_and_rejects_bad(spark):
    quality = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = QUERIES["op2_quality_rules"](spark, "/root/testdata/sf0.01").where("NOT base_failed").collect()
    judged = [(quality[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in quality]
    assert sum(bool(q) == k for q, k in judged) >= 0.98 * len(judged)


def test_op3_held_out(spark):
    quality = dict(duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall())
    rows = QUERIES["op3_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(quality[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in quality]
    assert sum(q == p for q, p in held) >= 0.95 * len(held)


def test_op4(spark, texts):
    tokenizer, ids = encoded("byte_bpe_50k.json", texts)
    rows = {r["doc_id"]: r for r in QUERIES["op4_trie_bpe"](spark, SMALL).collect()}
    assert rows.keys() == ids.keys()
    for k, r in rows.items():
        decoded = tokenizer.decode(ids[k], skip_special_tokens=False)
        assert r["n_tokens"] == len(ids[k])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids[k])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_op5(spark, texts):
    _, ids = encoded("word_bpe_49k.json", texts)
    start = 0
    expected = set()
    for k in sorted(ids):
        whole = [*ids[k], 1]
        expected.add((k, start, len(whole), crc(whole)))
        start += len(whole)
    rows = QUERIES["op5_token_files"](spark, SMALL).collect()
    assert {(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected


def test_op6_held_out(spark):
    lang = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) >= 0.97 * len(held)


def test_op7(spark, texts):
    rows = QUERIES["op7_sharding"](spark, SMALL).collect()
    sizes, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[data].add(r["shard"])
    assert len(rows) == len(texts) and all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 16 + max(len(t.encode()) + 1 for t in texts.values())


def jaccard_components(texts):
    lower = {c: c + 32 for c in range(65, 91)}
    sets = {}
    for k, t in texts.items():
        words = WORD.findall((t or "").translate(lower))
        sets[k] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    where, root = defaultdict(list), {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k, own in sorted(sets.items()):
        for other, overlap in Counter(o for s in own for o in where[s]).items():
            if 100 * overlap >= 80 * (len(own) + len(sets[other]) - overlap):
                a, b = sorted((find(k), find(other)))
                root[b] = a
        for s in own:
            where[s].append(k)
    return {k: (len(s), find(k)) for k, s in sets.items()}


@pytest.mark.parametrize("tile_rows", [jaccard.TILE_ROWS, 2])
def test_op9(spark, texts, tile_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile_rows)
    rows = QUERIES["op9_jaccard"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == jaccard_components(texts)


def test_pipeline(spark, texts):
    """Each stage held against a plain loop over what the stage before it kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert seen["language_id"].keys() == texts.keys()  # all have a language
    assert seen["quality_rules"].keys() <= seen["language_id"].keys()
    first, cleaned = {}, {}
    for k, text in sorted(seen["quality_rules"].items()):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if first.setdefault(window, (k, i)) != (k, i):
                gone |= {i, i + 1, i + 2}
        cleaned[k] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    # a document goes if words stood in it and none is left
    emptied = {k for k, t in cleaned.items() if not t.split() and seen["quality_rules"][k].split()}
    cleaned = {k: t for k, t in cleaned.items() if k not in emptied}
    assert emptied and seen["line_dedup"] == cleaned
    kept = {k for k, (_, root) in jaccard_components(cleaned).items() if k == root}
    assert seen["jaccard_join"].keys() == kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in packed} == kept
