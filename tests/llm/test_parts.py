"""The operators' parts against brute force, on random inputs."""

from __future__ import annotations

import itertools
import os
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from crystalflow.llm import components, helpers, jaccard, language, packing, rules, sharding, tokens, top_k, trie_bpe

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = list("aAbBzé ß'\n\t  .,!<|>019٣Σσς字漢\U0001f600́\xa0\x1c\x85 　İ") + [
    "<|endoftext|>", "<|startoftext|>", "'s", "'ll", " the", "ing", "ΟΔΟΣ", "   ", "\n \n",
]


def odd_texts(n):
    draw = random.Random(5)
    return ["".join(draw.choices(ODD, k=draw.randrange(50))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word pieces", "word ends", "trie"])
def test_encoders_equal_the_library(name):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder, path = {
        "word pieces": (tokens.WordEncoder(BYTE, tokens.BYTE_LEVEL, keep=40), BYTE),
        "word ends": (tokens.WordEncoder(WORD, tokens.WORD_END, keep=40), WORD),
        "trie": (trie_bpe.TrieEncoder(BYTE, keep=40), BYTE),
    }[name]
    texts = odd_texts(4000)
    library = Tokenizer.from_file(path)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [list(np.frombuffer(ids, "<u4")) for k in range(0, len(texts), 50) for ids in encoder.encode(texts[k : k + 50])]
    assert got == expected
    assert encoder.encode([None, ""]) == [b"", b""]
    if name == "trie":
        draw = random.Random(1)
        for ids in [*expected[:500], *[[draw.randrange(50257) for _ in range(5)] for _ in range(500)]]:
            assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_piece_lengths():
    for n, longest in itertools.product(range(200), (1, 4, 64)):
        lengths = packing.piece_lengths(n, longest)
        assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
        assert all(k & (k - 1) == 0 and k <= longest for k in lengths)
        assert len(lengths) == n // longest + bin(n % longest).count("1")


def test_minimax_equals_brute_force():
    draw = random.Random(3)
    for _ in range(200):
        sizes = [draw.randrange(1, 30) for _ in range(draw.randrange(1, 9))]
        shards = draw.randrange(1, 5)
        best = min(
            max(sum(sizes[a:b]) for a, b in zip((0, *cuts), (*cuts, len(sizes)), strict=True))
            for k in range(min(shards, len(sizes)))
            for cuts in itertools.combinations(range(1, len(sizes)), k)
        )
        capacity, ends = sharding.minimax_cuts(np.array(sizes), shards)
        assert capacity == best and ends[-1] == len(sizes) and len(ends) <= shards
    assert sharding.minimax_cuts(np.array([], int), 4) == (0, [])


def test_minimax_fills_every_shard():
    draw = random.Random(4)
    for _ in range(500):
        sizes = np.array([draw.choice((1, 2, 9, 60)) for _ in range(draw.randrange(1, 20))])
        shards = draw.randrange(1, 9)
        capacity, ends = sharding.minimax_cuts(sizes, shards)
        held = [sizes[a:b].sum() for a, b in zip((0, *ends[:-1]), ends, strict=True)]
        assert capacity == max(held) == sharding.least_capacity(sizes, shards)
        assert len(held) == min(shards, len(sizes)) and min(held) > 0 and sum(held) == sizes.sum()


@pytest.mark.parametrize("place", [0, 1, 4000, 9998, 9999])
def test_an_oversized_atom_leaves_no_shard_empty(place):
    sizes = np.full(10_000, 100)
    sizes[place] = 500_000  # a third of all
    capacity, ends = sharding.minimax_cuts(sizes, 16)
    held = sorted(sizes[a:b].sum() for a, b in zip((0, *ends[:-1]), ends, strict=True))
    assert capacity == held[-1] == 500_000 and len(held) == 16
    if place in (0, 9999):
        assert held[-2] - held[0] <= 100
    elif place == 4000:
        assert held[-2] <= 70_000 and held[0] >= 60_000


def test_no_shard_is_empty_with_one_text_in_a_third_of_the_rows(spark):
    copy = F.when(F.col("id") % 3 == 0, F.lit("the same text each time")).otherwise(F.concat(F.lit("an own text number "), "id"))
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), copy.alias("text"))
    held = {r["shard"]: r["held"] for r in sharding.shard(docs, 16).groupBy("shard").agg(F.sum("size").alias("held")).collect()}
    assert sorted(held) == list(range(16))
    others = sorted(held.values())[:-1]
    assert others[-1] <= 1.25 * others[0]


def test_bitmaps_never_underestimate():
    draw = np.random.default_rng(2)
    for _ in range(300):
        common, own_a, own_b = (draw.integers(0, 2**64, draw.integers(1, 400), dtype=np.uint64) for _ in range(3))
        a, b = np.unique(np.concatenate([common, own_a])), np.unique(np.concatenate([common, own_b]))
        exact = len(np.intersect1d(a, b))
        assert jaccard.most_overlap(jaccard.bitmap(a), jaccard.bitmap(b), len(a), len(b)) >= exact
    same = np.unique(common)
    assert jaccard.most_overlap(jaccard.bitmap(same), jaccard.bitmap(same), len(same), len(same)) == len(same)


def test_leading_shingles_meet():
    """Two sets at the threshold share one of their leading elements in any common order."""
    draw = random.Random(7)
    for _ in range(300):
        n = draw.randrange(1, 40)
        a = set(range(n))
        b = set(draw.sample(sorted(a), max(1, n - draw.randrange(4)))) | {100 + i for i in range(draw.randrange(4))}
        if jaccard.is_link(len(a & b), len(a), len(b), 80):
            rank = {x: draw.random() for x in a | b}
            first = lambda s: set(sorted(s, key=rank.get)[: jaccard.leading(len(s), 80)])  # noqa: E731, B023
            assert first(a) & first(b)


def test_coordinates_keep_every_close_vector():
    draw = np.random.default_rng(4)
    unit = draw.normal(size=(500, 12))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    order, ranked = np.argsort(unit, axis=0).T, np.sort(unit, axis=0).T
    for query in unit[:50]:
        for cosine in (0.2, 0.6, 0.95):
            close = np.flatnonzero(unit @ query >= cosine)
            assert set(close) <= set(top_k.coordinate_candidates(unit, order, ranked, query, cosine))


@pytest.mark.parametrize("scale", [1, 10**6])
def test_top_k_equals_brute_force(spark, scale):
    draw = np.random.default_rng(6)
    lengths = np.concatenate([np.full(150, 1.0), draw.uniform(0.01, 5, 150)])
    vectors = draw.normal(size=(300, 6)) * lengths[:, None] * scale
    vectors[200:230] = vectors[10]
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": range(300), "embedding": vectors.tolist()}))
    got = top_k.top_k(frame, F.col("vec_id") % 7 == 0, 5, factor=16, bucket_rows=40, query_rows=9).collect()
    whole = np.floor(vectors * 16).astype(np.int64).astype(object)
    expected = {}
    for q in range(0, 300, 7):
        scores = sorted((-int(whole[q] @ whole[c]), c) for c in range(300) if c != q)
        expected[q] = [(c, -s) for s, c in scores[:5]]
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == expected


def test_components(spark):
    draw = random.Random(8)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 460)]
    pairs += [(900, k) for k in range(500, 560)] + [(7, 7)]
    root = {n: n for p in pairs for n in p}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components.components(links.limit(0)).count() == 0


def test_running_totals(spark):
    draw = random.Random(9)
    rows = [(draw.randrange(50) if k % 3 else 7, k, draw.randrange(9)) for k in range(500)]
    frame = spark.createDataFrame(rows, "a int, b int, n int")
    got = helpers.running_totals(frame, [F.col("a").desc(), F.col("b")], {"before": F.col("n"), "place": F.lit(1)}, rows_per_block=40)
    total, expected = 0, {}
    for place, (a, b, n) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1]))):
        expected[b] = (total, place)
        total += n
    assert {r["b"]: (r["before"], r["place"]) for r in got.collect()} == expected


def test_repeated_words():
    words = lambda text: helpers.word_hashes(text.encode().split())
    assert rules.repeated_words(words("a b c d e x a b c d e")) == 10
    assert rules.repeated_words(words("a a a a a a")) == 6
    assert rules.repeated_words(words("a b c d e f g h")) == 0


def test_mixture_finds_both_languages():
    """Two made-up languages with letters of their own."""
    draw = random.Random(10)
    speak = lambda letters, n: " ".join("".join(draw.choices(letters, k=5)) for _ in range(n))
    counts = np.column_stack([
        np.bincount(language.trigrams([speak(letters, 3000)], 4096)[0], minlength=4096) + 0.5 for letters in ("abcde", "defgh")
    ])
    model = language.Model(["x", "y"], np.log(counts / counts.sum(axis=0)).astype(np.float32))
    mixed = speak("abcde", 60) + " " + speak("defgh", 20)
    shares = language.infer([speak("abcde", 50), speak("defgh", 50), mixed, "", None, "123"], model)
    assert shares[0, 0] > 0.95 and shares[1, 1] > 0.95
    assert shares[2] == pytest.approx([0.75, 0.25], abs=0.08)
    assert not shares[3:].any()


def test_target_counts_every_trusted_document(spark):
    """With all documents trusted, both sides count the same n-grams, also beyond 16 384 documents."""
    docs = spark.range(0, 20_000, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert not rules.fit(docs, labels.unionByName(labels)).any()


def test_slots_follow_the_input():
    assert rules.slots_for(0) == rules.slots_for(10**6) == rules.SLOTS
    assert [rules.slots_for(10**9 * k) // rules.slots_for(10**9) for k in (4, 16, 64)] == [2, 4, 8]


@pytest.mark.parametrize(("tile_rows", "block_rows"), [(jaccard.TILE_ROWS, jaccard.BLOCK_ROWS), (2, 5)])
def test_every_link_is_counted(spark, monkeypatch, tile_rows, block_rows):
    """A group of texts around one centre, similar in pairs, with copies and others of many sizes."""
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    draw = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(base)] + [" ".join([*base, f"own{k}"]) for k in range(20)] + [" ".join([*base, "own3"])]
    texts += [" ".join(base[draw.randrange(25) : draw.randrange(95, 121)]) for _ in range(25)]
    sets = [frozenset(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) for t in texts]
    linked = lambda a, b: jaccard.is_link(len(a & b), len(a), len(b), 80)
    expected = {k: sum(own != other and linked(own, other) for other in set(sets)) for k, own in enumerate(sets)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["n_links"] for r in rows} == expected
    assert expected[5] >= 20
    alone = jaccard.near_duplicates(docs, count_links=False)
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(r["doc_id"], r["component_id"]) for r in alone.collect()}


def test_jaccard_groups_split_stars(spark):
    """A set with thousands of partners is dealt over many groups, and no pair is lost."""
    star = [(k, 10_000, 1) for k in range(5_000)] + [(k, k + 1, 2) for k in range(20_000, 21_000)] + [(30_000, 30_001, 3)]
    pairs = spark.createDataFrame(star, "a long, b long, root long")
    rows = jaccard._groups(pairs, rows=100).collect()
    assert sorted((r["a"], r["b"]) for r in rows) == sorted((a, b) for a, b, _ in star)
    sizes = {}
    for r in rows:
        sizes[r["group"]] = sizes.get(r["group"], 0) + 1
    assert max(sizes.values()) <= 300


def test_language_evidence():
    """Texts in any mixture of learned languages are explained; letters at random and unknown alphabets are not."""
    rng = np.random.default_rng(5)
    speak = lambda letters, n: " ".join("".join(rng.choice(list(letters), 3)) for _ in range(n))
    counts = np.full((language.SLOTS, 3), language.SMOOTHING)
    for k, letters in enumerate(("abc", "def", "ghi")):
        np.add.at(counts[:, k], language.trigrams([speak(letters, 3000)], language.SLOTS)[0], 1)
    model = language.Model(["a", "d", "g"], np.log(counts / counts.sum(axis=0)).astype(np.float32))
    texts = [speak("abc", 40), " ".join(speak(x, 30) for x in ("abc", "def", "ghi")), speak("klmnopqrstuvwxyz", 60), "привет мир и люди", "", None]
    shares, evidence = language.infer_with_evidence(texts, model)
    assert evidence[0] > 0 and evidence[1] > 0 and evidence[2] < 0 and evidence[3] < 0
    assert evidence[4] == evidence[5] == 0
    assert (shares[1] > 0.2).all()  # three even languages
