"""Op4, op5, pipeline: fewer pieces to encode, and ids that do not travel with the numbering of their pieces."""

from __future__ import annotations

import random
import shutil

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crystalflow.llm import helpers, packing, tokens, trie_bpe
from crystalflow.llm.tokens import BYTE_LEVEL, WORD_END, WordEncoder, packed

PARTS = [
    "a", "Bc", "É", "ß", " ", "  ", "\n", "\n\n", "\r\n", "\t", ".", ",", "'s", "1", "<|endoftext|>",
    "İ", "ſ", "é", "́", "\x1c", "\x1f", "\x85", "\xa0", " ", "Σ", "ﬁ", "日本",
]


@pytest.mark.parametrize("name, splitter", [("word_bpe_49k.json", WORD_END), ("byte_bpe_50k.json", BYTE_LEVEL)])
def test_cuts_at_white_space_keep_the_ids(name, splitter):
    draw = random.Random(5)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(1, 14))) for _ in range(5000)]
    encoder = WordEncoder(public_tokenizers.path(name), splitter)
    expected = [packed(e.ids) for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == expected


@pytest.mark.parametrize("name, splitter", [("word_bpe_49k.json", WORD_END), ("byte_bpe_50k.json", BYTE_LEVEL)])
def test_words_on_both_sides_of_a_line_end_are_encoded_once(name, splitter):
    encoder = WordEncoder(public_tokenizers.path(name), splitter)
    words = ["alpha", "beta", "gamma", "delta"]
    encoder.encode([f"{a}\n{b} {c}\n{d}" for a in words for b in words for c in words for d in words])
    computed = []
    known, encoder.model = encoder.model, lambda word: computed.append(word) or known(word)
    encoder.encode([f"the {a}\n{b}\n{c}" for a in words for b in words for c in words])
    assert len(computed) <= 1


def test_later_tasks_of_a_worker_know_the_words(tmp_path):
    """op1_packing: every task read the file and encoded all words anew, which was most of its CPU time."""
    path = str(tmp_path / "tokenizer.json")
    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), path)
    first = tokens.worker_encoder(path, BYTE_LEVEL)
    ids = first.encode(["some words here"])
    later, computed = tokens.worker_encoder(path, BYTE_LEVEL), []
    later.model = computed.append
    assert later.encode(["some words here"]) == ids and not computed
    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), path)  # a new file is a new encoder
    assert tokens.worker_encoder(path, BYTE_LEVEL) is not later


def test_a_word_is_encoded_once_before_any_line_start():
    """op1_packing: words on two sides of a line end were one piece, looked up and cut for every pair."""
    encoder = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL)
    words = ["alpha.", "beta,", "gamma", "Delta", "é"]
    texts = [f"x {a}\n{b}" for a in words for b in words] + ["x alpha. \nbeta, \n gamma\n\nDelta"]
    assert encoder.encode(texts) == [packed(encoder.tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert len(encoder.led) < 20


def test_numbering_does_not_carry_wide_columns(spark, monkeypatch):
    written = []
    kept = helpers.materialise
    monkeypatch.setattr(helpers, "materialise", lambda df: written.append(df.columns) or kept(df))
    docs = spark.createDataFrame([(i, "some words " * (i % 7)) for i in range(200)], "doc_id long, text string")
    packs = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    assert sum("ids" in columns for columns in written) == 1
    plain = packing.pack(docs.repartition(5), public_tokenizers.path("byte_bpe_50k.json"), keep={"ids_crc32": F.crc32("ids")})
    key = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "bucket", "ids_crc32"]
    rows = packs.withColumn("ids_crc32", F.crc32("ids")).select(key).collect()
    assert sorted(rows) == sorted(plain.select(key).collect())
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))


def test_trie_cuts_keep_the_ids_and_texts(monkeypatch):
    """op4_trie_bpe: cut at line ends, put together from words and marks, decoded by batch; also with little remembered."""
    monkeypatch.setattr(trie_bpe, "STEPS_KEPT", 50)
    monkeypatch.setattr(trie_bpe, "PAIRS_KEPT", 50)
    draw = random.Random(6)
    texts = ["".join(draw.choices([*PARTS, " ", " ", "\n", "alpha", "Beta.", "éa,"], k=draw.randint(0, 20))) for _ in range(3000)]
    encoder = trie_bpe.TrieEncoder(public_tokenizers.path("byte_bpe_50k.json"), keep=60)
    library = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL).tokenizer
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    lists = [encoder.encode_all(texts[k : k + 40]) for k in range(0, len(texts), 40)]
    assert [ids for batch in lists for ids in batch.to_pylist()] == expected
    assert [t for batch in lists for t in encoder.decode_all(batch).to_pylist()] == texts
    odd = [[draw.randrange(50257) for _ in range(4)] for _ in range(300)] + [[]]  # not all UTF-8
    decoded = encoder.decode_all(pa.array(odd, pa.list_(pa.int32())).slice(7))
    assert decoded.to_pylist() == [library.decode(ids, skip_special_tokens=False) for ids in odd[7:]]
    assert encoder.encode_all([]).to_pylist() == [] and encoder.encode_all([None, ""]).to_pylist() == [[], []]


def test_trie_walks_a_word_once_beside_line_ends_and_marks():
    """op4_trie_bpe: pieces with a line end or a mark had their words walked again for every new neighbour."""
    encoder = trie_bpe.TrieEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL).tokenizer
    words = ["alphaxq", "betaxq", "gammaxq", "deltaxq"]
    walked, walk = [], encoder.encode_words
    encoder.encode_words = lambda given: walked.extend(given := set(given)) or walk(given)
    for a in words:
        for b in words:
            texts = [f"x {a}\n{b} {b}. {a},", f"x {a}\n{b}! {b}; {a}"]
            assert encoder.encode(texts) == [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(walked) == len(set(walked))


def test_later_tasks_of_a_worker_know_the_trie_words(tmp_path):
    """op4_trie_bpe: every task read the file and walked all words anew."""
    path = str(tmp_path / "tokenizer.json")
    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), path)
    first = trie_bpe.worker_encoder(path)
    ids = first.encode(["some words here"])
    later, walked = trie_bpe.worker_encoder(path), []
    walk, later.encode_words = later.encode_words, lambda given: walked.extend(given := set(given)) or walk(given)
    assert later.encode(["some words here"]) == ids and not walked
    shutil.copy(public_tokenizers.path("byte_bpe_50k.json"), path)  # a new file is a new encoder
    assert trie_bpe.worker_encoder(path) is not later


def test_the_trie_does_not_remember_long_pieces():
    """op4_trie_bpe: what a worker keeps is bounded in bytes, also for texts without spaces."""
    encoder = trie_bpe.TrieEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    library = tokens.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), BYTE_LEVEL).tokenizer
    long = ["日本" * 300, "ab" * 300, "ab" * 300 + ",", "a-" * 300]
    texts = [*long, *(f"x {p} y\n{p}" for p in long), f"x  y \n {long[2]}"]
    expected = [packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(3):
        assert encoder.encode(texts) == expected
        kept = [encoder.led, encoder.bare, encoder.led.old, encoder.bare.old]
        assert max(len(piece) for pieces in kept for piece in pieces) <= trie_bpe.LONG


def test_small_batches_share_one_trie():
    """op4_trie_bpe: Spark's batches of 500 rows were each a trie of their own."""
    rows = [pa.RecordBatch.from_pydict({"id": [k], "text": ["word " * (k % 9)]}) for k in range(100)]
    size = 10 * max(b.nbytes for b in rows)
    together = list(trie_bpe._gathered(rows, size))
    assert len(together) <= 20 and all(b.nbytes <= size for b in together)
    assert [k for b in together for k in b.column("id").to_pylist()] == list(range(100))
    assert list(trie_bpe._gathered([], size)) == []
