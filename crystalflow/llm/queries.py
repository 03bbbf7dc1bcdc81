"""The operators of this subpackage as registered queries over the supplied tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from crystalflow.llm import (
    classifier, html_extract, jaccard, language, line_dedup, merkle, packing, page_layouts, rules, sharding, token_files, tokens, top_k,
    trie_bpe, whitening,
)
from crystalflow.operators.scratch import new_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as power-of-two pieces, each a sequence of its own."""
    docs = _table(spark, sf_dir, "documents")
    packed = packing.pack(docs, public_tokenizers.path(BYTE_BPE), keep={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents, and the verdict of the likelihood ratio."""
    docs = _table(spark, sf_dir, "documents")
    judged = rules.judge(docs, rules.fit(docs, _table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept", "ratio")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from labels outside the held-out fifth."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    weights = classifier.fit(docs, labels.where(~held_out))
    return classifier.score(docs, weights).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and of what they decode to."""
    docs = _table(spark, sf_dir, "documents")
    encoded = trie_bpe.encode(docs, public_tokenizers.path(BYTE_BPE), decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to flat files and read back."""
    folder = new_path(spark, "tokens")
    token_files.write_tokens(
        _table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_BPE), tokens.WORD_END, end_id=1
    )
    return token_files.read_tokens(spark, folder, with_ids=False)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "langs")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes, equal texts together."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best partners of every hundredth vector among all vectors."""
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    found = jaccard.near_duplicates(_table(spark, sf_dir, "documents"), count_links=False)
    return found.select("doc_id", "n_shingles", "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of repeated three-line windows."""
    cleaned = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_removed")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four components of most variance, whitened."""
    rows = whitening.integers(_table(spark, sf_dir, "embeddings"))
    model = whitening.fit(rows, 4)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]).cast("array<double>")
    each = whitening.whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, learned from layouts filled with the corpus's words."""
    field = html_extract.fit(page_layouts.labelled_pages(_table(spark, sf_dir, "documents")))
    # ids are not given to operators that keep one column alone
    pages = _table(spark, sf_dir, "pages").withColumn("key", F.struct("page_id", "url"))
    return html_extract.extract(pages, field, "key").select("key.page_id", "key.url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and checked proof of every document; every third id is checked against a tampered text."""
    docs = _table(spark, sf_dir, "documents")
    names = ("doc_id", "source", "lang", "n_chars")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = merkle.leaf_digest([*map(F.col, names), F.translate("text", upper, lower)])
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select("doc_id", "lang", merkle.leaf_digest([*map(F.col, names), F.col("text")]).alias("leaf"), F.when(hit, tampered).alias("changed"))
    proved = merkle.prove(merkle.build(leaves, "lang", ["doc_id"], "leaf"), "leaf", "changed")
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_quality_rules, op3_quality_classifier, op4_trie_bpe, op5_token_files, op6_language_id, op7_sharding,
    op8_top_k, op9_jaccard, op10_line_dedup, op11_whitening, op12_html, op13_merkle,
)}

SQL = {
    "op8_top_k": """
WITH ints AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                       list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS score
                FROM ints q JOIN ints c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
""",
    "op9_jaccard": r"""
WITH RECURSIVE split AS (
       SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     shingles AS (
       SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM split),
     sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
     shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
                FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
     links AS (SELECT a, b FROM shared JOIN sizes i ON i.doc_id = a JOIN sizes j ON j.doc_id = b
               WHERE 100 * shared.n >= 80 * (i.n + j.n - shared.n)),
     ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
     reach AS (SELECT doc_id, doc_id AS other FROM documents
               UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON r.other = w.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY ALL
""",
    "op10_line_dedup": r"""
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
     line AS (SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM split),
     windows AS (SELECT doc_id, i, lines[i + 1] || chr(10) || lines[i + 2] || chr(10) || lines[i + 3] AS w
                 FROM line WHERE i + 3 <= len(lines)),
     ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows),
     covered AS (SELECT DISTINCT doc_id, i + k AS i FROM ranked, range(3) AS t(k) WHERE nth > 1),
     kept AS (SELECT l.doc_id, string_agg(l.lines[l.i + 1], chr(10) ORDER BY l.i) AS text
              FROM line l ANTI JOIN covered c ON l.doc_id = c.doc_id AND l.i = c.i GROUP BY l.doc_id),
     gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT s.doc_id, CASE WHEN g.n IS NULL THEN s.text ELSE coalesce(k.text, '') END AS text,
       CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed
FROM split s LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op13_merkle": r"""
WITH RECURSIVE fields AS (
       SELECT doc_id, lang, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS f, text,
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
              xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
                lambda acc, b: list_reduce(range(8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, b)),
                4294967295), 4294967295) % 3 = 0 AS hit
       FROM documents),
     digests AS (
       SELECT doc_id, lang, hit,
              sha256(array_to_string(list_transform(f || [text], lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS leaf,
              sha256(array_to_string(list_transform(f || [lowered], lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS changed
       FROM fields),
     leaves AS (
       SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
              dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM digests),
     nodes AS (
       SELECT tree, 0 AS level, i, n, leaf AS h FROM leaves
       UNION ALL
       SELECT tree, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
       GROUP BY tree, level, n, i // 8),
     subroots AS (SELECT tree, level, h FROM nodes WHERE n = 1),
     tops AS (
       SELECT 0 AS level, tree AS i, (SELECT count(*) FROM subroots) AS n, h FROM subroots
       UNION ALL
       SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1
       GROUP BY level, n, i // 8),
     joined AS (
       SELECT tree, level, i, n, h FROM nodes WHERE n > 1
       UNION ALL
       SELECT s.tree, s.level + t.level, t.i, t.n, t.h FROM subroots s, tops t WHERE t.n > 1),
     own AS (
       SELECT l.tree, l.i AS leaf_i, g.level,
              CASE WHEN g.level < s.level THEN l.i // CAST(pow(8, g.level) AS BIGINT)
                   ELSE l.tree // CAST(pow(8, g.level - s.level) AS BIGINT) END AS k
       FROM leaves l JOIN subroots s USING (tree) JOIN (SELECT DISTINCT tree, level FROM joined) g USING (tree)),
     steps AS (
       SELECT o.tree, o.leaf_i, o.level,
              coalesce(string_agg(j.h, '' ORDER BY j.i) FILTER (j.i < o.k), '') AS before,
              coalesce(string_agg(j.h, '' ORDER BY j.i) FILTER (j.i > o.k), '') AS after
       FROM own o JOIN joined j ON j.tree = o.tree AND j.level = o.level AND j.i // 8 = o.k // 8
       GROUP BY o.tree, o.leaf_i, o.level),
     proofs AS (SELECT tree, leaf_i, sha256(string_agg(before || after, '' ORDER BY level)) AS p FROM steps GROUP BY tree, leaf_i),
     folds AS (
       SELECT tree, i, 0 AS level, CASE WHEN hit THEN changed ELSE leaf END AS h FROM leaves
       UNION ALL
       SELECT f.tree, f.i, f.level + 1, sha256(s.before || f.h || s.after)
       FROM folds f JOIN steps s ON s.tree = f.tree AND s.leaf_i = f.i AND s.level = f.level),
     ends AS (SELECT tree, i, arg_max(h, level) AS h FROM folds GROUP BY tree, i)
SELECT l.doc_id, l.leaf, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(p.p, sha256('')) AS proof_sha256,
       e.h AS folded_root, e.h = (SELECT h FROM tops WHERE n = 1) AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN ends e ON e.tree = l.tree AND e.i = l.i
     LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_i = l.i
""",
}
