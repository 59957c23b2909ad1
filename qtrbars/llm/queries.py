"""The numbered operators as queries over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (exact_copies, filter_audit, fingerprints, jaccard, langid, packing, pieces, prefix_trie, quality, sharding,
               substring_bytes, substring_words, topk)

#: One in so many texts of each Arrow batch is held against the sentencepiece library.
VERIFY = 8
SHARDS = [f"shard-{i:03d}" for i in range(64)]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def model_path() -> str:
    """Path of the vocabulary file, from the package that ships it."""
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of several permitted lengths."""
    return packing.pack_documents(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(documents(spark, sf_dir))
    return found.select("row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.classify(documents(spark, sf_dir), labels)
    return found.select("row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "score", "predicted")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_bytes.removal(documents(spark, sf_dir))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard."""
    return sharding.assign_shards(documents(spark, sf_dir).select("doc_id", "n_chars"), "doc_id", SHARDS)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_words.removal(documents(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(documents(spark, sf_dir), model_path(), verify=VERIFY)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_copies.copies(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(filter_audit.mask_counts(documents(spark, sf_dir), labels))


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_language_id, op3_ngram_jaccard, op4_quality_classifier, op5_document_fingerprints, op6_suffix_dedup, op7_exact_topk, op8_sharding,
                                   op9_substring_dedup, op10_sentencepiece, op11_prefix_trie, op12_exact_dedup, op13_filter_audit)}

ORACLES = {
    "op3_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        g AS (
            SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                                         ELSE array_to_string(words[k:k + 4], ' ') END AS gram
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        l AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
            FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        e AS (
            SELECT u, v FROM l JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
            WHERE 100 * c >= 75 * (x.n + y.n - c)),
        r AS (
            SELECT u, v FROM e
            UNION
            SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
               least(w.doc_id, coalesce((SELECT min(v) FROM r WHERE r.u = w.doc_id), w.doc_id)) AS component_id
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op6_suffix_dedup": r"""
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        p AS (  -- pieces of 1,000 bytes with the 49 that follow, as cutting a long text is slow
            SELECT doc_id, head, substr(h, 2 * head + 1, 2098) AS piece, least(1000, len(h) // 2 - head) AS n
            FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2, 1000)) AS head FROM d)),
        b AS (
            SELECT doc_id, head + j AS k, substr(piece, 2 * j + 1, 100) AS string
            FROM (SELECT doc_id, head, piece, unnest(range(n)) AS j FROM p)),
        f AS (
            SELECT doc_id, k, substr(string, 1, 2) AS byte,
                   len(string) = 100 AND doc_id > min(doc_id) OVER (PARTITION BY string) AS again
            FROM b),
        c AS (
            SELECT doc_id, k, byte, coalesce(max(CASE WHEN again THEN k END) OVER (PARTITION BY doc_id ORDER BY k) >= k - 49, false) AS gone
            FROM f),
        t AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY k), false) AS begins FROM c)
        SELECT d.doc_id, len(d.h) // 2 AS n_bytes, coalesce(x.n_removed, 0) AS n_removed, coalesce(x.n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(x.kept, ''))) AS kept_sha256
        FROM d LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
                   string_agg(byte, '' ORDER BY k) FILTER (NOT gone) AS kept
            FROM t GROUP BY doc_id) x ON x.doc_id = d.doc_id""",
    "op9_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS k FROM d),
        s AS (
            SELECT doc_id, k, array_to_string(words[k + 1:k + 13], ' ') AS run
            FROM (SELECT doc_id, words, unnest(range(len(words) - 12)) AS k FROM d WHERE len(words) >= 13)),
        f AS (SELECT doc_id, k, doc_id > min(doc_id) OVER (PARTITION BY run) AS again FROM s),
        c AS (
            SELECT w.doc_id, w.k, word,
                   coalesce(max(CASE WHEN again THEN w.k END) OVER (PARTITION BY w.doc_id ORDER BY w.k) >= w.k - 12, false) AS gone
            FROM w LEFT JOIN f ON f.doc_id = w.doc_id AND f.k = w.k)
        SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(x.n_removed, 0) AS n_removed,
               sha256(coalesce(x.kept, '')) AS kept_sha256
        FROM d LEFT JOIN (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept
            FROM c GROUP BY doc_id) x ON x.doc_id = d.doc_id""",
    "op7_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
        r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
                   AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
        c AS (
            SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(CAST(len(r) AS VARCHAR) || ':' || r || x)) AS xs,
                   CAST(xor(list_reduce(
                       list_prepend(CAST(4294967295 AS BIGINT),
                                    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                       lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                                     lambda v, z: xor(v >> 1, CAST(3988292384 AS BIGINT) * (v & 1)))),
                       CAST(4294967295 AS BIGINT)) % 6 AS INTEGER) AS h
            FROM t GROUP BY conv_id),
        s AS (
            SELECT c.conv_id, list_concat(coalesce(list_slice(b.xs, 1, c.h), []), list_slice(c.xs, c.h + 1, len(c.xs))) AS xs
            FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
        m AS (
            SELECT conv_id, depth, list_slice(xs, 1, depth) AS prefix, depth = len(xs) AS ends
            FROM (SELECT *, unnest(range(len(xs) + 1)) AS depth FROM s)),
        n AS (
            SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   coalesce(len(prefix[depth].x), 0) AS chars,
                   coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
            FROM m GROUP BY prefix, depth),
        k AS (
            SELECT list_slice(prefix, 1, depth - 1) AS prefix, depth - 1 AS depth, count(*) AS n_children
            FROM n WHERE depth > 0 GROUP BY ALL),
        a AS (
            SELECT n.*, coalesce(k.n_children, 0) AS n_children
            FROM n LEFT JOIN k ON n.depth = k.depth AND n.prefix = k.prefix),
        u AS (
            SELECT list_slice(prefix, 1, d) AS prefix, d AS depth, sum(CAST(n_children = 0 AS INTEGER)) AS n_leaves,
                   sum((n_convs - 1) * chars) AS saved_tokens
            FROM (SELECT *, unnest(range(depth + 1)) AS d FROM a) GROUP BY ALL)
        SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children,
               CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens,
               sha256(a.ids) AS ends_sha256
        FROM a JOIN u ON a.depth = u.depth AND a.prefix = u.prefix
        LEFT JOIN n p ON p.depth = a.depth - 1 AND p.prefix = list_slice(a.prefix, 1, a.depth - 1)""",
    "op12_exact_dedup": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op13_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        l AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
            FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CAST(len(words) < 200 AS INTEGER)
                   + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
                   + 4 * CAST(100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS INTEGER)
                   + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER)
                   + 16 * CAST(coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS mask
            FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        m AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask),
        x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
        o AS (
            SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
                   [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM x a, x b, x c, x d, x e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
              AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
        s AS (
            SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
            FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        r AS (
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
                   CAST(sum(CASE WHEN (mask & (earlier + bit)) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
                   CAST(sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
                   CAST(sum(CASE WHEN (mask & earlier) <> 0 AND (mask & bit) <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
                   CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                   CAST(sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
                   CAST(sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
            FROM (SELECT m.*, filter_order, step, bit, CAST(earlier AS INTEGER) AS earlier FROM m, s)
            GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r""",
}
