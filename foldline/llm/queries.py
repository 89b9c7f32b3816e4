"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.llm import (byte_bpe, chat_format, decontaminate, exact_dedup, hamming_search, hard_negatives, language_id, ngram_join, packing, prefix_trie,
                          repeated_bytes, sentence_spans, toxicity)
from foldline.llm.shared import crc_bucket


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component under Jaccard similarity 0.9 of distinct 3-word shingles."""
    return ngram_join.components_of(_table(spark, sf_dir, "documents"), words=3, percent=90)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the lexicon is learned from labels whose crc32(doc_id) mod 4 is not 2."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    bucket = crc_bucket(F.col("doc_id"), 4)
    scores = toxicity.score_documents(docs, toxicity.learn(docs, labels, bucket != 2))
    return scores.select("doc_id", (bucket == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_clauses")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text, through a bucketed digest index."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op4_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows, by Hamming distance of sign codes, of every embedding whose id is divisible by 20."""
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.top_k(rows, rows.where(F.col("id") % 20 == 0), k=10)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again by merge replay."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; dictionaries come from rows whose crc32(doc_id) mod 3 is not 1."""
    docs = _table(spark, sf_dir, "documents")
    bucket = crc_bucket(F.col("doc_id"), 3)
    found = language_id.identify(docs, language_id.learn_dictionaries(docs, bucket != 1))
    return found.select("doc_id", (bucket == 1).alias("held_out"), "lang_pred", "score", "accepted")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the test conversation -1 formatted, and what is read back from the output."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    test = spark.sql("SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    messages = turns.unionByName(test).select("conv_id", "turn", "role", chat_format.text_parts(F.col("text")).alias("parts"))
    return chat_format.digests(chat_format.format_chats(messages))


def op8_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences that a non-first repeated span of sentences covers."""
    kept = sentence_spans.drop_repeated_sentences(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.col("span_dedup.n_sentences").alias("n_sentences"), F.col("span_dedup.n_removed").alias("n_removed"), "text")


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a 200-byte string met elsewhere covers."""
    return repeated_bytes.digests(repeated_bytes.without_repeats(_table(spark, sf_dir, "documents"), length=200))


def op10_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens with their lexical neighbours."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.digests(packing.pack(_table(spark, sf_dir, "documents"), path, window=4096))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each begun by the first turns of its family's first one."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that windows of ten words of benchmark items cover."""
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 100, for each of its first 5 positives."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), hard_negatives.scaled(F.col("embedding"), 256).alias("vector"))
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0, positives=5, negatives=5, low=80, high=100)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_hamming_search": op4_hamming_search,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_language_id": op6_language_id,
    "op7_chat_format": op7_chat_format,
    "op8_sentence_spans": op8_sentence_spans,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_lexical_packing": op10_lexical_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_decontaminate": op12_decontaminate,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op4_hamming_search": """
        WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
        d AS (
            SELECT q.vec_id AS query_id, r.vec_id AS row_id,
                list_sum(list_transform(list_zip(q.bits, r.bits), lambda z: (z[1] <> z[2])::INT))::INT AS distance
            FROM e q JOIN e r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id),
        n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, row_id)::INT AS rank FROM d)
        SELECT query_id, rank, row_id, distance FROM n WHERE rank <= 10""",
    "op7_chat_format": """
        WITH t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        c AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
                sum(length('<s></s>') + length(role) + 1 + CASE WHEN role = 'assistant' THEN 0 ELSE length('[INST][/INST]') END
                    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')))::BIGINT AS formatted_chars
            FROM t GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM c""",
    "op12_decontaminate": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT item_id::VARCHAR AS item,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark WHERE item_id IS NOT NULL),
        bi AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM bi),
        di AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
        met AS (SELECT r, i, n, item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM di) JOIN windows USING (n, p)),
        hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM met) GROUP BY r),
        named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
            n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op11_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
            FROM conversations WHERE conv_id IS NOT NULL),
        ids AS (SELECT DISTINCT conv_id FROM t),
        crc AS (  -- crc32 by its bits: one step for each of the eight bits of each character
            WITH RECURSIVE step(conv_id, s, k, c) AS (
                SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::UBIGINT FROM ids
                UNION ALL
                SELECT conv_id, s, k + 1, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END
                FROM (SELECT conv_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::UBIGINT) ELSE c END AS x FROM step WHERE k < 8 * length(s)))
            SELECT conv_id, (xor(c, 4294967295::UBIGINT) % 9)::BIGINT AS h FROM step WHERE k = 8 * length(s)),
        built AS (
            SELECT c.conv_id, t.n, t.role, t.text FROM crc c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.n <= h
            UNION ALL SELECT c.conv_id, least(h, coalesce(m, 0)) + t.n - h, t.role, t.text
            FROM crc c JOIN t USING (conv_id) LEFT JOIN (SELECT conv_id AS f, count(*) AS m FROM t GROUP BY conv_id) ON f = c.conv_id - c.conv_id % 5 WHERE t.n > h),
        line AS (SELECT conv_id, n, octet_length(encode(text)) AS bytes,
                list(md5(octet_length(encode(role)) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY n) AS path FROM built),
        member AS (SELECT conv_id, n AS depth, md5(array_to_string(path, '')) AS node, CASE WHEN n > 1 THEN md5(array_to_string(path[:n - 1], '')) ELSE md5('') END AS parent,
                bytes, [md5(array_to_string(path[:i], '')) FOR i IN range(0, n + 1)] AS above FROM line
            UNION ALL SELECT conv_id, 0, md5(''), NULL, 0, [md5('')] FROM ids),
        ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS s
            FROM (SELECT conv_id, arg_max(node, depth) AS node FROM member GROUP BY conv_id) GROUP BY node),
        nodes AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs
            FROM member GROUP BY node),
        kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
        up AS (SELECT a AS node, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
            FROM (SELECT unnest(above) AS a, n_convs, bytes, n_children FROM nodes LEFT JOIN kids USING (node)) GROUP BY a)
        SELECT x.conv_id, x.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(n_children, 0) AS n_children, leaves AS n_leaves,
            saved::BIGINT AS saved_tokens, sha256(coalesce(s, '')) AS ends_sha256
        FROM nodes x LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN kids k ON k.node = x.node JOIN up ON up.node = x.node LEFT JOIN ends e ON e.node = x.node""",
    "op13_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS a, r.vec_id AS b, q.label = r.label AS same, coalesce(list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
            FROM e q JOIN e r ON q.vec_id % 100 = 0 AND len(q.v) = len(r.v)),
        p AS (SELECT a, b, score FROM s WHERE same AND a <> b QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
        n AS (
            SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b))::INT AS rank, s.b AS negative_id,
                p.score AS positive_score, s.score AS negative_score
            FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}


def ready(spark: SparkSession) -> None:
    """Lets the Python workers of a local session import this library from anywhere."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, environment.get("PYTHONPATH", "")) if x)
