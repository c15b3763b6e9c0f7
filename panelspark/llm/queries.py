"""The registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, gru_lm, hard_negatives, huffman_ids, merkle, packing, secret_scan, sentencepiece_bpe, sharding, simhash, tool_calls, toxicity, winnowing
from .shipping import ship_package

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return sentencepiece_bpe.encode_document_digests(read(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(read(spark, sf_dir, "documents"), BYTE_MODEL, cut_bytes=8 << 20)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
                         F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("spans"))


def op6_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return gru_lm.score_documents(read(spark, sf_dir, "documents"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, links = tool_calls.calls_of_turns(read(spark, sf_dir, "conversations"))
    return tool_calls.link_calls(calls, results, links, tool_calls.SCHEMAS, keep=["conv_id", "turn"])


def op11_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return huffman_ids.round_trip(read(spark, sf_dir, "documents"), WORD_MODEL)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=shifted)


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_packing, op3_exact_dedup, op4_sharding, op5_toxicity, op6_gru_lm,
                                   op7_winnowing, op8_simhash, op9_secret_scan, op10_tool_calls, op11_huffman_ids, op12_merkle_manifest, op13_hard_negatives)}

ORACLE = {
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x, row_number() OVER () AS r
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        s AS (SELECT a.vec_id AS anchor_id, a.r AS anchor, b.vec_id, b.r, a.label = b.label AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
              FROM v a JOIN v b ON a.r != b.r AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) AS k FROM s WHERE same),
        n AS (SELECT p.anchor_id, p.anchor, p.vec_id AS positive_id, p.r AS positive, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY s.score DESC, s.vec_id, s.r) AS k
              FROM p JOIN s USING (anchor) WHERE p.k <= 5 AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10""",
    "op12_merkle_manifest": """
        WITH RECURSIVE d AS (
            SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS r,
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head FROM documents),
        crc AS (SELECT 0 AS step, r, doc_id, CAST(4294967295 AS BIGINT) AS c, encode(CAST(doc_id AS VARCHAR)) AS rest FROM d WHERE doc_id IS NOT NULL
                UNION ALL
                SELECT step + 1, r, doc_id, CASE WHEN step % 9 = 0 THEN xor(c, ascii(substr(CAST(doc_id AS VARCHAR), step // 9 + 1, 1)))
                                                 WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, rest
                FROM crc WHERE step < 9 * strlen(CAST(doc_id AS VARCHAR))),
        odd AS (SELECT r FROM crc WHERE step = 9 * strlen(CAST(doc_id AS VARCHAR)) AND xor(c, 4294967295) % 5 = 0),
        l AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                     CASE WHEN r IN (SELECT r FROM odd)
                          THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
                          ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS offered FROM d),
        p AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
                     row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
        nodes AS (SELECT 0 AS level, tree, n, pos, leaf AS digest FROM p
                  UNION ALL
                  SELECT level + 1, tree, (n + 15) // 16, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY ALL),
        subs AS (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
        tops AS (SELECT 0 AS level, count(*) OVER () AS n, tree AS pos, subroot AS digest FROM subs
                 UNION ALL
                 SELECT level + 1, (n + 15) // 16, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY ALL),
        sib AS (SELECT a.level, a.tree, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                       coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                FROM nodes a JOIN nodes b ON a.level = b.level AND a.tree = b.tree AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL),
        top_sib AS (SELECT a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                           coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
                    FROM tops a JOIN tops b ON a.level = b.level AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL),
        steps AS (SELECT r, 0 AS step, tree, pos, offered AS folded, '' AS proof FROM p
                  UNION ALL
                  SELECT f.r, f.step + 1, f.tree, f.pos // 16, sha256(s.l || f.folded || s.r), f.proof || s.l || s.r
                  FROM steps f JOIN sib s ON s.level = f.step AND s.tree = f.tree AND s.pos = f.pos),
        grown AS (SELECT r, tree, arg_max(folded, step) AS folded, arg_max(proof, step) AS proof FROM steps GROUP BY ALL),
        over AS (SELECT r, 0 AS step, tree AS pos, folded, proof FROM grown
                 UNION ALL
                 SELECT f.r, f.step + 1, f.pos // 16, sha256(s.l || f.folded || s.r), f.proof || s.l || s.r
                 FROM over f JOIN top_sib s ON s.level = f.step AND s.pos = f.pos),
        ends AS (SELECT r, arg_max(folded, step) AS folded_root, arg_max(proof, step) AS proof FROM over GROUP BY ALL)
        SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = t.digest AS verified
        FROM p JOIN ends USING (r) JOIN subs USING (tree) JOIN (SELECT digest FROM tops WHERE n = 1) t ON true""",
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id)""",
    "op4_sharding": """
        WITH h AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS bytes,
                          lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits FROM documents),
        levels AS (SELECT depth, substr(bits, 1, depth) AS shard, sum(bytes) AS shard_bytes, count(*) AS shard_rows
                   FROM h, (SELECT CAST(range AS INTEGER) AS depth FROM range(0, 41)) GROUP BY ALL),
        best AS (SELECT doc_id, bytes, min(depth) AS depth, any_value(bits) AS bits
                 FROM h JOIN levels ON shard = substr(bits, 1, depth)
                 WHERE shard_bytes <= 1048576 OR shard_rows = 1 GROUP BY doc_id, bytes)
        SELECT doc_id, bytes, l.shard, l.depth, CAST(l.shard_bytes AS BIGINT) AS shard_bytes, l.shard_rows
        FROM best b JOIN levels l ON l.depth = b.depth AND l.shard = substr(b.bits, 1, b.depth)""",
    "op10_tool_calls": r"""
        WITH RECURSIVE u AS (
            SELECT conv_id, turn, 'call_' || conv_id || '_' || turn AS call_id, 'call_' || conv_id || '_' || (turn // 2) AS needs,
                   length(coalesce(text, '')) AS n, regexp_extract(coalesce(text, ''), '[A-Za-z]+') AS word
            FROM conversations WHERE role = 'user'),
        links AS (SELECT a.call_id, a.needs FROM u a WHERE a.turn > 0 AND a.needs IN (SELECT call_id FROM u)),
        lv AS (SELECT call_id, 0 AS level FROM u WHERE call_id NOT IN (SELECT call_id FROM links)
               UNION ALL SELECT l.call_id, lv.level + 1 FROM links l JOIN lv ON lv.call_id = l.needs),
        r AS (SELECT 'call_' || conv_id || '_' || (turn - 1) AS call_id, min(coalesce(text, '')) AS content, count(*) AS n_results
              FROM conversations WHERE role = 'assistant' GROUP BY 1),
        c AS (SELECT u.*, r.content, coalesce(r.n_results, 0) AS n_results, lv.level, CASE WHEN n % 2 = 0 THEN 'count' ELSE 'find' END AS name,
                     CASE WHEN word != '' THEN '"text":' || to_json(word) END AS t
              FROM u LEFT JOIN r USING (call_id) LEFT JOIN lv USING (call_id)),
        e AS (SELECT *, CASE WHEN n % 2 = 0 THEN '{' || coalesce(t || ',', '') || '"words":' || n || '}'
                             ELSE '{"limit":' || CASE WHEN n % 5 = 0 THEN '"' || n || '"' ELSE '' || n END || coalesce(',' || t, '') || '}' END AS args,
                     list_filter(['missing text', 'mistyped limit'], lambda x: (x = 'missing text' AND word = '') OR (x = 'mistyped limit' AND n % 2 = 1 AND n % 5 = 0)) AS wrong
              FROM c),
        s AS (SELECT *, CASE WHEN len(wrong) > 0 THEN 'invalid' WHEN content IS NULL THEN 'unanswered' ELSE 'answered' END AS status FROM e)
        SELECT conv_id, turn, call_id, name, level, status, array_to_string(wrong, '; ') AS problems, n_results,
               '{"arguments":' || args || ',"call_id":"' || call_id || '","level":' || level || ',"name":"' || name || '","problems":['
               || array_to_string(list_transform(wrong, lambda x: '"' || x || '"'), ',') || '],"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
               || ',"status":"' || status || '"}' AS line
        FROM s""",
}
