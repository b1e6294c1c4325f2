"""The operators as queries over the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from attesta.session import table

#: Rules of the URL filter's query.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.url_filter import url_filter

    return url_filter(table(spark, sf_dir, "pages"), URL_RULES)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.warc import warc_dedup

    return warc_dedup(table(spark, sf_dir, "pages"))


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.token_shards import token_shards

    return token_shards(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.neardup import duplicate_classes

    return duplicate_classes(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.decontam import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from attesta.llm.tool_calls import TURN_SCHEMAS, link_tool_calls, turns_as_calls

    calls, results = turns_as_calls(table(spark, sf_dir, "conversations"))
    return link_tool_calls(calls, results, TURN_SCHEMAS).withColumn("errors", F.array_join("errors", ";"))


def call_argument_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with calls made of turns: the length is a text where the turn has several lines, long texts are left out, a note comes with texts that have a comma."""
    from pyspark.sql import functions as F

    from attesta.llm.tool_calls import TURN_SCHEMAS, argument_errors, quoted

    said = F.coalesce("text", F.lit(""))
    length = F.char_length(said).cast("string")
    fields = F.array(
        F.concat(F.lit('"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("0"))), F.concat(F.lit('"chars":'), F.when(F.contains(said, F.lit("\n")), quoted(length)).otherwise(length)),
        F.when(F.char_length(said) <= 100, F.concat(F.lit('"text":'), quoted(said))), F.when(F.contains(said, F.lit(",")), F.lit('"note":true')),
    )
    calls = table(spark, sf_dir, "conversations").withColumn("arguments", F.concat(F.lit("{"), F.array_join(F.array_compact(fields), ","), F.lit("}")))
    return calls.select("conv_id", "turn", F.array_join(argument_errors(F.coalesce("role", F.lit("")), F.col("arguments"), TURN_SCHEMAS), ";").alias("errors"))


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from attesta.llm.sentence_pieces import decode_pieces, encode_pieces

    path = tokenizer_path(PIECES)
    rows = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), path), path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), "n_mended")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.filter_audit import filter_audit

    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from attesta.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations")).drop("n_ends")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_token_shards": op3_token_shards,
    "op4_cube_mix": op4_cube_mix,
    "op5_bagminhash": op5_bagminhash,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_quality": op8_quality,
    "op9_maxscore": op9_maxscore,
    "op10_tool_calls": op10_tool_calls,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_filter_audit": op12_filter_audit,
    "op13_prefix_trie": op13_prefix_trie,
    "call_argument_errors": call_argument_errors,
}
ORACLES: dict[str, str] = {
    "call_argument_errors": r"""
        SELECT conv_id, turn, CASE WHEN coalesce(role, '') NOT IN ('user', 'system') THEN 'unknown_tool' ELSE array_to_string(list_filter([CASE WHEN contains(t, chr(10)) THEN 'type:chars' END, CASE WHEN length(t) > 100 THEN 'missing:text' END,
               CASE WHEN contains(t, ',') THEN 'unknown:note' END], lambda x: x IS NOT NULL), ';') END AS errors FROM (SELECT *, coalesce(text, '') AS t FROM conversations)""",
    "op12_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
             w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false) AS copy FROM t),
             d AS (SELECT part, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic,
                          (len(words) < 100)::INTEGER + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INTEGER + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INTEGER
                          + 8 * regexp_matches(text, '[#$%&*|]')::INTEGER + 16 * copy::INTEGER AS mask FROM w),
             m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM d GROUP BY 1, 2),
             l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
             o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM l a, l b, l c, l d, l e
                   WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
             s AS (SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS bit, list_sum([0] || list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65)))::INTEGER AS before
                   FROM o, (SELECT unnest(range(1, 6)) AS step)),
             r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
                          sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                          sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN g ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN x ELSE 0 END) AS toxic_lost FROM m, s GROUP BY ALL)
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r""",
    "op13_prefix_trie": """
        WITH t AS (SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS chars,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), digest) AS p FROM conversations WHERE conv_id IS NOT NULL),
             n AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
                          xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                              lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)), 4294967295) % 6 AS h
                   FROM t GROUP BY conv_id),
             c AS (SELECT n.*, least(n.h, coalesce(b.n, 0)) AS k FROM n LEFT JOIN n b ON b.conv_id = n.base),
             r AS (SELECT c.conv_id, p AS depth, digest, chars FROM c JOIN t ON t.conv_id = c.base AND p <= h
                   UNION ALL SELECT conv_id, p - h + k, digest, chars FROM c JOIN t USING (conv_id) WHERE p > h),
             m AS (SELECT conv_id, depth, chars, string_agg(digest, '') OVER w AS key, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
                   UNION ALL SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM r) FROM c),
             v AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM m GROUP BY key, depth),
             k AS (SELECT left(key, -64) AS key, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY 1),
             e AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k USING (key)),
             u AS (SELECT a.key, count(*) FILTER (d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.chars)::BIGINT AS saved_tokens FROM e a JOIN e d ON starts_with(d.key, a.key) GROUP BY a.key)
        SELECT e.conv_id, e.depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, u.n_leaves, u.saved_tokens, e.ends_sha256
        FROM e JOIN u USING (key) LEFT JOIN v p ON e.depth > 0 AND p.key = left(e.key, -64) AND p.depth = e.depth - 1""",
    "op2_warc_revisits": """
        WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
             f AS (SELECT *, payload_bytes >= 100 AND row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) > 1 AS again, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first_id END AS refers_to
        FROM f""",
    "op9_maxscore": """
        WITH v AS (SELECT vec_id, row_number() OVER () AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, q.id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.id <> q.id),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 10""",
    "op10_tool_calls": """
        WITH RECURSIVE t AS (SELECT *, conv_id || '-' || turn AS id, conv_id || '-' || (turn - 1) AS before, conv_id || '-' || (turn - 2) AS second, coalesce(role = 'assistant', false) AS answer FROM conversations),
             ids AS (SELECT DISTINCT id FROM t WHERE NOT answer),
             c AS (SELECT t.conv_id, t.id AS call_id, t.turn, t.role, t.text, CASE WHEN turn > 0 THEN coalesce(ids.id, CASE WHEN turn > 1 THEN second END) END AS after
                   FROM t LEFT JOIN ids ON t.before = ids.id WHERE NOT answer),
             d AS (SELECT call_id, 0 AS depth FROM c WHERE after IS NULL OR after NOT IN (SELECT id FROM ids)
                   UNION ALL SELECT c.call_id, d.depth + 1 FROM c JOIN d ON c.after = d.call_id),
             r AS (SELECT conv_id, before AS call_id, turn AS result_ord, text FROM t WHERE answer)
        SELECT c.conv_id, c.call_id, c.turn AS ord, d.depth, r.result_ord, CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
               CASE WHEN c.role IN ('user', 'system') THEN '' ELSE 'unknown_tool' END AS errors,
               '{"after":' || coalesce(to_json(c.after)::VARCHAR, 'null') || ',"arguments":{"chars":' || length(c.text) || ',"text":' || to_json(c.text)::VARCHAR || ',"turn":' || c.turn || '},"id":'
               || to_json(c.call_id)::VARCHAR || ',"name":' || to_json(c.role)::VARCHAR || ',"result":' || coalesce(to_json(r.text)::VARCHAR, 'null') || '}' AS json
        FROM c JOIN d USING (call_id) LEFT JOIN r USING (call_id)
        UNION ALL
        SELECT r.conv_id, r.call_id, NULL, NULL, r.result_ord, 'orphan_result', NULL, NULL FROM r WHERE r.call_id NOT IN (SELECT id FROM ids)""",
}
