"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import backoff_lm, bpe_reuse, hashing_index, jaccard_join, langid, packing, passage_dedup, quality_rules, tool_calls, warc
from quern.session import prepare, spread, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text")
    return jaccard_join.classes(docs, n=4, percent=85)


OP1_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
x AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM t),
g AS (SELECT doc_id, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d || ' ' || lead(w, 3) OVER d AS sh FROM x WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, sh FROM g WHERE sh IS NOT NULL UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM t WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * o >= 85 * (a.n + b.n - o)),
r AS (SELECT doc_id AS u, doc_id AS v FROM t UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY 1), k AS (SELECT u, count(*) AS n_links FROM l GROUP BY 1)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links FROM t LEFT JOIN n USING (doc_id) JOIN c ON c.u = t.doc_id LEFT JOIN k ON k.u = t.doc_id
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spread(table(prepare(spark), sf_dir, "documents")))


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing_index.search(table(prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text")
    return bpe_reuse.decode(bpe_reuse.encode(docs)).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_lm.score(spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text"))
    return scored.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score", "full_log_score")})


OP5_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
x AS (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS c FROM t),
g AS (SELECT doc_id, i, lag(c, 2) OVER d AS a, lag(c) OVER d AS b, c FROM x WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
n1 AS (SELECT c, count(*) AS n FROM g GROUP BY ALL), o1 AS (SELECT doc_id, c, count(*) AS n FROM g GROUP BY ALL),
n2 AS (SELECT b, c, count(*) AS n FROM g WHERE i >= 1 GROUP BY ALL), o2 AS (SELECT doc_id, b, c, count(*) AS n FROM g WHERE i >= 1 GROUP BY ALL),
n3 AS (SELECT a, b, c, count(*) AS n FROM g WHERE i >= 2 GROUP BY ALL), o3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM g WHERE i >= 2 GROUP BY ALL),
k AS (SELECT g.doc_id, i, least(i + 1, 3) AS top, (SELECT count(*) FROM g) AS total, greatest((SELECT count(*) FROM g) - count(*) OVER (PARTITION BY g.doc_id), 1) AS rest,
    n1.n AS f1, n2.n AS f2, n3.n AS f3, m1.n AS h1, m2.n AS h2, n1.n - o1.n AS t1, n2.n - o2.n AS t2, n3.n - o3.n AS t3, m1.n - p1.n AS l1, m2.n - p2.n AS l2
  FROM g JOIN n1 ON n1.c = g.c JOIN o1 ON o1.doc_id = g.doc_id AND o1.c = g.c
  LEFT JOIN n2 ON n2.b = g.b AND n2.c = g.c LEFT JOIN o2 ON o2.doc_id = g.doc_id AND o2.b = g.b AND o2.c = g.c
  LEFT JOIN n3 ON n3.a = g.a AND n3.b = g.b AND n3.c = g.c LEFT JOIN o3 ON o3.doc_id = g.doc_id AND o3.a = g.a AND o3.b = g.b AND o3.c = g.c
  LEFT JOIN n1 m1 ON m1.c = g.b LEFT JOIN o1 p1 ON p1.doc_id = g.doc_id AND p1.c = g.b
  LEFT JOIN n2 m2 ON m2.b = g.a AND m2.c = g.b LEFT JOIN o2 p2 ON p2.doc_id = g.doc_id AND p2.b = g.a AND p2.c = g.b),
s AS (SELECT doc_id, CASE WHEN t3 > 0 AND l2 > 0 THEN ln(t3 / l2) WHEN t2 > 0 AND l1 > 0 THEN ln(t2 / l1) + (top - 2) * ln(0.4) WHEN t1 > 0 THEN ln(t1 / rest) + (top - 1) * ln(0.4) ELSE top * ln(0.4) - ln(rest) END AS l,
    CASE top WHEN 3 THEN ln(f3 / h2) WHEN 2 THEN ln(f2 / h1) ELSE ln(f1 / total) END AS f FROM k),
e AS (SELECT doc_id, sum(l) AS l, sum(f) AS f FROM s GROUP BY 1)
SELECT t.doc_id, len(ws)::BIGINT AS n_words, round(coalesce(l, 0), 6) AS log_score, round(CASE WHEN len(ws) > 0 THEN l / len(ws) END, 6) AS mean_log_score, round(coalesce(f, 0), 6) AS full_log_score
FROM t LEFT JOIN e USING (doc_id)
"""


TOOLS = """
SELECT 'reply' AS name, '{"type": "object", "properties": {"after": {"type": "string"}, "prompt": {"type": "string", "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}}, "required": ["prompt", "turn"], "additionalProperties": false}' AS schema
"""


def op6_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tool traffic: a user's turn calls ``reply``, the next turn is its result.

    From the third turn on a call needs the result of the call two turns before.
    """
    turns = table(prepare(spark), sf_dir, "conversations")
    call_id = lambda back: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), (F.col("turn") - back).cast("string"))
    after = F.when(F.col("turn") >= 2, F.concat(F.lit("$result:"), call_id(2)))
    arguments = F.struct(F.col("turn").alias("turn"), F.col("text").alias("prompt"), after.alias("after"))
    call = F.to_json(F.struct(F.array(F.struct(call_id(0).alias("id"), F.lit("reply").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(call_id(1).alias("tool_call_id"), F.col("text").alias("content")))
    messages = turns.select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool").otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text")).alias("text"),
    )
    linked = tool_calls.link(messages, spark.sql(TOOLS))
    return linked.select("conv_id", "turn", "kind", "call_id", "status", F.col("level").cast("long").alias("level"), F.array_join("errors", "; ").alias("errors"), "canonical")


OP6_SQL = """
WITH RECURSIVE asked AS (SELECT conv_id, turn, text, 'c' || conv_id || '-' || turn AS id FROM conversations WHERE role = 'user'),
replied AS (SELECT conv_id, turn, text, 'c' || conv_id || '-' || (turn - 1) AS id FROM conversations WHERE role = 'assistant'),
answered AS (SELECT DISTINCT asked.conv_id, asked.turn, asked.id FROM asked JOIN replied USING (conv_id, id)),
levels AS (
  SELECT conv_id, turn, id, 0::BIGINT AS level FROM asked WHERE turn < 2
  UNION ALL
  SELECT a.conv_id, a.turn, a.id, l.level + 1 FROM levels l JOIN answered USING (conv_id, turn, id) JOIN asked a ON a.conv_id = l.conv_id AND a.turn = l.turn + 2
)
SELECT a.conv_id, a.turn, 'call' AS kind, a.id AS call_id, CASE WHEN w.id IS NULL THEN 'unanswered' ELSE 'linked' END AS status, l.level,
  CASE WHEN length(a.text) > 400 THEN 'prompt: too long' ELSE '' END AS errors,
  '{"args":{' || CASE WHEN a.turn >= 2 THEN '"after":"$result:c' || a.conv_id || '-' || (a.turn - 2) || '",' ELSE '' END
  || '"prompt":' || to_json(a.text)::VARCHAR || ',"turn":' || a.turn || '},"id":"' || a.id || '","name":"reply","type":"call"}' AS canonical
FROM asked a LEFT JOIN answered w ON a.conv_id = w.conv_id AND a.id = w.id LEFT JOIN levels l ON a.conv_id = l.conv_id AND a.id = l.id
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.id, CASE WHEN w.id IS NULL THEN 'orphan' ELSE 'linked' END, l.level, '',
  '{"content":' || to_json(r.text)::VARCHAR || ',"id":"' || r.id || '","type":"result"}'
FROM replied r LEFT JOIN answered w ON r.conv_id = w.conv_id AND r.id = w.id LEFT JOIN levels l ON w.conv_id = l.conv_id AND w.id = l.id
UNION ALL
SELECT conv_id, turn, 'message', NULL, 'plain', 0, '', '{"content":' || to_json(text)::VARCHAR || ',"role":"' || role || '","type":"message"}'
FROM conversations WHERE role NOT IN ('user', 'assistant')
"""


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text")
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passage that an earlier document holds too: places are word numbers."""
    docs = spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text")
    found = passage_dedup.search(docs, min_words=50)
    return found.select("doc_id", F.explode("passages").alias("p")).select("doc_id", F.col("p.source").alias("source_doc_id"), F.col("p.start").alias("start_word"), F.col("p.end").alias("end_word"), F.col("p.source_start").alias("source_start_word"), F.col("p.source_end").alias("source_end_word"), F.col("p.agreeing").alias("agreeing_words"))


def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(prepare(spark), sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS last FROM p),
b AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(hex, (5 * k + 1)::INT, 5))::INT) AS parts FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((parts[i // 4 + 1] // [32768, 1024, 32, 1][i % 4 + 1]) % 32 + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM b
"""


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(prepare(spark), sf_dir, "documents")).select("doc_id", "text")
    return quality_rules.apply_rules(docs).drop("text")


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_language_id": op2_language_id,
    "op3_multi_index_hashing": op3_multi_index_hashing,
    "op4_bpe_reuse": op4_bpe_reuse,
    "op5_backoff_lm": op5_backoff_lm,
    "op6_tool_calls": op6_tool_calls,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_passage_dedup": op8_passage_dedup,
    "op9_warc_dictionary": op9_warc_dictionary,
    "op10_quality_rules": op10_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op5_backoff_lm": OP5_SQL,
    "op6_tool_calls": OP6_SQL,
    "op9_warc_dictionary": OP9_SQL,
}
