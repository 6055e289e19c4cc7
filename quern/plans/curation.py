"""Queries of curation and selection, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import Curation
from quern.functions import text
from quern.operators import curation, selection
from quern.session import prepare, spread, table

# ---- SQL that several queries share -------------------------------------------------------------

SPLIT = r"""string_split(regexp_replace(replace(regexp_replace(text, '\s+', ' ', 'g'), '—', ' — '), '([.!?])\s+([A-Z"''])', '\1' || chr(1) || '\2', 'g'), chr(1))"""
SENTENCES = rf"""
parts AS (SELECT doc_id, list_filter(list_transform({SPLIT}, lambda p: trim(p)), lambda p: p <> '') AS l FROM documents),
sentences AS (SELECT doc_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS sentence FROM parts)"""


def normalized(s: str) -> str:
    s = f"""replace(regexp_replace(regexp_replace({s}, '[“”]', '"', 'g'), '[‘’]', '''', 'g'), '--', ' — ')"""
    for short, full in text.ABBREVIATIONS:
        s = rf"regexp_replace({s}, '\b{short}\.', '{full}', 'g')"
    for number in range(len(text.SMALL_NUMBERS) - 1, -1, -1):
        s = rf"regexp_replace({s}, '\b{number}\b', '{text.SMALL_NUMBERS[number]}', 'g')"
    return rf"trim(regexp_replace({s}, '\s+', ' ', 'g'))"


def words(s: str) -> str:
    return rf"len(list_filter(string_split_regex({s}, '\s+'), lambda w: w <> ''))"


_REPEATED = r"""len(list_filter(range(1, len(regexp_extract_all(lower(s), '\w+'))), lambda k: regexp_extract_all(lower(s), '\w+')[k] = regexp_extract_all(lower(s), '\w+')[k + 1]
  AND regexp_full_match(regexp_extract_all(regexp_replace(lower(s), '^\W+', ''), '\W+')[k], '\s+'))) > 0"""
REASON = rf"""CASE WHEN n_words NOT BETWEEN 4 AND 20 THEN 'a_words' WHEN regexp_matches(s, '[^\x00-\x7F]') THEN 'f_non_ascii'
  WHEN regexp_matches(s, 'https?://|www\.') THEN 'b_url' WHEN regexp_matches(s, '\d') THEN 'c_digit'
  WHEN regexp_matches(s, '\b[A-Z]{{4,}}\b.*\b[A-Z]{{4,}}\b') THEN 'd_capitals' WHEN {_REPEATED} THEN 'e_repeated'
  WHEN regexp_matches(s, '(?i)^(CHAPTER|VOLUME|BOOK|PART|ACT|SCENE)\b') THEN 'g_heading' WHEN length(s) - length(replace(s, '"', '')) >= 4 THEN 'h_quotes' END"""
BUCKET = "CASE WHEN n_words BETWEEN 4 AND 8 THEN 'short' WHEN n_words BETWEEN 9 AND 14 THEN 'med' WHEN n_words BETWEEN 15 AND 20 THEN 'long' END"
PROSODY = "CASE WHEN s LIKE '%?' THEN 'interrogative' WHEN s LIKE '%!' THEN 'exclamatory' WHEN regexp_matches(s, '[;,—:]') THEN 'complex' ELSE 'declarative' END"
JUDGED = rf"""{SENTENCES},
normal AS (SELECT doc_id, pos, {normalized("sentence")} AS s FROM sentences),
counted AS (SELECT *, {words("s")} AS n_words FROM normal),
judged AS (SELECT *, {REASON} AS reason FROM counted)"""
CURATED = rf"""{JUDGED},
accepted AS (SELECT doc_id, pos, s, n_words FROM judged WHERE reason IS NULL),
uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(s) ORDER BY doc_id, pos) AS r FROM accepted) WHERE r = 1),
curated AS (SELECT doc_id, pos, s, n_words, {BUCKET} AS category, {PROSODY} AS prosody FROM uniq WHERE {BUCKET} IS NOT NULL)"""
_MARK = " OR ".join(f"contains(t, '{m}')" for m in text.ACCENT_MARKERS)
TOKENS = rf"""{CURATED},
tokened AS (SELECT *, list_filter(string_split(replace(lower(s), ' ', ''), ''), lambda t: t <> '') AS tokens FROM curated),
phon AS (SELECT *, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]) AS bigrams, len(list_filter(tokens, lambda t: {_MARK})) AS n_accent FROM tokened)"""


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(prepare(spark), sf_dir, "documents").select("doc_id", "text"))


def _with_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = "*** START OF THE PROJECT GUTENBERG EBOOK A ***", "*** end of this project gutenberg ebook a ***"
    kind = F.col("doc_id") % 4
    return _docs(spark, sf_dir).select("doc_id", F.concat(F.when(kind < 2, f"front {start}").otherwise(""), F.col("text"), F.when(kind.isin(0, 2), f"{end} back").otherwise("")).alias("text"))


def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_markers(spark, sf_dir).select("doc_id", text.strip_boilerplate(F.col("text")).alias("body"))


def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.sentences(_docs(spark, sf_dir))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.normal_sentences(_docs(spark, sf_dir)).withColumnRenamed("sentence", "s")


def normalize_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.normalize_wer(F.col("text")).alias("s"))


def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text.word_count(F.col("text")).cast("long").alias("n_words"), F.length("text").cast("long").alias("n_chars"))


def sentence_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curation.normal_sentences(_docs(spark, sf_dir)).withColumnRenamed("sentence", "s")
    return rows.select("doc_id", "pos", text.length_bucket(text.word_count(F.col("s"))).alias("category"), text.prosody(F.col("s")).alias("prosody"))


def accept_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.accepted(curation.normal_sentences(_docs(spark, sf_dir))).select("doc_id", "pos", F.col("sentence").alias("s"))


def accept_reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.reject_histogram(curation.normal_sentences(_docs(spark, sf_dir)))


def dedupe_ci_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.dedupe_first(curation.accepted(curation.normal_sentences(_docs(spark, sf_dir)))).select("doc_id", "pos", F.col("sentence").alias("s"))


def corpus_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.corpus_funnel(_docs(spark, sf_dir))


def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.funnel_counts(_docs(spark, sf_dir))


def _phonemised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.phonemised(curation.curated(_docs(spark, sf_dir)))


def phoneme_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phonemised(spark, sf_dir).select("doc_id", "pos", F.array_join("tokens", " ").alias("tokens"), F.array_join("bigrams", "|").alias("bigrams"), F.col("n_accent").cast("long").alias("n_accent"))


def bigram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.bigram_counts(_phonemised(spark, sf_dir))


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.coverage_summary(curation.bigram_counts(_phonemised(spark, sf_dir)))


def marker_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.marker_counts(_phonemised(spark, sf_dir))


def bucket_share_vs_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curation.curated(_docs(spark, sf_dir))
    both = curation.shares(rows, "category", Curation().length_target).unionByName(curation.shares(rows, "prosody", Curation().prosody_target))
    return both.select("class", "n", F.round("share", 6).alias("share"), "target")


def cache_lookup_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache holds what even documents have, some of it empty; the rest is computed."""
    rows = curation.curated(_docs(spark, sf_dir)).select("doc_id", "sentence")
    cache = rows.where("doc_id % 2 = 0").select("sentence", F.when(F.col("doc_id") % 6 == 0, "").otherwise(F.lower("sentence")).alias("phonemes"))
    filled, after = curation.merge_cache(rows, cache, F.upper("sentence"))
    return filled.select("doc_id", "sentence", "phonemes", "hit").unionByName(after.select(F.lit(None).cast("long").alias("doc_id"), "sentence", "phonemes", F.lit(None).cast("boolean").alias("hit")))


def stratified_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = curation.stratified_topk(_phonemised(spark, sf_dir), 2000)
    return picked.select("doc_id", "pos", "category", "prosody", "score", "rank")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.curated(_docs(spark, sf_dir)).drop("n_words")


def greedy_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.greedy_exact(_candidates(spark, sf_dir), 500, derive=curation.phonemised).select("doc_id", "pos", "category", "prosody", "n_accent")


def greedy_select_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.greedy_distributed(_candidates(spark, sf_dir), 500, groups=8, derive=curation.phonemised).select("doc_id", "pos", "category", "prosody", "n_accent")


def greedy_select_12000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Picks for a whole corpus: as many as the target, or all candidates if there are fewer."""
    return selection.greedy_distributed(_candidates(spark, sf_dir), Curation().target_size, groups=8, derive=curation.phonemised).select("doc_id", "pos", "category", "prosody", "n_accent")


_TARGETS = " UNION ALL ".join(f"SELECT '{k}' AS class, {v}::DOUBLE AS target, '{c}' AS col" for c, ts in (("category", Curation().length_target), ("prosody", Curation().prosody_target)) for k, v in ts.items())
_QUOTA = " ".join(f"WHEN category = '{k}' AND prosody = '{p}' THEN {-int(-round(a * b * 2000, 6) // 1)}" for k, a in Curation().length_target.items() for p, b in Curation().prosody_target.items())

QUERIES = {
    f.__name__: f
    for f in (
        strip_boilerplate, sentence_split, normalize_text, normalize_wer, text_counts, sentence_labels, accept_sentence, accept_reject_histogram, dedupe_ci_first, corpus_funnel, funnel_counts,
        phoneme_tokens, bigram_counts, coverage_summary, marker_counts, bucket_share_vs_target, cache_lookup_upsert, stratified_topk, greedy_select, greedy_select_distributed, greedy_select_12000,
    )
}

ORACLES = {
    "strip_boilerplate": """
WITH marked AS (SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN 'front ' || '*** START OF THE PROJECT GUTENBERG EBOOK A ***' ELSE '' END || text || CASE WHEN doc_id % 4 IN (0, 2) THEN '*** end of this project gutenberg ebook a *** back' ELSE '' END AS t FROM documents),
cut AS (SELECT doc_id, regexp_replace(t, '(?is)^.*?\\*\\*\\*\\s*START OF (THIS|THE) PROJECT GUTENBERG.*?\\*\\*\\*', '') AS t FROM marked)
SELECT doc_id, regexp_replace(t, '(?is)\\*\\*\\*\\s*END OF (THIS|THE) PROJECT GUTENBERG.*$', '') AS body FROM cut""",
    "sentence_split": f"WITH {SENTENCES} SELECT doc_id, pos, sentence FROM sentences",
    "normalize_text": f"WITH {SENTENCES} SELECT doc_id, pos, {normalized('sentence')} AS s FROM sentences",
    "normalize_wer": r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(lower(text), '&', ' and '), '[-/]', ' ', 'g'), '[^a-z'' ]', ' ', 'g'), '\s+', ' ', 'g')) AS s FROM documents",
    "text_counts": f"SELECT doc_id, {words('text')} AS n_words, length(text) AS n_chars FROM documents",
    "sentence_labels": f"WITH {SENTENCES}, n AS (SELECT doc_id, pos, {normalized('sentence')} AS s FROM sentences), c AS (SELECT *, {words('s')} AS n_words FROM n) SELECT doc_id, pos, {BUCKET} AS category, {PROSODY} AS prosody FROM c",
    "accept_sentence": f"WITH {JUDGED} SELECT doc_id, pos, s FROM judged WHERE reason IS NULL",
    "accept_reject_histogram": f"WITH {JUDGED} SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM judged GROUP BY 1",
    "dedupe_ci_first": f"WITH {CURATED} SELECT doc_id, pos, s FROM uniq",
    "corpus_funnel": f"WITH {CURATED} SELECT category, prosody, count(*) AS n FROM curated GROUP BY 1, 2",
    "funnel_counts": f"WITH {CURATED} SELECT '1_raw' AS step, count(*) AS n FROM sentences UNION ALL SELECT '2_accepted', count(*) FROM accepted UNION ALL SELECT '3_unique', count(*) FROM uniq UNION ALL SELECT '4_candidates', count(*) FROM curated UNION ALL SELECT '5_selected', least(count(*), 12000) FROM curated",
    "phoneme_tokens": f"WITH {TOKENS} SELECT doc_id, pos, array_to_string(tokens, ' ') AS tokens, array_to_string(bigrams, '|') AS bigrams, n_accent FROM phon",
    "bigram_counts": f"WITH {TOKENS} SELECT bigram, count(*) AS n FROM (SELECT unnest(bigrams) AS bigram FROM phon) GROUP BY 1",
    "coverage_summary": f"WITH {TOKENS}, b AS (SELECT bigram, count(*) AS n FROM (SELECT unnest(bigrams) AS bigram FROM phon) GROUP BY 1) SELECT count(*) AS distinct_bigrams, coalesce(sum(n), 0)::BIGINT AS total_bigrams, count(*) FILTER (n < 50) AS below_floor, count(*) FILTER (n < 20) AS below_rare_floor FROM b",
    "marker_counts": f"WITH {TOKENS}, t AS (SELECT unnest(tokens) AS token FROM phon) " + " UNION ALL ".join(f"SELECT '{m}' AS marker, count(*) FILTER (contains(token, '{m}')) AS n FROM t" for m in text.ACCENT_MARKERS),
    "bucket_share_vs_target": f"""WITH {CURATED}, t AS ({_TARGETS}), c AS (SELECT category AS class, 'category' AS col, count(*) AS n FROM curated GROUP BY 1 UNION ALL SELECT prosody, 'prosody', count(*) FROM curated GROUP BY 1)
SELECT t.class, coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / greatest((SELECT count(*) FROM curated), 1)::DOUBLE, 6) AS share, t.target FROM t LEFT JOIN c ON t.class = c.class AND t.col = c.col""",
    "cache_lookup_upsert": f"""WITH {CURATED}, cached AS (SELECT s, CASE WHEN doc_id % 6 = 0 THEN '' ELSE lower(s) END AS p FROM curated WHERE doc_id % 2 = 0)
SELECT c.doc_id, c.s AS sentence, CASE WHEN k.p <> '' THEN k.p ELSE upper(c.s) END AS phonemes, coalesce(k.p <> '', false) AS hit FROM curated c LEFT JOIN cached k ON c.s = k.s
UNION ALL SELECT NULL, s, p, NULL FROM cached WHERE p <> ''
UNION ALL SELECT NULL, c.s, upper(c.s), NULL FROM curated c LEFT JOIN cached k ON c.s = k.s WHERE coalesce(k.p, '') = ''""",
    "stratified_topk": f"""WITH {TOKENS}, r AS (SELECT doc_id, pos, category, prosody, (2 * n_accent + len(bigrams))::DOUBLE AS score FROM phon),
k AS (SELECT *, row_number() OVER (PARTITION BY category, prosody ORDER BY score DESC, doc_id, pos)::INT AS rank FROM r)
SELECT doc_id, pos, category, prosody, score, rank FROM k WHERE rank <= CASE {_QUOTA} ELSE 0 END""",
}
