"""Queries over files, model contracts with stand-ins, audio at other rates and open stalls, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import numeric, text
from quern.operators import evaluation, flow, models, progress, quality
from quern.plans.analysis import _LADDER, _PAD, _lines, _outcomes, _read, _rounded
from quern.plans.curation import CURATED
from quern.session import shared_path
from quern.sources import audio, files

# ---- files --------------------------------------------------------------------------------------


def scan_text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted sentences as one text file, read whole."""
    path = shared_path(spark, "text")
    files.sink_lines(_lines(spark, sf_dir).orderBy("doc_id", "pos").coalesce(1), "s", path)
    return files.scan_text_docs(spark, path).where("text <> ''").select(F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


def scan_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted lines in several files, numbered through in the order of the files."""
    path = shared_path(spark, "lines")
    files.sink_lines(_lines(spark, sf_dir).repartitionByRange(4, "doc_id", "pos").sortWithinPartitions("doc_id", "pos"), "s", path)
    return files.scan_lines(spark, path)


def scan_psv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("clip_id"), F.concat(F.lit('"'), "c_name", F.lit('" | '), F.col("c_nationkey").cast("string")).alias("sentence"))
    path = shared_path(spark, "psv")
    files.sink_psv(rows, path, header=True)
    return files.scan_psv(spark, path, files.PAIR_SCHEMA, header=True)


def list_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "checkpoints")
    _read(spark, sf_dir, "region").select((F.col("r_regionkey") * 100).alias("step"), "r_name").write.partitionBy("step").parquet(path)
    return files.list_files(spark, path, "*.parquet").select(F.regexp_extract("path", r"step=(\d+)", 1).cast("long").alias("step"), F.col("modified").isNotNull().alias("dated")).distinct()


def sink_markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = _read(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return spark.createDataFrame(list(enumerate(files.markdown_report("Report", {"regions": regions}).split("\n"))), "line long, text string")


def scan_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centroid of a label, written and read, against all rows."""
    rows, path = _read(spark, sf_dir, "embeddings"), shared_path(spark, "vector")
    files.sink_vector(evaluation.centroid(rows.join(rows.agg(F.min("label").alias("label")), "label", "left_semi"), "embedding", ["label"]), path)
    one = files.scan_vector(spark, path)
    out = rows.join(F.broadcast(one)).select("vec_id", F.aggregate(F.zip_with("embedding", "centroid", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x).alias("dot"))
    return _rounded(out, "dot")


# ---- the quality ladder's records ---------------------------------------------------------------

_FIGURES = ["duration", "ratio", "peak", "rms", "wer", "ecapa", "wavlm", "value", "mu", "sd"]


def drop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.drop_records(_outcomes(spark, sf_dir)), *_FIGURES)


def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takes in the order of sentence and take."""
    rows = _read(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 2).alias("sid"), (F.col("vec_id") % 2 + 1).alias("take"), "label")
    return evaluation.sort_multi(rows, "sid", "take")


# ---- progress -----------------------------------------------------------------------------------


def open_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workers that are silent when the last of all items comes in."""
    events = _read(spark, sf_dir, "events")
    return progress.open_stalls(events, "user_id", "ts", events.agg(F.max("ts").alias("now")), minutes=720)


def retry_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service that always fails for every seventh customer."""

    def call(value: str) -> str:
        if int(value) % 7 == 0:
            raise ValueError(f"no {value}")
        return value[::-1]

    rows = _read(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("value"))
    return progress.with_retries(rows, call, "c_custkey", "value", 4, wait=lambda seconds: None)


# ---- models: stand-ins --------------------------------------------------------------------------


def g2p_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select(F.col("s").alias("sentence"))
    return models.phonemize(rows, lambda: lambda sentences: [s.lower() for s in sentences])


def asr_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcriber that fails on loud starts: a failure is a row."""

    def load():
        def model(samples) -> str:
            if samples[0] > 0.2:
                raise ValueError("too loud")
            return f"heard {len(samples)}"

        return model

    return models.apply_model(_read(spark, sf_dir, "embeddings"), load, "vec_id", "embedding", "string")


def speaker_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = models.apply_model(_read(spark, sf_dir, "embeddings"), lambda: lambda samples: [float(samples[0]), float(samples[-1])], "vec_id", "embedding", "array<double>")
    return found.select("vec_id", F.round(F.col("value")[0], 6).alias("first"), F.round(F.col("value")[1], 6).alias("last"), "error")


def tts_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes for every clip that has no output yet."""
    clips = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    done = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    made = models.apply_model(progress.todo(clips, done), lambda: lambda s: (s or "").encode() * 2, "id", "lang", "binary")
    return made.select(text.format_id(F.col("id")).alias("clip_id"), F.octet_length("value").cast("long").alias("bytes"), "error")


# ---- audio --------------------------------------------------------------------------------------


def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audio.resampled(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 16_000, 8_000)
    return _rounded(found.select("vec_id", F.posexplode("samples").alias("idx", "x")), "x")


_CLIPS = quality.Quality(sample_rate=100, axes=("duration_s", "rms", "f0_mean"), sigmas=1.5)


def _transcriber():
    def model(samples) -> str:
        if samples[0] > 0.3:
            raise ValueError("too loud")
        return "go go go" if samples[1] > 0 else "go go go go"

    return model


def qa_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as WAV files, some missing or broken, through all filters with stand-ins for the models."""
    wav = audio.to_wav(numeric.to_pcm16(F.transform("embedding", lambda x: x.cast("double") * 2)), _CLIPS.sample_rate)
    content = F.when(F.col("vec_id") % 17 == 2, F.lit(b"bad")).when(F.col("vec_id") % 13 != 1, wav)
    sentence = F.rtrim(F.repeat(F.lit("go "), (F.col("vec_id") % 6 + 2).cast("int")))
    clips = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), sentence.alias("sentence"), content.alias("content"))
    centroids = spark.sql("SELECT array(1e0, 1e0, 1e0) AS ecapa, array(1e0, -1e0) AS wavlm")
    thresholds = spark.sql("SELECT -0.5e0 AS ecapa_min, -0.9e0 AS wavlm_min")
    found = flow.figures(clips, centroids, thresholds, _transcriber, lambda: lambda x: x[2:5], lambda: lambda x: x[5:7], lambda: lambda x: x * 100, _CLIPS)
    outcomes = quality.ladder(found, thresholds, _CLIPS)
    return _rounded(outcomes.select("id", "outcome", "axis", "transcript", "rms", "wer", "ecapa", "wavlm", "f0_mean"), "rms", "wer", "ecapa", "wavlm", "f0_mean")


QUERIES = {
    f.__name__: f
    for f in (
        scan_text_docs, scan_lines_roundtrip, scan_psv_header, list_checkpoints, sink_markdown_report, scan_vector, drop_records, sort_multi, open_stalls, retry_backoff,
        g2p_contract, asr_contract, speaker_contract, tts_contract, resample, qa_flow,
    )
}

_AT = "((2 * idx - j) / 1.0::DOUBLE)"

ORACLES = {
    "scan_text_docs": f"WITH {CURATED}, t AS (SELECT string_agg(s, chr(10) ORDER BY doc_id, pos) || chr(10) AS t FROM curated) SELECT length(t) AS n_chars, md5(t) AS digest FROM t",
    "scan_lines_roundtrip": f"WITH {CURATED} SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS id, s AS line FROM curated",
    "scan_psv_header": """SELECT c_custkey::VARCHAR AS clip_id, '"' || c_name || '" | ' || c_nationkey AS sentence FROM customer""",
    "list_checkpoints": "SELECT r_regionkey * 100 AS step, true AS dated FROM region",
    "sink_markdown_report": """WITH r AS (SELECT row_number() OVER (ORDER BY r_regionkey) + 5 AS line, '| ' || r_regionkey || ' | ' || r_name || ' |' AS text FROM region)
SELECT * FROM (VALUES (0::BIGINT, '# Report'), (1, ''), (2, '## regions'), (3, ''), (4, '| r_regionkey | r_name |'), (5, '|---|---|')) AS h(line, text) UNION ALL SELECT * FROM r UNION ALL SELECT max(line) + 1, '' FROM r""",
    "scan_vector": """WITH x AS (SELECT unnest(range(len(embedding))) AS idx, unnest(embedding)::DOUBLE AS x FROM embeddings WHERE label = (SELECT min(label) FROM embeddings)), m AS (SELECT idx, avg(x) AS x FROM x GROUP BY 1), c AS (SELECT list(x ORDER BY idx) AS c FROM m)
SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], c), 6) AS dot FROM embeddings, c""",
    "drop_records": f"""{_LADDER}, d AS (SELECT c.*, o.outcome, o.axis FROM outcomes o JOIN clips c USING (id) WHERE o.outcome <> 'kept'), n AS (SELECT *, length(sentence) AS chars FROM d)
SELECT id, outcome AS filter, CASE outcome WHEN 'load_error' THEN load_error WHEN 'whisper_error' THEN asr_error END AS error,
  round(CASE WHEN outcome = 'duration_ratio' THEN duration_s END, 6) AS duration, CASE WHEN outcome = 'duration_ratio' THEN chars::INT END AS chars, round(CASE WHEN outcome = 'duration_ratio' THEN duration_s / greatest(chars, 1) END, 6) AS ratio,
  round(CASE WHEN outcome = 'clipping' THEN peak END, 6) AS peak, round(CASE WHEN outcome = 'rms_low' THEN rms END, 6) AS rms, CASE WHEN outcome = 'internal_silence' THEN silences::INT END AS count,
  round(CASE WHEN outcome = 'wer' THEN wer END, 6) AS wer, CASE WHEN outcome = 'wer' THEN sentence END AS ref, NULL::VARCHAR AS hyp, round(CASE WHEN outcome = 'speaker_verify' THEN ecapa END, 6) AS ecapa, round(CASE WHEN outcome = 'speaker_verify' THEN wavlm END, 6) AS wavlm,
  axis, round(CASE axis WHEN 'duration_s' THEN duration_s WHEN 'rms' THEN rms WHEN 'f0_mean' THEN f0_mean WHEN 'centroid' THEN centroid END, 6) AS value,
  round(CASE axis WHEN 'duration_s' THEN m1 WHEN 'rms' THEN m2 WHEN 'f0_mean' THEN m3 WHEN 'centroid' THEN m4 END, 6) AS mu, round(CASE axis WHEN 'duration_s' THEN s1 WHEN 'rms' THEN s2 WHEN 'f0_mean' THEN s3 WHEN 'centroid' THEN s4 END, 6) AS sd FROM n, st""",
    "sort_multi": "SELECT vec_id // 2 AS sid, vec_id % 2 + 1 AS take, label FROM embeddings ORDER BY 1, 2",
    "open_stalls": "WITH l AS (SELECT user_id, max(ts) AS stalled_from FROM events GROUP BY 1) SELECT * FROM l WHERE epoch_us((SELECT max(ts) FROM events)) - epoch_us(stalled_from) > 43200000000",
    "retry_backoff": "SELECT c_custkey, c_custkey % 7 <> 0 AS ok, CASE WHEN c_custkey % 7 = 0 THEN 5 ELSE 1 END AS attempts, CASE WHEN c_custkey % 7 <> 0 THEN reverse(c_custkey::VARCHAR) END AS result, CASE WHEN c_custkey % 7 = 0 THEN 'ValueError: no ' || c_custkey END AS error FROM customer",
    "g2p_contract": f"WITH {CURATED} SELECT s AS sentence, lower(s) AS phonemes FROM curated",
    "asr_contract": "SELECT vec_id, CASE WHEN embedding[1]::DOUBLE <= 0.2::DOUBLE THEN 'heard ' || len(embedding) END AS value, CASE WHEN embedding[1]::DOUBLE > 0.2::DOUBLE THEN 'ValueError: too loud' END AS error FROM embeddings",
    "speaker_contract": "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[-1]::DOUBLE, 6) AS last, NULL::VARCHAR AS error FROM embeddings",
    "tts_contract": f"SELECT {_PAD} AS clip_id, 2 * strlen(coalesce(lang, '')) AS bytes, NULL::VARCHAR AS error FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "resample": f"""WITH e AS (SELECT vec_id, len(embedding) AS n, unnest(range(len(embedding))) AS j, unnest(embedding)::DOUBLE AS x FROM embeddings),
k AS (SELECT vec_id, x, j, unnest(range(n // 2))::INT AS idx FROM e),
w AS (SELECT vec_id, idx, x * 0.5 * (CASE WHEN {_AT} = 0 THEN 1 ELSE sin(pi() * 0.5 * {_AT}) / (pi() * 0.5 * {_AT}) END) * (0.5 + 0.5 * cos(pi() * greatest(-1, least(1, {_AT} / 64)))) AS y FROM k)
SELECT vec_id, idx, round(sum(y), 6) AS x FROM w GROUP BY 1, 2""",
    "qa_flow": """WITH c AS (SELECT vec_id AS id, vec_id % 6 + 2 AS k, list_transform(embedding::DOUBLE[], lambda x: trunc(greatest(-1, least(1, x * 2)) * 32767) / 32768) AS x FROM embeddings),
f AS (SELECT id, k, CASE WHEN id % 17 = 2 OR id % 13 = 1 THEN NULL ELSE x END AS x FROM c),
g AS (SELECT *, len(x) / 100e0 AS duration_s, sqrt(list_sum(list_transform(x, lambda v: v * v)) / len(x)) AS rms, list_max(list_transform(x, lambda v: abs(v))) AS peak FROM f),
s1 AS (SELECT *, CASE WHEN id % 17 = 2 THEN 'load_error' WHEN x IS NULL THEN 'missing_file' WHEN duration_s / (3 * k - 1) < 0.04 OR duration_s / (3 * k - 1) > 0.12 THEN 'duration_ratio' WHEN peak >= 0.999 THEN 'clipping' WHEN rms < 0.005 THEN 'rms_low' END AS o1 FROM g),
h AS (SELECT *, CASE WHEN o1 IS NULL AND NOT x[1] > 0.3 THEN CASE WHEN x[2] > 0 THEN 3 ELSE 4 END END AS heard FROM s1),
s2 AS (SELECT *, abs(k - heard) / k::DOUBLE AS wer, CASE WHEN o1 IS NOT NULL THEN o1 WHEN heard IS NULL THEN 'whisper_error' WHEN abs(k - heard) / k::DOUBLE > 0.08 THEN 'wer' END AS o2 FROM h),
v AS (SELECT *, CASE WHEN o2 IS NULL THEN list_cosine_similarity(x[3:5], [1, 1, 1]::DOUBLE[]) END AS ecapa, CASE WHEN o2 IS NULL THEN list_cosine_similarity(x[6:7], [1, -1]::DOUBLE[]) END AS wavlm FROM s2),
s3 AS (SELECT *, CASE WHEN o2 IS NOT NULL THEN o2 WHEN ecapa < -0.5 OR wavlm < -0.9 THEN 'speaker_verify' END AS o3 FROM v),
p AS (SELECT *, CASE WHEN o3 IS NULL THEN coalesce(list_avg(list_filter(list_transform(x, lambda v: v * 100), lambda v: v > 0)), 0) END AS f0_mean FROM s3),
st AS (SELECT avg(duration_s) AS m1, stddev_pop(duration_s) AS d1, avg(rms) AS m2, stddev_pop(rms) AS d2, avg(f0_mean) AS m3, stddev_pop(f0_mean) AS d3 FROM p WHERE o3 IS NULL),
a AS (SELECT p.*, CASE WHEN o3 IS NOT NULL THEN NULL WHEN d1 > 0 AND abs(duration_s - m1) > 1.5 * d1 THEN 'duration_s' WHEN d2 > 0 AND abs(rms - m2) > 1.5 * d2 THEN 'rms' WHEN d3 > 0 AND abs(f0_mean - m3) > 1.5 * d3 THEN 'f0_mean' END AS axis FROM p, st)
SELECT id, coalesce(o3, CASE WHEN axis IS NULL THEN 'kept' ELSE 'outlier' END) AS outcome, axis, rtrim(repeat('go ', heard)) AS transcript, round(rms, 6) AS rms, round(wer, 6) AS wer, round(ecapa, 6) AS ecapa, round(wavlm, 6) AS wavlm, round(f0_mean, 6) AS f0_mean FROM a""",
}
