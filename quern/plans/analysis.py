"""Queries over vectors, token errors, clips, splits, checkpoints, audio, progress and files, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import Progress
from quern.functions import numeric, text
from quern.operators import curation, evaluation, progress, quality
from quern.plans.curation import CURATED
from quern.session import prepare, shared_path, spread, table
from quern.sources import audio, files
from quern.streaming import progress as streaming


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(prepare(spark), sf_dir, name)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ---- vectors: embeddings as speaker encodings, labels as voices ---------------------------------


def vec_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.centroid(_read(spark, sf_dir, "embeddings"), "embedding", ["label"])
    return _rounded(found.select("label", F.posexplode("centroid").alias("idx", "x")), "x")


def _takes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    return rows.select("label", "embedding", (F.floor(F.col("vec_id") / 2)).alias("sid"), (F.col("vec_id") % 2 + 1).alias("take"))


def pair_self_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.pair_similarity(_takes(spark, sf_dir), "sid", "take", "embedding"), "similarity")


def _to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    return rows.join(evaluation.centroid(rows, "embedding", ["label"]), "label").select("vec_id", "label", numeric.cosine(F.col("embedding"), F.col("centroid")).alias("similarity"))


def cosine_to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_to_centroid(spark, sf_dir), "similarity")


def derived_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_centroid(spark, sf_dir).groupBy("label").agg(quality.threshold("similarity").alias("least"))


def speaker_verify_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _to_centroid(spark, sf_dir)
    least = rows.groupBy("label").agg(quality.threshold("similarity").alias("least"))
    return _rounded(rows.join(least, "label").where(~(F.col("similarity") < F.col("least"))).select("vec_id", "label", "similarity"), "similarity")


_CENTROIDS = """
x AS (SELECT vec_id, label, unnest(range(len(embedding)))::INT AS idx, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT label, idx, avg(x) AS x FROM x GROUP BY 1, 2),
c AS (SELECT label, list(x ORDER BY idx) AS c FROM m GROUP BY 1),
sim AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], c) AS similarity FROM embeddings JOIN c USING (label))"""

# ---- token errors: accepted sentences and a rule-based perturbation -----------------------------

_HYP = "CASE WHEN doc_id % 3 = 0 THEN regexp_replace(s, '^[^ ]+ ', '') WHEN doc_id % 3 = 1 THEN concat(s, ' extra') ELSE replace(s, 'th', 't') END"


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = curation.curated(docs).select("doc_id", "pos", F.col("sentence").alias("s"))
    return rows.withColumn("hyp", F.expr(_HYP)).select("doc_id", "pos", numeric.token_wer(F.col("s"), F.col("hyp")).alias("wer"))


def token_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_errors(spark, sf_dir), "wer")


def wer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _errors(spark, sf_dir)
    return rows.groupBy((~F.isnan("wer") & (F.col("wer") > 0.08)).alias("dropped")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(numeric.clip01(F.col("wer"))), 6).alias("mean_wer"))


_WER = rf"""WITH {CURATED},
h AS (SELECT doc_id, pos, s, {_HYP} AS hyp FROM curated),
n AS (SELECT doc_id, pos, list_filter(string_split(regexp_replace(regexp_replace(replace(lower(s), '&', ' and '), '[-/]', ' ', 'g'), '[^a-z'' ]', ' ', 'g'), ' '), lambda t: t <> '') AS r,
  list_filter(string_split(regexp_replace(regexp_replace(replace(lower(hyp), '&', ' and '), '[-/]', ' ', 'g'), '[^a-z'' ]', ' ', 'g'), ' '), lambda t: t <> '') AS h FROM h),
k AS (SELECT *, list_sort(list_distinct(list_concat(r, h))) AS d FROM n),
w AS (SELECT doc_id, pos, CASE WHEN len(r) = 0 THEN 0 ELSE levenshtein(coalesce(array_to_string(list_transform(r, lambda t: chr((32 + list_position(d, t))::INT)), ''), ''), coalesce(array_to_string(list_transform(h, lambda t: chr((32 + list_position(d, t))::INT)), ''), ''))::DOUBLE / len(r) END AS wer FROM k)"""

# ---- statistics ---------------------------------------------------------------------------------


def consistency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.consistency(_read(spark, sf_dir, "events"), "value", ["event_type"])
    return _rounded(found, "mean", "sd", "least", "most", "p10", "p50", "p90")


def latency_upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.upper_median(_read(spark, sf_dir, "events"), "value", "event_type"), "upper_median")


def outlier_3sigma_first_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select("event_id", "event_type", "value", (F.col("value") * F.col("value")).alias("square"))
    found = quality.outliers(rows, ("value", "square"), by="event_type").drop("square")
    return _rounded(found.where("axis IS NOT NULL").select("event_id", "axis", "mu", "sd"), "mu", "sd")


# ---- clips: documents with figures computed alike in both engines -------------------------------

CLIP = """doc_id AS id, text AS sentence, length(text) * (0.03e0 + (doc_id % 11) * 0.01e0) AS duration_s,
0.5e0 + (doc_id * 7 % 500) / 1000e0 + CASE WHEN doc_id % 53 = 0 THEN 0.1e0 ELSE 0e0 END AS peak, (doc_id * 13 % 500) / 5000e0 AS rms,
CASE WHEN doc_id % 17 = 3 THEN 2 ELSE 0 END AS silences, (doc_id * 3 % 100) / 1000e0 AS wer,
CASE WHEN doc_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) ELSE 0.7e0 + (doc_id * 11 % 300) / 1000e0 END AS ecapa, 0.7e0 + (doc_id * 19 % 300) / 1000e0 AS wavlm,
100e0 + (doc_id * 17 % 200) + CASE WHEN doc_id % 71 = 0 THEN 5000e0 ELSE 0e0 END AS f0_mean, 1500e0 + (doc_id * 23 % 900) AS centroid,
doc_id % 29 <> 1 AS has_file, CASE WHEN doc_id % 31 = 1 THEN 'bad' END AS load_error, CASE WHEN doc_id % 37 = 1 THEN 'bad' END AS asr_error"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = _read(spark, sf_dir, "documents").selectExpr(*_columns(CLIP))
    return quality.ladder(clips, spark.sql("SELECT 0.75e0 AS ecapa_min, 0.72e0 AS wavlm_min"))


def _columns(select: str) -> list[str]:
    """The items of a select list: split at commas outside parentheses."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(select):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            out.append(select[start:i])
            start = i + 1
    return [x.strip() for x in [*out, select[start:]]]


def qa_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).select("id", "outcome", "axis")


def drop_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_histogram(_outcomes(spark, sf_dir))


def retained_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.retained(_outcomes(spark, sf_dir)), "retained_hours", "drop_rate")


def _recovery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("sentence"))
    return _outcomes(spark, sf_dir), docs.where("id % 5 <> 2"), docs.where("id % 7 <> 3").select("id")


def recover_wer_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.recover(*_recovery(spark, sf_dir)).select(text.format_id(F.col("id")).alias("clip_id"), "sentence", "origin")


def drops_join_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.skipped(*_recovery(spark, sf_dir))


_LADDER = f"""WITH clips AS (SELECT {CLIP} FROM documents),
staged AS (SELECT *, CASE WHEN NOT has_file THEN 'missing_file' WHEN load_error IS NOT NULL THEN 'load_error'
  WHEN duration_s / greatest(length(sentence), 1) < 0.04 OR duration_s / greatest(length(sentence), 1) > 0.12 THEN 'duration_ratio'
  WHEN peak >= 0.999 THEN 'clipping' WHEN rms < 0.005 THEN 'rms_low' WHEN silences > 0 THEN 'internal_silence'
  WHEN asr_error IS NOT NULL THEN 'whisper_error' WHEN wer > 0.08 THEN 'wer' WHEN ecapa < 0.75 OR wavlm < 0.72 THEN 'speaker_verify' END AS o FROM clips),
st AS (SELECT avg(duration_s) m1, stddev_pop(duration_s) s1, avg(rms) m2, stddev_pop(rms) s2, avg(f0_mean) m3, stddev_pop(f0_mean) s3, avg(centroid) m4, stddev_pop(centroid) s4 FROM staged WHERE o IS NULL),
ax AS (SELECT id, sentence, duration_s, o, CASE WHEN o IS NOT NULL THEN NULL WHEN s1 > 0 AND abs(duration_s - m1) > 3 * s1 THEN 'duration_s' WHEN s2 > 0 AND abs(rms - m2) > 3 * s2 THEN 'rms'
  WHEN s3 > 0 AND abs(f0_mean - m3) > 3 * s3 THEN 'f0_mean' WHEN s4 > 0 AND abs(centroid - m4) > 3 * s4 THEN 'centroid' END AS axis FROM staged, st),
outcomes AS (SELECT id, sentence, duration_s, coalesce(o, CASE WHEN axis IS NULL THEN 'kept' ELSE 'outlier' END) AS outcome, axis FROM ax)"""

# ---- splits and checkpoints ---------------------------------------------------------------------


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", text.format_id(F.col("doc_id")).alias("clip_id"))


def train_eval_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.train_eval_split(_clips(spark, sf_dir)).select("clip_id", "split")


def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eval clips of a run over two thirds of the documents that train a run over all."""
    clips = _clips(spark, sf_dir)
    return evaluation.split_overlap(evaluation.train_eval_split(clips.where("doc_id % 3 <> 0")), evaluation.train_eval_split(clips))


_SCORES = "label AS checkpoint, vec_id, (vec_id * 3 % 130) / 100e0 AS wer, 0.5e0 + (vec_id * 7 % 50) / 100e0 AS ecapa, 0.5e0 + (vec_id * 11 % 50) / 100e0 AS wavlm"


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.summary(_read(spark, sf_dir, "embeddings").selectExpr(*_columns(_SCORES)))


_FIGURES = ["wer_mean", "wer_p50", "ecapa_mean", "ecapa_p50", "wavlm_mean", "wavlm_p50", "composite_mean", "composite_var", "rank_score"]


def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_summary(spark, sf_dir), *_FIGURES)


def winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.winner(_summary(spark, sf_dir)).select("checkpoint", "rank_score"), "rank_score")


_SUMMARY = f"""WITH r AS (SELECT {_SCORES} FROM embeddings),
c AS (SELECT *, 0.35 * ecapa + 0.25 * wavlm + 0.30 * (1 - greatest(0, least(1, wer))) + 0.06 AS comp FROM r),
s AS (SELECT checkpoint, count(*) AS n_eval, avg(wer) AS wer_mean, quantile_cont(wer, 0.5) AS wer_p50, avg(ecapa) AS ecapa_mean, quantile_cont(ecapa, 0.5) AS ecapa_p50,
  avg(wavlm) AS wavlm_mean, quantile_cont(wavlm, 0.5) AS wavlm_p50, avg(comp) AS composite_mean, var_pop(comp) AS composite_var FROM c GROUP BY 1),
f AS (SELECT *, composite_mean - 0.5 * composite_var AS rank_score, composite_mean > 0.55 AND composite_mean < 0.75 AS ambiguous FROM s)"""


def _checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(F.concat(F.lit("epoch=1-step="), F.col("o_orderkey").cast("string"), F.lit(".ckpt")).alias("path"), F.col("o_orderdate").alias("modified"))


def topk_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.latest(_checkpoints(spark, sf_dir), 3)


def topk_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoints(spark, sf_dir).withColumn("step", evaluation.step_of(F.col("path"))).where(F.col("step").isin(380, 390, 400)).select("path", "step")


def milestone_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.milestone_reached(_checkpoints(spark, sf_dir), 4000)


def resume_from_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.resume_from(_checkpoints(spark, sf_dir), "base.ckpt")


def first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.first_n(_clips(spark, sf_dir), 5, "doc_id").select("clip_id")


def last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events").select("event_id", "event_type")
    return evaluation.latest(rows, 10, ("event_id",))


_NAME = "concat('voice-', c_name, '-', CASE WHEN c_custkey % 4 = 0 THEN 'x_low' WHEN c_custkey % 4 = 1 THEN 'high' ELSE 'other' END) AS name, CASE WHEN c_custkey % 3 = 0 THEN 'low' END AS known"


def quality_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").selectExpr("c_custkey", *_columns(_NAME))
    return rows.select(text.format_id(F.col("c_custkey"), 3).alias("clip_id"), text.quality_suffix(F.col("name"), F.col("known")).alias("quality"))


# ---- audio: embeddings as waveforms -------------------------------------------------------------


def peak_rms(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", numeric.peak(e).alias("peak"), numeric.rms(e).alias("rms"), numeric.duration(e).alias("duration_s"), numeric.decibel(numeric.rms(e)).alias("db"))
    rows = rows.withColumn("rate", numeric.speaking_rate(F.col("vec_id"), F.col("duration_s"))).withColumn("ratio", numeric.duration_ratio(F.col("duration_s"), F.col("vec_id")))
    return _rounded(rows, "peak", "rms", "duration_s", "db", "rate", "ratio")


def to_pcm16(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * 4)
    return _read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(numeric.to_pcm16(scaled)).alias("idx", "x")).select("vec_id", "idx", F.col("x").cast("int").alias("x"))


def mono_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    channels = F.transform("embedding", lambda x, i: F.array(x.cast("double"), F.get("embedding", F.size("embedding") - 1 - i).cast("double")))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(numeric.mono(channels)).alias("idx", "x"))
    return _rounded(rows, "x")


def frame_rms_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(numeric.frame_rms(F.col("embedding"), 16, 8)).alias("idx", "level"))
    return rows.select("vec_id", "idx", F.round(numeric.decibel(F.col("level")), 6).alias("db"))


def f0_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", numeric.f0_stats(F.col("embedding")).alias("s")).select("vec_id", "s.*")
    return _rounded(rows, "f0_mean", "f0_range")


_QUIET = quality.Quality(silence_db=-15.0, silence_ms=20, edge_s=0.01)


def silent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: numeric.decibel(F.abs(x.cast("double")))).alias("db"), (F.size("embedding") * 160).alias("n"))
    return quality.silent_runs(rows, "vec_id", "db", "n", _QUIET)


# ---- progress -----------------------------------------------------------------------------------


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of finished items: ids with blanks around them, and lines that aren't ids."""
    labels = _read(spark, sf_dir, "labels")
    lines = labels.select(F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit(" ")).alias("line")).unionByName(labels.select(F.concat(F.lit("x"), F.col("doc_id").cast("string")).alias("line")))
    return progress.done_ids(lines)


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.todo(_read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), _done(spark, sf_dir))


def file_exists_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").join(_done(spark, sf_dir), F.col("doc_id") == F.col("id"), "left_semi").select(text.format_id(F.col("doc_id")).alias("clip_id"), "source")


def id_to_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return _done(spark, sf_dir).join(docs, F.col("doc_id") == F.col("id")).select("id", "lang", "n_chars")


def progress_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.poll(_done(spark, sf_dir), Progress(target=400))


def throughput_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(progress.throughput(_read(spark, sf_dir, "events"), "ts", 12_000, ["user_id"]), "seconds", "rate", "eta_hours")


def stall_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress.stalls(_read(spark, sf_dir, "events"), "user_id", "ts", minutes=720)


def debounce_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = _read(spark, sf_dir, "events").select("user_id", F.struct("ts", "event_id").alias("at"), (F.col("event_id") % 3 == 0).alias("active"))
    return progress.restarts(ticks, "user_id", "at", "active").select("user_id", F.col("at.event_id").alias("event_id"), F.col("restart").cast("long").alias("restart"))


def success_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "events")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.expr("event_id % 7 <> 0")).alias("ok"), F.count_if(F.expr("event_id % 7 = 0")).alias("failed"))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming.drain(streaming.running_count(streaming.stream_table(prepare(spark), sf_dir, "events"), "event_type"), "complete")


def stream_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = streaming.stall_detector(streaming.stream_table(prepare(spark), sf_dir, "events"), "user_id", "ts", 720)
    return streaming.drain(found, "append").select("user_id", F.col("silent_from").cast("timestamp_ntz").alias("stalled_from"), F.col("silent_to").cast("timestamp_ntz").alias("stalled_to"))


# ---- files --------------------------------------------------------------------------------------

_QUOTED = "CASE WHEN doc_id % 2 = 0 THEN concat('He said \"go\" | now, ', s) ELSE concat('\"Yes!\" ', s) END"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return curation.curated(docs).select("doc_id", "pos", F.col("sentence").alias("s"))


def scan_psv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select(text.format_id(F.col("doc_id")).alias("clip_id"), F.expr(_QUOTED).alias("sentence"))
    path = shared_path(spark, "psv")
    files.sink_psv(rows, path, header=False)
    return files.scan_psv(spark, path, files.PAIR_SCHEMA, header=False)


def scan_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _outcomes(spark, sf_dir).where("outcome <> 'kept'").select("id", F.col("outcome").alias("filter"), "axis")
    path = shared_path(spark, "jsonl")
    files.sink_jsonl(rows, path)
    return files.scan_jsonl(spark, path).select("id", "filter", "axis")


def scan_tsv_kv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("s", F.concat(F.upper("s"), F.lit("\tmore")).alias("v"))
    path = shared_path(spark, "tsv")
    files.sink_tsv(rows, path)
    return files.scan_tsv_kv(spark, path)


def scan_text_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "lines")
    files.sink_lines(_lines(spark, sf_dir), "s", path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def sink_append_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Done ids are appended, some of them twice as after a crash; what is read has each once."""
    path = shared_path(spark, "append")
    done = _done(spark, sf_dir)
    files.append_once(done, path)
    files.append_once(done.where("id % 3 = 0"), path)
    return files.read_once(spark, path)


def sink_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "manifest")
    counts = _outcomes(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "kept").alias("kept"))
    files.sink_manifest({"input": F.col("n"), "result": F.struct(F.col("kept").alias("kept"), (F.col("n") - F.col("kept")).alias("dropped"))}, counts, path)
    return files.scan_json_doc(spark, path).select("input", F.col("result.kept").alias("kept"), F.col("result.dropped").alias("dropped"))


def survivor_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _outcomes(spark, sf_dir).where("outcome = 'kept'").select(F.col("id").alias("doc_id"))
    return _read(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(kept, "doc_id", "left_semi")


def synth_map_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eval clips with the output made for them; those without one are left out."""
    outputs = _read(spark, sf_dir, "labels").select("doc_id", "quality")
    return evaluation.train_eval_split(_clips(spark, sf_dir)).where("split = 'eval'").join(outputs, "doc_id").select("clip_id", "quality")


def centroid_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row against the one centroid of all rows."""
    rows = _read(spark, sf_dir, "embeddings")
    one = evaluation.centroid(rows.withColumn("all", F.lit(1)), "embedding", ["all"]).select("centroid")
    return _rounded(rows.join(F.broadcast(one)).select("vec_id", numeric.cosine(F.col("embedding"), F.col("centroid")).alias("similarity")), "similarity")


def wav_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 16-bit WAV bytes, parsed again."""
    pcm = numeric.to_pcm16(F.transform("embedding", lambda x: x.cast("double") * 4))
    clips = _read(spark, sf_dir, "embeddings").select("vec_id", audio.to_wav(pcm, 16_000).alias("content"))
    parsed = audio.scan_audio(clips, "vec_id")
    return parsed.select("vec_id", "rate", "channels", "frames", "duration_s", F.round(numeric.peak(F.col("samples")), 6).alias("peak"))


def spectral_centroid_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(audio.spectral_centroids(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding", 16_000, 32, 8), "centroid")


QUERIES = {
    f.__name__: f
    for f in (
        vec_centroid, pair_self_similarity, cosine_to_centroid, derived_threshold, speaker_verify_filter, token_wer, wer_filter, consistency_summary, latency_upper_median, outlier_3sigma_first_axis,
        qa_ladder, drop_histogram, retained_hours, recover_wer_union, drops_join_corpus, train_eval_split, split_overlap, eval_summary, winner, topk_latest, topk_named, milestone_reached, resume_from_latest,
        first_n, last_n, quality_suffix, peak_rms, to_pcm16, mono_mix, frame_rms_db, f0_stats, silent_runs, resume_anti, file_exists_semi, id_to_sentence, progress_poll, throughput_eta, stall_gaps,
        debounce_restarts, success_counts, stream_counts, stream_stalls, scan_psv_roundtrip, scan_jsonl_roundtrip, scan_tsv_kv_roundtrip,
        scan_text_lines_roundtrip, sink_append_resume, sink_manifest, survivor_semi, synth_map_join, centroid_cross, wav_roundtrip, spectral_centroid_mean,
    )
}

_PAD = "CASE WHEN length(doc_id::VARCHAR) >= 5 THEN doc_id::VARCHAR ELSE lpad(doc_id::VARCHAR, 5, '0') END"
_SPLIT = "SELECT clip_id, CASE WHEN row_number() OVER (ORDER BY md5('20260523:' || clip_id), clip_id) <= 250 THEN 'eval' ELSE 'train' END AS split FROM clips"
_CKPT = "WITH f AS (SELECT 'epoch=1-step=' || o_orderkey || '.ckpt' AS path, o_orderdate AS modified, o_orderkey::INT AS step FROM orders)"
_ROWS = "unnest(range(len(embedding)))::INT AS idx"
_GAPS = "SELECT user_id, stalled_from, ts AS stalled_to FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS stalled_from FROM events) WHERE epoch_us(ts) - epoch_us(stalled_from) > 43200000000"

ORACLES = {
    "vec_centroid": f"WITH {_CENTROIDS} SELECT label, idx, round(x, 6) AS x FROM m",
    "pair_self_similarity": "SELECT a.vec_id // 2 AS sid, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id % 2 = 0 AND b.vec_id = a.vec_id + 1",
    "cosine_to_centroid": f"WITH {_CENTROIDS} SELECT vec_id, label, round(similarity, 6) AS similarity FROM sim",
    "derived_threshold": f"WITH {_CENTROIDS} SELECT label, round_even(avg(similarity) * 0.75::DOUBLE, 3) AS least FROM sim GROUP BY 1",
    "speaker_verify_filter": f"WITH {_CENTROIDS}, t AS (SELECT label, round_even(avg(similarity) * 0.75::DOUBLE, 3) AS least FROM sim GROUP BY 1) SELECT vec_id, label, round(similarity, 6) AS similarity FROM sim JOIN t USING (label) WHERE NOT similarity < least",
    "token_wer": f"{_WER} SELECT doc_id, pos, round(wer, 6) AS wer FROM w",
    "wer_filter": f"{_WER} SELECT wer > 0.08 AS dropped, count(*) AS n, round(avg(greatest(0, least(1, wer))), 6) AS mean_wer FROM w GROUP BY 1",
    "consistency_summary": "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, round(min(value), 6) AS least, round(max(value), 6) AS most, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1",
    "latency_upper_median": "SELECT event_type, round(list_sort(list(value))[count(*) // 2 + 1], 6) AS upper_median FROM events GROUP BY 1",
    "outlier_3sigma_first_axis": """WITH s AS (SELECT event_type, avg(value) m1, stddev_pop(value) s1, avg(value * value) m2, stddev_pop(value * value) s2 FROM events GROUP BY 1)
SELECT event_id, CASE WHEN abs(value - m1) > 3 * s1 THEN 'value' ELSE 'square' END AS axis, round(CASE WHEN abs(value - m1) > 3 * s1 THEN m1 ELSE m2 END, 6) AS mu, round(CASE WHEN abs(value - m1) > 3 * s1 THEN s1 ELSE s2 END, 6) AS sd
FROM events JOIN s USING (event_type) WHERE s1 > 0 AND abs(value - m1) > 3 * s1 OR s2 > 0 AND abs(value * value - m2) > 3 * s2""",
    "qa_ladder": f"{_LADDER} SELECT id, outcome, axis FROM outcomes",
    "drop_histogram": f"{_LADDER} SELECT outcome AS filter, count(*) AS n FROM outcomes GROUP BY 1",
    "retained_hours": f"{_LADDER} SELECT round(coalesce(sum(duration_s) FILTER (outcome = 'kept'), 0) / 3600, 6) AS retained_hours, round(count(*) FILTER (outcome <> 'kept') / greatest(count(*), 1), 6) AS drop_rate, coalesce(sum(duration_s) FILTER (outcome = 'kept'), 0) / 3600 < 2 AS below_floor FROM outcomes",
    "recover_wer_union": f"{_LADDER} SELECT CASE WHEN length(id::VARCHAR) >= 5 THEN id::VARCHAR ELSE lpad(id::VARCHAR, 5, '0') END AS clip_id, sentence, CASE outcome WHEN 'kept' THEN '1_curated' ELSE '2_recovered' END AS origin FROM outcomes WHERE outcome = 'kept' OR outcome = 'wer' AND id % 5 <> 2 AND id % 7 <> 3",
    "drops_join_corpus": f"{_LADDER} SELECT count(*) AS n_skipped FROM outcomes WHERE outcome = 'wer' AND (id % 5 = 2 OR id % 7 = 3)",
    "train_eval_split": f"WITH clips AS (SELECT {_PAD} AS clip_id FROM documents) {_SPLIT}",
    "split_overlap": f"WITH c AS (SELECT doc_id, {_PAD} AS clip_id FROM documents), a AS (WITH clips AS (SELECT clip_id FROM c WHERE doc_id % 3 <> 0) {_SPLIT}), b AS (WITH clips AS (SELECT clip_id FROM c) {_SPLIT}) SELECT count(*) AS leaked FROM a WHERE split = 'eval' AND clip_id IN (SELECT clip_id FROM b WHERE split = 'train')",
    "eval_summary": f"{_SUMMARY} SELECT checkpoint, n_eval, " + ", ".join(f"round({c}, 6) AS {c}" for c in _FIGURES) + ", ambiguous FROM f",
    "winner": f"{_SUMMARY} SELECT checkpoint, round(rank_score, 6) AS rank_score FROM f ORDER BY coalesce(f.rank_score, -1e9) DESC, checkpoint LIMIT 1",
    "topk_latest": f"{_CKPT} SELECT path, modified FROM f ORDER BY modified DESC, path DESC LIMIT 3",
    "topk_named": f"{_CKPT} SELECT path, step FROM f WHERE step IN (380, 390, 400)",
    "milestone_reached": f"{_CKPT} SELECT coalesce(bool_or(step >= 4000), false) AS reached FROM f",
    "resume_from_latest": f"{_CKPT} SELECT coalesce((SELECT path FROM f ORDER BY modified DESC, path DESC LIMIT 1), 'base.ckpt') AS resume_from",
    "first_n": f"SELECT {_PAD} AS clip_id FROM documents ORDER BY doc_id LIMIT 5",
    "last_n": "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 10",
    "quality_suffix": f"WITH c AS (SELECT c_custkey, {_NAME} FROM customer) SELECT CASE WHEN length(c_custkey::VARCHAR) >= 3 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 3, '0') END AS clip_id, CASE WHEN string_split(name, '-')[-1] IN ('x_low', 'low', 'medium', 'high') THEN string_split(name, '-')[-1] ELSE coalesce(known, 'medium') END AS quality FROM c",
    "peak_rms": """WITH a AS (SELECT vec_id, list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) AS peak, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)) / len(embedding)) AS rms, len(embedding) / 16000.0::DOUBLE AS duration_s FROM embeddings)
SELECT vec_id, round(peak, 6) AS peak, round(rms, 6) AS rms, round(duration_s, 6) AS duration_s, round(20 * log10(rms + 1e-9), 6) AS db, round(CASE WHEN duration_s > 0 THEN vec_id / duration_s ELSE 0 END, 6) AS rate, round(duration_s / greatest(vec_id, 1), 6) AS ratio FROM a""",
    "to_pcm16": f"WITH r AS (SELECT vec_id, {_ROWS}, unnest(embedding)::DOUBLE * 4 AS x FROM embeddings) SELECT vec_id, idx, trunc(greatest(-1, least(1, x)) * 32767)::INT AS x FROM r",
    "mono_mix": f"SELECT vec_id, {_ROWS}, round((unnest(embedding)::DOUBLE + unnest(list_reverse(embedding))::DOUBLE) / 2, 6) AS x FROM embeddings",
    "frame_rms_db": "WITH f AS (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(range(len(embedding) // 8 + 1))::INT AS idx FROM embeddings) SELECT vec_id, idx, round(20 * log10(sqrt(list_sum(list_transform(e[greatest(idx * 8 - 8, 0) + 1 : least(idx * 8 + 8, len(e))], lambda x: x * x)) / 16) + 1e-9), 6) AS db FROM f",
    "f0_stats": "WITH v AS (SELECT vec_id, list_filter(embedding::DOUBLE[], lambda x: x > 0) AS v FROM embeddings) SELECT vec_id, round(coalesce(list_avg(v), 0), 6) AS f0_mean, round(coalesce(list_max(v) - list_min(v), 0), 6) AS f0_range FROM v",
    "silent_runs": f"""WITH r AS (SELECT vec_id, len(embedding) AS n, {_ROWS}, 20 * log10(abs(unnest(embedding)::DOUBLE) + 1e-9) < -15 AS quiet FROM embeddings),
i AS (SELECT vec_id, n, idx, idx - row_number() OVER (PARTITION BY vec_id ORDER BY idx) AS island FROM r WHERE quiet),
g AS (SELECT vec_id, n, (min(idx) * 160)::INT AS start, ((max(idx) + 1) * 160)::INT AS "end" FROM i GROUP BY vec_id, n, island)
SELECT vec_id, start, "end" FROM g WHERE ("end" - start) * 1000 / 16000.0 >= 20 AND start >= 160 AND "end" <= n * 160 - 160""",
    "resume_anti": "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "file_exists_semi": f"SELECT {_PAD} AS clip_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "id_to_sentence": "SELECT doc_id AS id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "progress_poll": "SELECT count(DISTINCT doc_id) AS done, round_even(100 * count(DISTINCT doc_id) / 400, 1) AS percent, count(DISTINCT doc_id) >= 400 AS finished FROM labels",
    "throughput_eta": """WITH t AS (SELECT user_id, count(*) AS done, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM events GROUP BY 1)
SELECT user_id, done, round(seconds, 6) AS seconds, round(CASE WHEN seconds > 0 THEN done / seconds END, 6) AS rate, round(greatest(12000 - done, 0) / CASE WHEN seconds > 0 THEN done / seconds END / 3600, 6) AS eta_hours FROM t""",
    "stall_gaps": _GAPS,
    "stream_stalls": _GAPS,
    "debounce_restarts": """WITH t AS (SELECT user_id, ts, event_id, event_id % 3 = 0 AS active, sum((event_id % 3 = 0)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
q AS (SELECT *, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS nth FROM t WHERE NOT active),
f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS restart FROM q WHERE nth % 2 = 0) SELECT * FROM f WHERE restart <= 10""",
    "success_counts": "SELECT user_id, count(*) AS total, count(*) FILTER (event_id % 7 <> 0) AS ok, count(*) FILTER (event_id % 7 = 0) AS failed FROM events GROUP BY 1",
    "stream_counts": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "scan_psv_roundtrip": f"WITH {CURATED} SELECT {_PAD} AS clip_id, {_QUOTED} AS sentence FROM curated",
    "scan_jsonl_roundtrip": f"{_LADDER} SELECT id, outcome AS filter, axis FROM outcomes WHERE outcome <> 'kept'",
    "scan_tsv_kv_roundtrip": f"WITH {CURATED} SELECT s AS key, upper(s) || chr(9) || 'more' AS value FROM curated",
    "scan_text_lines_roundtrip": f"WITH {CURATED} SELECT s AS line, count(*) AS n FROM curated GROUP BY 1",
    "sink_append_resume": "SELECT DISTINCT doc_id AS id FROM labels",
    "sink_manifest": f"{_LADDER} SELECT count(*) AS input, count(*) FILTER (outcome = 'kept') AS kept, count(*) FILTER (outcome <> 'kept') AS dropped FROM outcomes",
    "survivor_semi": f"{_LADDER} SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT id FROM outcomes WHERE outcome = 'kept')",
    "synth_map_join": f"WITH clips AS (SELECT {_PAD} AS clip_id FROM documents), s AS ({_SPLIT}) SELECT clip_id, quality FROM s JOIN labels ON clip_id = {_PAD} WHERE split = 'eval'",
    "centroid_cross": "WITH x AS (SELECT unnest(range(len(embedding))) AS idx, unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT idx, avg(x) AS x FROM x GROUP BY 1), c AS (SELECT list(x ORDER BY idx) AS c FROM m) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS similarity FROM embeddings, c",
    "spectral_centroid_mean": """WITH x AS (SELECT vec_id, len(embedding) AS n, unnest(range(len(embedding))) AS j, unnest(embedding)::DOUBLE AS x FROM embeddings),
s AS (SELECT vec_id, x, j + 16 AS p, unnest(range(0, n + 1, 8)) AS f FROM x), i AS (SELECT vec_id, f, p - f AS k, x * (0.5 - 0.5 * cos(2 * pi() * (p - f) / 32)) AS y FROM s WHERE p - f BETWEEN 0 AND 31),
b AS (SELECT vec_id, f, unnest(range(17)) AS q, k, y FROM i), m AS (SELECT vec_id, f, q, sqrt(sum(y * cos(2 * pi() * k * q / 32)) ** 2 + sum(y * sin(2 * pi() * k * q / 32)) ** 2) AS a FROM b GROUP BY 1, 2, 3),
c AS (SELECT vec_id, f, CASE WHEN sum(a) > 0 THEN sum(a * q * 500) / sum(a) ELSE 0 END AS c FROM m GROUP BY 1, 2) SELECT vec_id, round(avg(c), 6) AS centroid FROM c GROUP BY 1""",
    "wav_roundtrip": "SELECT vec_id, 16000 AS rate, 1 AS channels, len(embedding) AS frames, len(embedding) / 16000.0::DOUBLE AS duration_s, round(list_max(list_transform(embedding::DOUBLE[], lambda x: abs(trunc(greatest(-1, least(1, x * 4)) * 32767) / 32768))), 6) AS peak FROM embeddings",
}
