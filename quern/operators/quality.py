"""The ordered quality ladder, outliers, recovery and summaries over clips.

A clip row has id, sentence, duration_s, peak, rms, silences, wer, ecapa, wavlm, f0_mean, centroid,
and flags or texts for what went wrong: has_file, load_error, asr_error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import Quality
from quern.functions import numeric


def _number(x: Column) -> Column:
    """False for NaN, so comparisons with it fail as they do for IEEE numbers."""
    return ~F.isnan(x.cast("double"))


def first_stage(q: Quality = Quality()) -> Column:
    """Why a clip is dropped before any model is called, or null. An unknown ``has_file`` is a missing file."""
    chars = F.length("sentence")
    ratio = numeric.duration_ratio(F.col("duration_s"), chars)
    return (
        F.when(~F.coalesce("has_file", F.lit(False)), "missing_file")
        .when(F.col("load_error").isNotNull(), "load_error")
        .when(_number(ratio) & ((ratio < q.ratio_min) | (ratio > q.ratio_max)), "duration_ratio")
        .when(_number(F.col("peak")) & (F.col("peak") >= q.clip_peak), "clipping")
        .when(F.col("rms") < q.rms_min, "rms_low")
        .when(F.col("silences") > 0, "internal_silence")
    )


def second_stage(ecapa_min: Column, wavlm_min: Column, q: Quality = Quality()) -> Column:
    """Why a clip is dropped on what the models say, or null. A NaN similarity passes."""
    return (
        F.when(F.col("asr_error").isNotNull(), "whisper_error")
        .when(_number(F.col("wer")) & (F.col("wer") > q.wer_max), "wer")
        .when((F.col("ecapa") < ecapa_min) | (F.col("wavlm") < wavlm_min), "speaker_verify")
    )


def outliers(rows: DataFrame, axes: tuple[str, ...], sigmas: float = 3.0, by: str | None = None, among: Column | None = None) -> DataFrame:
    """Rows with ``axis``, ``value``, ``mu`` and ``sd`` of the first axis on which they stand out; nulls elsewhere.

    Means and population deviations come from one aggregate over the rows, or one per group. With
    ``among`` only rows for which it holds count, and only those can stand out.
    """
    keys = [by] if by else []
    counted = F.lit(True) if among is None else among
    stats = rows.groupBy(*keys).agg(*[x for a in axes for x in (F.avg(F.when(counted, F.col(a))).alias(f"_mu_{a}"), F.stddev_pop(F.when(counted, F.col(a))).alias(f"_sd_{a}"))])
    joined = rows.join(stats, by) if by else rows.join(F.broadcast(stats))  # without groups one row
    out = F.lit(None).cast("struct<axis:string,value:double,mu:double,sd:double>")
    for a in reversed(axes):
        v, mu, sd = F.col(a).cast("double"), F.col(f"_mu_{a}"), F.col(f"_sd_{a}")
        hit = counted & _number(v) & (sd > 0) & (F.abs(v - mu) > sigmas * sd)
        out = F.when(hit, F.struct(F.lit(a).alias("axis"), v.alias("value"), mu.alias("mu"), sd.alias("sd"))).otherwise(out)
    return joined.withColumn("_out", out).select(*rows.columns, "_out.*")


def ladder(clips: DataFrame, thresholds: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Every clip with its one outcome: the first filter that drops it, or ``kept``.

    thresholds: one row with ecapa_min and wavlm_min. Outliers are found among what passes all
    other filters, with a second scan for their statistics. The stages are separate columns, so
    that models, as Arrow functions, can stand between.
    """
    staged = clips.withColumn("outcome", first_stage(q))
    scored = staged.join(F.broadcast(thresholds)).withColumn("outcome", F.coalesce("outcome", second_stage(F.col("ecapa_min"), F.col("wavlm_min"), q))).drop("ecapa_min", "wavlm_min")
    marked = outliers(scored, q.axes, q.sigmas, among=F.col("outcome").isNull())
    last = F.when(F.col("axis").isNotNull(), "outlier").otherwise("kept")
    return marked.withColumn("outcome", F.coalesce("outcome", last))


def drop_records(outcomes: DataFrame) -> DataFrame:
    """A record per dropped clip in the form of ``files.DROP_SCHEMA``: the filter, and the figures on which it decided; null elsewhere."""
    chars = F.length("sentence")
    figures = {
        "error": {"load_error": F.col("load_error"), "whisper_error": F.col("asr_error")},
        "duration": {"duration_ratio": F.col("duration_s")},
        "chars": {"duration_ratio": chars},
        "ratio": {"duration_ratio": numeric.duration_ratio(F.col("duration_s"), chars)},
        "peak": {"clipping": F.col("peak")},
        "rms": {"rms_low": F.col("rms")},
        "count": {"internal_silence": F.col("silences")},
        "wer": {"wer": F.col("wer")},
        "ref": {"wer": F.col("sentence")},
        "hyp": {"wer": F.col("transcript") if "transcript" in outcomes.columns else F.lit(None).cast("string")},
        "ecapa": {"speaker_verify": F.col("ecapa")},
        "wavlm": {"speaker_verify": F.col("wavlm")},
    }
    columns = [F.coalesce(*[F.when(F.col("outcome") == name, value) for name, value in by.items()]).alias(field) for field, by in figures.items()]
    return outcomes.where("outcome <> 'kept'").select("id", F.col("outcome").alias("filter"), *columns, "axis", "value", "mu", "sd")


def drop_histogram(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy(F.col("outcome").alias("filter")).agg(F.count(F.lit(1)).alias("n"))


def retained(outcomes: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Kept hours, the share of drops, and whether too little is left."""
    kept = F.col("outcome") == "kept"
    hours = F.coalesce(F.sum(F.when(kept, F.col("duration_s"))), F.lit(0.0)) / 3600
    return outcomes.agg(hours.alias("retained_hours"), (F.count_if(~kept) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("drop_rate"), (hours < q.min_hours).alias("below_floor"))


def recover(outcomes: DataFrame, corpus: DataFrame, files: DataFrame, strict: DataFrame | None = None) -> DataFrame:
    """(id, sentence, origin): kept clips, then those dropped for their error rate alone.

    Recovered clips need a sentence and a file. ``strict``: ids that also pass the later filters.
    """
    files = files.select("id") if strict is None else files.select("id").join(strict.select("id"), "id", "left_semi")
    can = corpus.select(F.col("id").alias("_id"), F.col("sentence").alias("_sentence")).join(files.select(F.col("id").alias("_id")), "_id", "left_semi")
    # one pass over the outcomes: kept clips look up nothing
    rows = outcomes.where("outcome IN ('kept', 'wer')").select("id", "sentence", (F.col("outcome") == "kept").alias("_kept"))
    both = rows.join(can, (F.col("id") == F.col("_id")) & ~F.col("_kept"), "left").where("_kept OR _id IS NOT NULL")
    return both.select("id", F.when(F.col("_kept"), F.col("sentence")).otherwise(F.col("_sentence")).alias("sentence"), F.when(F.col("_kept"), "1_curated").otherwise("2_recovered").alias("origin"))


def skipped(outcomes: DataFrame, corpus: DataFrame, files: DataFrame) -> DataFrame:
    """How many error-rate drops can't be recovered."""
    drops = outcomes.where("outcome = 'wer'").select("id")
    found = drops.join(corpus.select("id"), "id", "left_semi").join(files.select("id"), "id", "left_semi")
    return drops.join(found, "id", "left_anti").agg(F.count(F.lit(1)).alias("n_skipped"))


def inner_silences(level: Column, samples: Column, q: Quality = Quality()) -> Column:
    """Start and end in samples of inner silences: runs of quiet frames that are long enough and not at the edges.

    Runs are islands within one clip's frames, found in the array itself: no row per frame is shuffled.
    """
    quiet = F.transform(level, lambda x: F.coalesce(x < q.silence_db, F.lit(False)))
    n = F.size(level)
    starts = F.filter(F.transform(quiet, lambda x, i: F.when(x & ((i == 0) | ~F.get(quiet, i - 1)), i)), lambda i: i.isNotNull())
    ends = F.filter(F.transform(quiet, lambda x, i: F.when(x & ((i == n - 1) | ~F.get(quiet, i + 1)), i + 1)), lambda i: i.isNotNull())
    runs = F.zip_with(starts, ends, lambda s, e: F.struct((s * q.hop).alias("start"), (e * q.hop).alias("end")))
    edge = int(q.edge_s * q.sample_rate)
    long = lambda r: (r["end"] - r["start"]) * 1000 / F.lit(float(q.sample_rate)) >= q.silence_ms
    return F.filter(runs, lambda r: long(r) & (r["start"] >= edge) & (r["end"] <= samples - edge))


def silent_runs(frames: DataFrame, key: str, levels: str, samples: str, q: Quality = Quality()) -> DataFrame:
    """(key, start, end): a row for each of ``inner_silences``."""
    return frames.select(key, F.explode(inner_silences(F.col(levels), F.col(samples), q)).alias("r")).select(key, "r.start", "r.end")


def at_ranks(rows: DataFrame, value: str, by: list[str], ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(by, ranked): for each group the values at some ranks of its sorted values, counted from 0; nulls have none.

    ranks: from a group's number of values to the ranks. Values fall into cells of about 0.1 %, in their order; cells are
    counted before the shuffle, and only those that hold a wanted rank are looked into, value by value. No task holds a
    group, unless nearly all of its values lie within one cell; even then it sorts distinct values and can spill.
    NaN is the greatest value.
    """
    v = F.col("_v").cast("double")
    cell = F.when(F.isnan(v), F.lit(2**62)).otherwise(F.floor(F.signum(v) * F.log1p(F.abs(v)) * 1024))
    keyed = rows.where(F.col(value).isNotNull()).select(F.struct(*(by or [F.lit(0)])).alias("_g"), F.col(value).alias("_v")).withColumn("_cell", cell)
    cells = keyed.groupBy("_g", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_g").orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("_before", F.sum("_n").over(upto) - F.col("_n")).withColumn("_all", F.sum("_n").over(Window.partitionBy("_g")))
    wanted = placed.select("_g", "_cell", "_before", "_n", F.posexplode(F.array(*[r.cast("long") for r in ranks(F.col("_all"))])).alias("_at", "_rank"))
    wanted = wanted.where("_rank >= _before AND _rank < _before + _n").select("_g", "_cell", "_at", (F.col("_rank") - F.col("_before")).alias("_rank"))
    inside = keyed.join(wanted.select("_g", "_cell").distinct(), ["_g", "_cell"], "left_semi").groupBy("_g", "_cell", "_v").agg(F.count(F.lit(1)).alias("_m"))
    within = Window.partitionBy("_g", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("_end", F.sum("_m").over(within))
    found = inside.join(wanted, ["_g", "_cell"]).where("_rank >= _end - _m AND _rank < _end")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"])
    return found.groupBy("_g").agg(listed.alias("ranked")).select(*[F.col(f"_g.{c}") for c in by], "ranked")


def consistency(rows: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Mean, population deviation, extremes and exact percentiles, interpolated between the two nearest ranks."""
    by, points = by or [], (0.1, 0.5, 0.9)
    stats = rows.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.min(value).alias("least"), F.max(value).alias("most"))
    ranked = at_ranks(rows, value, by, lambda n: [f((n - 1) * F.lit(p)) for p in points for f in (F.floor, F.ceil)])
    ranked = ranked.select(*[F.col(c).alias(f"_{c}") for c in by], "ranked")
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))

    def point(i: int) -> Column:
        place = (F.col("n") - 1) * F.lit(points[i])
        low, high = (F.get("ranked", F.lit(2 * i + j)).cast("double") for j in (0, 1))
        return F.when(low == high, low).otherwise((F.ceil(place) - place) * low + (place - F.floor(place)) * high)

    return stats.join(ranked, same, "left").select(*by, "n", "mean", "sd", "least", "most", *[point(i).alias(f"p{int(100 * p)}") for i, p in enumerate(points)])


def upper_median(rows: DataFrame, value: str, by: str) -> DataFrame:
    """The element at floor(n / 2) of the sorted values: for even n the upper of the middle two."""
    return at_ranks(rows, value, [by], lambda n: [F.floor(n / 2)]).select(by, F.get("ranked", F.lit(0)).alias("upper_median"))


def threshold(value: str, factor: float = 0.75, digits: int = 3) -> Column:
    """The mean times a factor, rounded half to even."""
    return F.bround(F.avg(value) * F.lit(factor), digits)
