"""The quality flow from WAV bytes to outcomes and output clips.

The steps up to the figures are narrow: a clip's samples go from scan to models within one task and
are never shuffled. A model sees only the clips that all earlier filters let through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import Quality
from quern.functions import numeric
from quern.operators import models, quality
from quern.session import materialize
from quern.sources import audio

OUTPUT_RATE = 22_050
FRAME = 400


def signal_figures(files: DataFrame, q: Quality = Quality()) -> DataFrame:
    """Clips with samples at the ladder's rate, and what is measured without a model.

    files: id, sentence, content; a null content is a missing file. A null sentence counts as empty.
    """
    read = audio.scan_audio(files.select("id", F.coalesce("sentence", F.lit("")).alias("sentence"), F.col("content").isNotNull().alias("has_file"), "content"), "id", target=q.sample_rate, keep=("sentence", "has_file"))
    samples = F.col("samples")
    levels = F.transform(F.coalesce(numeric.frame_rms(samples, FRAME, q.hop), F.array().cast("array<double>")), numeric.decibel)
    return read.select(
        "id", "sentence", "has_file", F.when(F.col("has_file"), F.col("error")).alias("load_error"),
        numeric.duration(samples, q.sample_rate).alias("duration_s"), numeric.peak(samples).alias("peak"), numeric.rms(samples).alias("rms"), levels.alias("levels"), "samples",
    ).withColumn("silences", F.size(quality.inner_silences(F.col("levels"), F.size("samples"), q))).drop("levels")


def _modelled(clips: DataFrame, passed: Column, measure: Callable[[], Callable[[np.ndarray], tuple]], names: list[str], kinds: list[str]) -> DataFrame:
    """``clips`` with columns of a model's figures, null for clips that an earlier filter drops."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = measure()
        for frame in frames:
            found = [model(x) if ok else (None,) * len(names) for x, ok in zip(frame["samples"], frame.pop("_ok"), strict=True)]
            for k, name in enumerate(names):
                frame[name] = pd.Series([f[k] for f in found], index=frame.index, dtype=object)
            yield frame

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in clips.schema.fields), *(f"{n} {k}" for n, k in zip(names, kinds, strict=True))])
    return clips.withColumn("_ok", F.coalesce(passed, F.lit(False))).mapInPandas(run, schema)


def figures(
    files: DataFrame,
    centroids: DataFrame,
    thresholds: DataFrame,
    transcriber: Callable[[], models.Transcriber],
    ecapa: Callable[[], models.SpeakerEncoder],
    wavlm: Callable[[], models.SpeakerEncoder],
    pitch: Callable[[], Callable[[np.ndarray], np.ndarray]],
    q: Quality = Quality(),
) -> DataFrame:
    """Every clip's figures as the ladder wants them, written to the shared folder: models run once.

    centroids: one row with the arrays ecapa and wavlm; thresholds: one row with ecapa_min and
    wavlm_min. A transcriber's failure is the clip's ``asr_error``, a pitch tracker's gives zeros,
    and an encoder's fails the task.
    """

    def hear() -> Callable[[np.ndarray], tuple]:
        model = transcriber()

        def one(x: np.ndarray) -> tuple:
            try:
                return model(x), None
            except Exception as e:
                return None, f"{type(e).__name__}: {e}"

        return one

    def know() -> Callable[[np.ndarray], tuple]:
        first, second = ecapa(), wavlm()
        return lambda x: ([float(v) for v in first(x)], [float(v) for v in second(x)])

    def describe() -> Callable[[np.ndarray], tuple]:
        track = pitch()

        def one(x: np.ndarray) -> tuple:
            try:
                f0 = [float(v) for v in track(x)]
            except Exception:
                f0 = []
            return f0, audio.spectral_centroid(x, q.sample_rate)

        return one

    heard = _modelled(signal_figures(files, q), quality.first_stage(q).isNull(), hear, ["transcript", "asr_error"], ["string", "string"])
    heard = heard.withColumn("wer", F.when(F.col("transcript").isNotNull(), numeric.token_wer(F.col("sentence"), F.col("transcript"))))
    understood = quality.first_stage(q).isNull() & F.col("asr_error").isNull() & ~F.coalesce(F.col("wer") > q.wer_max, F.lit(False))
    known = _modelled(heard, understood, know, ["_ecapa", "_wavlm"], ["array<double>", "array<double>"])
    voices = centroids.join(F.broadcast(thresholds)).select(F.col("ecapa").alias("_e"), F.col("wavlm").alias("_w"), "ecapa_min", "wavlm_min")
    similar = known.join(F.broadcast(voices)).withColumn("ecapa", numeric.cosine(F.col("_ecapa"), F.col("_e"))).withColumn("wavlm", numeric.cosine(F.col("_wavlm"), F.col("_w")))
    passed = F.col("_ecapa").isNotNull() & quality.second_stage(F.col("ecapa_min"), F.col("wavlm_min"), q).isNull()
    similar = similar.withColumn("_passed", passed).drop("_ecapa", "_wavlm", "_e", "_w", "ecapa_min", "wavlm_min")
    described = _modelled(similar, F.col("_passed"), describe, ["f0", "centroid"], ["array<double>", "double"])
    done = described.withColumn("_s", numeric.f0_stats(F.col("f0"))).withColumn("f0_mean", F.when(F.col("f0").isNotNull(), F.col("_s.f0_mean"))).withColumn("f0_range", F.when(F.col("f0").isNotNull(), F.col("_s.f0_range")))
    return materialize(done.drop("samples", "f0", "_s", "_passed"), "clips")


def output_clips(outcomes: DataFrame, files: DataFrame, rate: int = OUTPUT_RATE) -> DataFrame:
    """(id, sentence, wav) of the kept clips: mono 16-bit WAV bytes at the output rate."""
    kept = files.join(outcomes.where("outcome = 'kept'").select("id"), "id", "left_semi").select("id", "sentence", "content")
    clips = audio.scan_audio(kept, "id", target=rate, keep=("sentence",))
    return clips.select("id", "sentence", audio.to_wav(numeric.to_pcm16(F.col("samples")), rate).alias("wav"))
