"""Numeric, vector and audio scalars as Spark columns. Sums run in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.config import Evaluation, Quality
from quern.functions import text

NAN = float("nan")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Dot product over norms; NaN where a norm is zero."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(NAN)).otherwise(dot(a, b) / F.when(norm != 0, norm))


def token_wer(ref: Column, hyp: Column) -> Column:
    """Token edits over reference tokens; 0 for an empty reference.

    Tokens become single characters, numbered among the pair's distinct tokens, so that the
    built-in edit distance of strings is that of the token lists. Numbering avoids surrogates.
    """

    def rate(pair: Column) -> Column:
        r, h = pair["r"], pair["h"]
        code = lambda tokens, known: F.array_join(F.transform(tokens, lambda t: character(F.array_position(known, t))), "")
        edits = text.let(F.array_distinct(F.concat(r, h)), lambda known: F.levenshtein(code(r, known), code(h, known)))
        return F.when(F.size(r) == 0, 0.0).otherwise(edits / F.when(F.size(r) > 0, F.size(r)))

    return text.let(F.struct(text.words(text.normalize_wer(ref)).alias("r"), text.words(text.normalize_wer(hyp)).alias("h")), rate)


def character(i: Column) -> Column:
    """The i-th character of the basic plane from U+0100 on, without the surrogates."""
    code = F.when(i + 255 < 0xD800, i + 255).otherwise(i + 255 + 0x800)
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("int")), 4, "0")), "UTF-16BE")


def peak(samples: Column) -> Column:
    return F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double"))))


def rms(samples: Column) -> Column:
    return F.sqrt(dot(samples, samples) / F.when(F.size(samples) > 0, F.size(samples)))


def duration(samples: Column, rate: int = Quality.sample_rate) -> Column:
    return F.size(samples) / F.lit(float(rate))


def mono(channels: Column) -> Column:
    """The mean over channels of an array of frames, each an array of channels."""
    return F.transform(channels, lambda frame: total(frame) / F.size(frame))


def to_pcm16(samples: Column) -> Column:
    """Clipped to [-1, 1], scaled and truncated toward zero."""
    return F.transform(samples, lambda x: (F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x.cast("double"))) * 32767).cast("short"))


def speaking_rate(chars: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, chars / F.when(seconds > 0, seconds)).otherwise(0.0)


def duration_ratio(seconds: Column, chars: Column) -> Column:
    return seconds / F.greatest(chars, F.lit(1))


def decibel(level: Column) -> Column:
    return 20 * F.log10(level + 1e-9)


def frame_rms(samples: Column, frame: int = 400, hop: int = 160) -> Column:
    """Root mean squares of centred frames over zero-padded audio."""
    n = (F.size(samples) / hop).cast("int") + 1
    half = frame // 2

    def level(i: Column) -> Column:
        start = i * hop - half
        low = F.greatest(start, F.lit(0))
        part = F.slice(samples, low + 1, F.greatest(F.least(start + frame, F.size(samples)) - low, F.lit(0)))
        return F.sqrt(dot(part, part) / frame)

    return F.when(F.size(samples) > 0, F.transform(F.sequence(F.lit(0), n - 1), level))


def f0_stats(f0: Column) -> Column:
    """Mean and range of the voiced frames (positive and finite); zeros if there are none."""
    voiced = F.filter(F.transform(f0, lambda x: x.cast("double")), lambda x: (x > 0) & ~F.isnan(x) & (x < float("inf")))
    n = F.size(voiced)
    return F.struct(
        F.when(n > 0, total(voiced) / F.when(n > 0, n)).otherwise(0.0).alias("f0_mean"),
        F.when(n > 0, F.array_max(voiced) - F.array_min(voiced)).otherwise(0.0).alias("f0_range"),
    )


def clip01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def composite(ecapa: Column, wavlm: Column, wer: Column, e: Evaluation = Evaluation()) -> Column:
    return e.ecapa_weight * ecapa + e.wavlm_weight * wavlm + e.wer_weight * (1 - clip01(wer)) + e.constant


def percent_done(n: Column, target: int) -> Column:
    return F.bround(100 * n / target, 1)
