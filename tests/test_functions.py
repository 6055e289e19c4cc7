"""Hand-made cases of the scalar functions."""

import math

import pytest
from pyspark.sql import functions as F

from quern.functions import numeric, text


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(column).collect()]


def test_sentence_split(spark):
    cases = {
        "He met Mr. Darcy. It rained.": ["He met Mr.", "Darcy.", "It rained."],
        'Stop! "No," he said. then left.': ["Stop!", '"No," he said. then left.'],
        "One.Two. Three": ["One.Two.", "Three"],
        "A—B went. C": ["A — B went.", "C"],
        " \n\t ": [],
        "": [],
        None: None,
    }
    assert values(spark, text.sentence_split(F.col("x")), cases) == list(cases.values())


def test_normalize(spark):
    cases = {
        "Dr. Hall paid 7 coins": "Doctor Hall paid seven coins",
        "He is 21 and 007 and 20.": "He is 21 and 007 and twenty.",
        "mr. X": "mr. X",
        "No. 5 vs. No. 12": "Number five versus Number twelve",
        "“Hi”--it’s": '"Hi" — it\'s',
        "Mrs.Smith ran": "MissesSmith ran",
        "3rd of 3": "3rd of three",
        "a  b": "a b",
        "é5 5": "é5 five",
        "": "",
        None: None,
    }
    assert values(spark, text.normalize(F.col("x")), cases) == list(cases.values())


def test_reject_reason(spark):
    words = "alpha beta gamma delta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi".split()
    cases = {
        "We saw the red boat": None,
        "We saw it": "a",
        "See www.a.b for the rest": "b",
        "There were 31 old men here": "c",
        "THAT IS NOT WHAT THEY said": "d",
        "He HELD THIS to be true": "d",
        "He said that that was so": "e",
        "The café was closed all day": "f",
        "We left — it was late": "f",
        "Part of the wall fell down": "g",
        "Partly open doors are best here": None,
        '"A" said "B" to us all': "h",
        'One "quoted" word is fine here': None,
        " ".join(words[:20]): None,
        " ".join(words[:21]): "a",
    }
    found = values(spark, text.reject_reason(F.col("x")), cases)
    assert [f and f[0] for f in found] == list(cases.values())


def test_buckets_and_prosody(spark):
    found = values(spark, text.length_bucket(F.col("x")), [3, 4, 8, 9, 14, 15, 20, 21, None], "x int")
    assert found == [None, "short", "short", "med", "med", "long", "long", None, None]
    cases = {"Is it so, then?": "interrogative", "Run; now!": "exclamatory", "One, two": "complex", "She said: go": "complex", "Plain words.": "declarative", 'Plain words?"': "declarative", None: None}
    assert values(spark, text.prosody(F.col("x")), cases) == list(cases.values())


@pytest.mark.parametrize(
    ("ref", "hyp", "rate"),
    [
        ("The cat sat", "the cat sat", 0), ("The cat sat", "the cat sit", 1 / 3), ("", "x y", 0), ("a b", "", 1), ("one two", "one two three four five", 1.5),
        ("rock & roll", "rock and roll", 0), ("well-known fact", "well known fact", 0), ("It's 5 o'clock", "it's o'clock", 0), ("12 34", "anything", 0),
    ],
)
def test_token_wer(spark, ref, hyp, rate):
    assert values(spark, numeric.token_wer(F.col("a"), F.col("b")), [(ref, hyp)], "a string, b string")[0] == pytest.approx(rate)


def test_token_wer_with_many_distinct_tokens(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    tokens = [a + b + c for a in letters for b in letters for c in "abcd"]
    hyp = tokens[:1000] + ["zzzz"] + tokens[1001:]
    assert values(spark, numeric.token_wer(F.col("a"), F.col("b")), [(" ".join(tokens), " ".join(hyp))], "a string, b string")[0] == pytest.approx(1 / len(tokens))


def test_phonemes(spark):
    cases = {"ð_ə k_ˈæ_t": ("ð ə k æ t", "ð ə;ə k;k æ;æ t", 2), "ˈˌɪ_n": ("ɪ n", "ɪ n", 1), "a__b_ ˈ": ("a b", "a b", 0), "h_ə_l_ˈoʊ": ("h ə l oʊ", "h ə;ə l;l oʊ", 2), "": ("", "", 0)}
    t = text.phoneme_tokens(F.col("x"))
    found = values(spark, F.struct(F.array_join(t, " "), F.array_join(text.bigrams(t), ";"), text.accent_markers(t)), cases)
    assert [tuple(f) for f in found] == list(cases.values())


def test_strip_boilerplate(spark):
    start, end = "*** START OF THE PROJECT GUTENBERG EBOOK X ***", "*** END OF THIS PROJECT GUTENBERG EBOOK X ***"
    cases = {f"a{start}b{end}c": "b", f"a{start}b": "b", f"b{end}c": "b", "b": "b", f"{end}a{start}b": "b", "": "", None: None}
    assert values(spark, text.strip_boilerplate(F.col("x")), cases) == list(cases.values())


def test_audio(spark):
    pcm = values(spark, numeric.to_pcm16(F.col("x")), [([-1.5, -1.0, -0.9, 0.0, 0.5, 0.9, 1.0, 2.0],)], "x array<double>")[0]
    assert pcm == [-32767, -32767, -29490, 0, 16383, 29490, 32767, 32767]
    found = values(spark, numeric.cosine(F.col("a"), F.col("b")), [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]), ([1.0, 2.0, 2.0], [2.0, 1.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    assert found[:3] == pytest.approx([1, 0, 8 / 9]) and math.isnan(found[3])
    stats = values(spark, numeric.f0_stats(F.col("x")), [([0.0, 100.0, float("nan"), 150.0, float("inf")],), ([],)], "x array<double>")
    assert [tuple(s) for s in stats] == [(125.0, 50.0), (0.0, 0.0)]
    assert values(spark, numeric.mono(F.col("x")), [([[1.0, 3.0], [2.0, 4.0]],)], "x array<array<double>>")[0] == [2.0, 3.0]


def test_ids_and_suffixes(spark):
    assert values(spark, text.format_id(F.col("x")), [7, 123456], "x long") == ["00007", "123456"]
    rows = [("en-us-x-high", None), ("en-us-x", "low"), ("plain", None)]
    assert values(spark, text.quality_suffix(F.col("a"), F.col("b")), rows, "a string, b string") == ["high", "low", "medium"]
