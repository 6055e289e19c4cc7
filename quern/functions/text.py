"""Text scalars as Spark columns.

All patterns are Unicode-aware where the semantics are (``(?U)``). Each function maps null to null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: spoken forms, bucket bounds and markers
SMALL_NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
ABBREVIATIONS = [("Mr", "Mister"), ("Mrs", "Misses"), ("Dr", "Doctor"), ("St", "Saint"), ("No", "Number"), ("vs", "versus")]
LENGTH_BUCKETS = [("short", 4, 8), ("med", 9, 14), ("long", 15, 20)]
ACCENT_MARKERS = ["r", "ɹ", "l", "ɫ", "θ", "ð", "æ", "ɪ", "ʊ", "ɑ"]
START_MARKER = r"(?is)\*\*\*\s*START OF (?:THIS|THE) PROJECT GUTENBERG.*?\*\*\*"
END_MARKER = r"(?is)\*\*\*\s*END OF (?:THIS|THE) PROJECT GUTENBERG.*?\*\*\*"
QUALITIES = ["x_low", "low", "medium", "high"]


def squeeze(s: Column) -> Column:
    """Whitespace runs become one blank, and none is left at the ends."""
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), "^ | $", "")


def strip_boilerplate(s: Column) -> Column:
    """The text between a start and an end marker; either can be missing.

    An end marker that stands before the start marker is ignored: cutting from the tail by a
    negative length, as naive slicing would, loses text that belongs to the body.
    """
    start, end = F.regexp_instr(s, F.lit(START_MARKER)), F.regexp_instr(s, F.lit(END_MARKER))
    begin = F.when(start > 0, start + F.length(F.regexp_substr(s, F.lit(START_MARKER)))).otherwise(1)
    stop = F.when(end >= begin, end).otherwise(F.length(s) + 1)
    return F.substring(s, begin, stop - begin)


def sentence_split(s: Column) -> Column:
    """An array of sentences: cut after . ! ? before a capital or a quote."""
    flat = F.replace(F.regexp_replace(s, r"(?U)\s+", " "), F.lit("—"), F.lit(" — "))
    parts = F.split(flat, r"(?<=[.!?])(?U)\s+(?=[A-Z\"'])")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")), lambda p: p != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_all(sentences: Column) -> Column:
    """``normalize`` of every element of an array, in stages that each read the one before once."""

    def spelt(s: Column) -> Column:
        full = s
        for short, long in ABBREVIATIONS:
            full = F.regexp_replace(full, rf"(?U)\b{short}\.", long)
        return F.when(s.contains("."), full).otherwise(s)

    def numbered(s: Column) -> Column:
        full = s
        for number in range(len(SMALL_NUMBERS) - 1, -1, -1):
            full = F.regexp_replace(full, rf"(?U)\b{number}\b", SMALL_NUMBERS[number])
        return F.when(s.rlike("[0-9]"), full).otherwise(s)

    plain = F.transform(sentences, lambda s: F.replace(F.regexp_replace(F.regexp_replace(s, "[“”]", '"'), "[‘’]", "'"), F.lit("--"), F.lit(" — ")))
    return F.transform(F.transform(F.transform(plain, spelt), numbered), squeeze)


def normalize(s: Column) -> Column:
    """Straight quotes, spaced dashes, six abbreviations and the numbers to twenty spelt out, blanks squeezed."""
    return F.get(normalize_all(F.array(s)), F.lit(0))


def normalize_wer(s: Column) -> Column:
    """Lower case, letters and apostrophes only, for token error rates."""
    s = F.replace(F.lower(s), F.lit("&"), F.lit(" and "))
    return squeeze(F.regexp_replace(F.regexp_replace(s, "[-/]", " "), "[^a-z' ]", " "))


def words(s: Column) -> Column:
    """The tokens between whitespace."""
    return F.filter(F.split(s, r"(?U)\s+"), lambda w: w != "")


def word_count(s: Column) -> Column:
    return F.size(words(s))


def length_bucket(n: Column) -> Column:
    """short, med or long by the number of words; null outside."""
    found = F.lit(None).cast("string")
    for name, low, high in LENGTH_BUCKETS:
        found = F.when(n.between(low, high), name).otherwise(found)
    return found


def prosody(s: Column) -> Column:
    t = F.regexp_replace(s, r"(?U)^\s+|\s+$", "")
    return F.when(t.endswith("?"), "interrogative").when(t.endswith("!"), "exclamatory").when(t.rlike("[;,—:]"), "complex").when(t.isNotNull(), "declarative")


def phoneme_tokens(s: Column) -> Column:
    """Tokens between blanks and underscores, without leading stress marks."""
    cleaned = F.transform(F.split(s, r"(?U)[\s_]+"), lambda t: F.regexp_replace(t, "^[ˈˌ]+", ""))
    return F.filter(cleaned, lambda t: t != "")


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens, joined by a blank; none for fewer than two."""
    def pairs(t: Column) -> Column:
        joined = F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), lambda x, i: F.concat(F.get(t, i), F.lit(" "), x))
        return F.when(F.size(t) >= 2, joined).when(t.isNotNull(), F.array().cast("array<string>"))

    return let(tokens, pairs)


def has_marker(token: Column, markers: list[str] = ACCENT_MARKERS) -> Column:
    found = F.lit(False)
    for m in markers:
        found = found | token.contains(m)
    return found


def accent_markers(tokens: Column) -> Column:
    """How many tokens contain a marker."""
    return F.size(F.filter(tokens, lambda t: has_marker(t)))


def letter_phonemes(s: Column) -> Column:
    """A stand-in for a phonemiser: the letters of each word, joined by underscores."""
    return F.array_join(F.transform(words(F.lower(s)), lambda w: F.array_join(F.split(w, ""), "_")), " ")


def format_id(i: Column, width: int = 5) -> Column:
    """Zero-padded, and longer numbers whole."""
    return F.when(F.length(i.cast("string")) >= width, i.cast("string")).otherwise(F.lpad(i.cast("string"), width, "0"))


def quality_suffix(name: Column, known: Column) -> Column:
    """The name's last dash-separated part if it is a quality, else the known one, else medium."""
    last = F.substring_index(name, "-", -1)
    return F.when(last.isin(QUALITIES), last).otherwise(F.coalesce(known, F.lit("medium")))


#: Rules of acceptance: label and the condition under which a normalised sentence is rejected.
def rejections(s: Column) -> list[tuple[str, Column]]:
    n = word_count(s)
    return [
        ("a_words", ~n.between(4, 20)),
        ("f_non_ascii", s.rlike(r"[^\x00-\x7F]")),
        ("b_url", s.rlike(r"https?://|www\.")),
        ("c_digit", s.rlike(r"(?U)\d")),
        ("d_capitals", s.rlike(r"(?U)\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b")),
        ("e_repeated", F.lower(s).rlike(r"(?U)\b(\w+)\s+\1\b")),
        ("g_heading", s.rlike(r"(?iU)^(CHAPTER|VOLUME|BOOK|PART|ACT|SCENE)\b")),
        ("h_quotes", F.length(s) - F.length(F.replace(s, F.lit('"'), F.lit(""))) >= 4),
    ]


def reject_reason(s: Column) -> Column:
    """The first rule that rejects a sentence, or null."""
    reason = F.lit(None).cast("string")
    for label, broken in reversed(rejections(s)):
        reason = F.when(broken, label).otherwise(reason)
    return reason
