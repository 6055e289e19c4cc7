"""Language identification, BPE, packing and quality rules against brute force, and in odd cases."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import bpe, bpe_reuse, langid, packing, quality_rules, queries
from quern.session import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (None, "word " * 60), (5, "x" * 300_000), (6, "word other " * 40_000), (7, "日本語 のテキスト " * 30), (8, "<|endoftext|> and <|endoftext|>"), (9, "\x00\x85  nbsp ' 's 'll")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


def odd(spark, extra=""):
    return spark.createDataFrame(ODD, "doc_id long, text string")


# ---- language identification --------------------------------------------------------------------


def test_language_held_out_accuracy(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op2_language_id(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r.held_out} == {r.doc_id for r in held}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_doesnt_learn_from_held_out_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    spoiled = rows.withColumn("lang", F.when(langid.held_out(), "zz").otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(rows).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(spoiled).collect()}


def test_ngrams_of_a_text_in_pieces(monkeypatch):
    """Counts don't depend on where a text is cut."""
    rng = np.random.default_rng(3)
    for k in range(200):
        text = "".join(rng.choice(list("abÉß\n ,1☃"), rng.integers(0, 40))) + "Σ" * (k % 2)
        monkeypatch.setattr(langid, "_PIECE", 1 << 20)
        whole = langid.ngram_counts(text)
        for size in (1, 2, 3, 7):
            monkeypatch.setattr(langid, "_PIECE", size)
            assert [x.tolist() for x in langid.ngram_counts(text)] == [x.tolist() for x in whole]


def test_language_brute_force(spark, sf_dir):
    """Profiles and distances by plain dictionaries."""
    rows = table(spark, sf_dir, "documents").collect()

    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        padded = " " + " ".join(words) + " "
        out = Counter(c for c in padded if c != " ")
        out.update(padded[i : i + 2] for i in range(len(padded) - 1) if padded[i : i + 2] != "  ")
        out.update(padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " ")
        return out

    def code(g):
        return sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))

    def top(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[: langid.PROFILE_SIZE]]

    total = defaultdict(Counter)
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            total[r.lang].update(grams(r.text))
    ranks = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in total.items()}
    got = {r.doc_id: r for r in langid.identify(table(spark, sf_dir, "documents")).collect()}
    for r in rows[:80]:
        own = top(grams(r.text))
        apart = {lang: sum(abs(rank[g] - i) if g in rank else langid.PROFILE_SIZE for i, g in enumerate(own)) for lang, rank in ranks.items()}
        best = min(sorted(apart), key=apart.get)
        assert got[r.doc_id].lang_pred == best
        assert got[r.doc_id].score == pytest.approx(1 - apart[best] / (langid.PROFILE_SIZE * len(own)))


def test_language_odd_cases(spark):
    labelled = odd(spark).withColumn("lang", F.when(F.col("doc_id") > 4, "aa"))
    profiles = langid.learn(labelled)
    clash = labelled.withColumn("score", F.lit("old")).withColumn("lang_pred", F.lit(1))
    out = langid.predict(clash, profiles)
    assert out.count() == len(ODD) and set(out.columns) == {"doc_id", "text", "lang", "lang_pred", "score"}
    found = {r.doc_id: r.lang_pred for r in out.collect()}
    assert [found[k] for k in (1, 2, 3, 6)] == ["und", "und", "und", "aa"]
    assert {r.lang_pred for r in langid.predict(odd(spark), langid.learn(labelled.limit(0))).collect()} == {"und"}
    assert langid.identify(labelled.limit(0)).count() == 0


# ---- BPE ----------------------------------------------------------------------------------------


def test_bpe_matches_the_library(spark, sf_dir, docs, library):
    got = {r.doc_id: r for r in queries.op4_bpe_reuse(spark, sf_dir).collect()}
    for d, text in docs:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[d].decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_odd_cases(spark, library):
    rows = odd(spark).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    out = bpe_reuse.decode(bpe_reuse.encode(rows)).collect()
    assert len(out) == len(ODD)
    by = {r.doc_id: r for r in out}
    for d, text in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(by[d].ids, "<u4").tolist() == ids
        assert by[d].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe_reuse.encode(rows.limit(0)).count() == 0


PARTS = ["it'", "s", "'re", " ", "  ", "\n", "\n\n", "\t", "word", " Word", "1", "23", " 456", "!!", "?", " ?", "é", "日本", " ", "'ll", "'", " 'd", "aa", " the", " of"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=0, max_size=600))
def test_chunk_joins_are_exact(parts):
    encoder = bpe.encoder()
    text = "".join(parts)
    assert bpe_reuse.encode_text(text, bpe_reuse.Cache(encoder)) == encoder.library.encode(text, add_special_tokens=False).ids


def test_shared_chunks_are_encoded_once():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(8000)]
    text = " ".join(words)
    cache = bpe_reuse.Cache(bpe.encoder())
    bpe_reuse.encode_text(text, cache)
    once = cache.encoded
    bpe_reuse.encode_text("another start " + text, cache)
    assert once > 40 and cache.encoded - once < 10


# ---- packing ------------------------------------------------------------------------------------


def check_pieces(rows, want, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for d, ids in want.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += capacity - at
    return padding / (capacity * max(1, len(by_sequence)))


def test_packing_is_whole_and_dense(spark, sf_dir, docs, library):
    out = packing.pack(table(spark, sf_dir, "documents")).collect()
    want = {d: [*library.encode(t or "", add_special_tokens=False).ids, packing.CLOSING_ID] for d, t in docs}
    assert check_pieces(out, want) < 0.03
    digests = {(r.doc_id, r.start): r for r in queries.op7_best_fit_packing(spark, sf_dir).collect()}
    assert all(digests[r.doc_id, r.start].ids_crc32 == zlib.crc32(r.ids) for r in out) and len(digests) == len(out)


def test_packing_odd_cases(spark, library):
    rows = spark.createDataFrame([x for x in ODD if x[0] not in (4, None)], "doc_id long, text string").withColumn("start", F.lit("clash"))
    want = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in ODD if d not in (4, None)}
    check_pieces(packing.pack(rows.coalesce(1)).collect(), want)
    assert packing.pack(odd(spark)).where("doc_id = 4").count() == 2
    assert packing.pack(rows.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing(lengths):
    window_of, offset_of, opened = packing.best_fit_decreasing(lengths, 64)
    room: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [r for r in room if r >= lengths[i]]
        w = window_of[i]
        if fits:
            assert room[w] == min(fits)
        else:
            assert w == len(room)
            room.append(64)
        assert offset_of[i] == 64 - room[w]
        room[w] -= lengths[i]
    assert opened == len(room)


# ---- quality rules ------------------------------------------------------------------------------


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    rules, size = quality_rules.Rules(), len(text.encode())
    zstd = zstandard.ZstdCompressor(level=3)
    bad = 0
    if size > rules.chunk_bytes:
        raw = text.encode()
        for i in range(0, size, rules.chunk_bytes):
            part = raw[i : i + rules.chunk_bytes]
            low, high = next((a, b) for top, a, b in rules.bands if len(part) <= top)
            bad += len(part) * (not low <= len(zstd.compress(part)) / len(part) <= high)
    kept = not failed
    if kept:
        low, high = next((a, b) for top, a, b in rules.bands if size <= top)
        kept = low <= len(zstd.compress(text.encode())) / size <= high and bad / size <= 0.5
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, kept


def test_quality_rules_match_brute_force(spark, sf_dir, docs):
    got = {r.doc_id: r for r in queries.op10_quality_rules(spark, sf_dir).collect()}
    for d, text in docs:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == expected(text)


def test_compression_rejects_noise_and_repetition(spark):
    rng = np.random.default_rng(1)
    noise = " ".join("".join(chr(33 + x) for x in rng.integers(0, 94, 7)) for _ in range(3000))
    sentence = [" ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(1, 9))) for _ in range(12)) for _ in range(200)]
    prose = ". ".join(sentence)
    looped = "".join(f"item {i} of the same long list of things that never ends or changes at all {i % 7}\n" for i in range(500))
    rows = spark.createDataFrame([(1, noise), (2, prose), (3, looped)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(rows).collect()}
    assert kept == {1: False, 2: True, 3: False}


def test_quality_rules_odd_cases(spark):
    rows = odd(spark).withColumn("kept", F.lit("clash"))
    out = quality_rules.apply_rules(rows)
    assert out.count() == len(ODD)
    for r in out.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == expected(r.text)
    assert quality_rules.apply_rules(rows.limit(0)).count() == 0
    assert quality_rules.keep_passing(rows).columns == rows.columns
