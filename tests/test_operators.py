"""Operators on small tables: boundaries, ties, nulls, idempotence, invariants."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.config import Curation, Progress, Quality
from quern.functions import numeric
from quern.operators import curation, evaluation, flow, models, progress, quality, selection
from quern.plans.curation import _phonemised
from quern.session import shared_path
from quern.sources import audio, files


def test_silent_runs(spark):
    def frames(*runs):
        return [level for n, level in runs for _ in range(n)]

    loud, quiet = -20.0, -60.0
    cases = [
        (frames((50, loud), (80, quiet), (50, loud)), [(8000, 20800)]),
        (frames((50, loud), (79, quiet), (50, loud)), []),
        (frames((100, quiet), (100, loud)), []),
        (frames((9, loud), (100, quiet), (50, loud)), []),
        (frames((10, loud), (100, quiet), (50, loud)), [(1600, 17600)]),
        (frames((60, loud), (90, quiet)), []),
        (frames((50, loud), (90, -40.0), (50, loud)), []),
        (frames((20, loud), (80, quiet), (20, loud), (90, quiet), (20, loud)), [(3200, 16000), (19200, 33600)]),
        ([], []),
    ]
    rows = spark.createDataFrame([(i, levels, len(levels) * 160) for i, (levels, _) in enumerate(cases)], "id int, db array<double>, n int")
    found = {}
    for r in quality.silent_runs(rows, "id", "db", "n").orderBy("id", "start").collect():
        found.setdefault(r.id, []).append((r.start, r.end))
    assert [found.get(i, []) for i in range(len(cases))] == [want for _, want in cases]


def test_statistics(spark):
    rows = spark.createDataFrame([(1, float(x)) for x in (1, 2, 3, 4, 10, 11)], "g int, x double")
    s = quality.consistency(rows, "x").first()
    assert (s.p10, s.p50, s.p90, s.sd) == pytest.approx((1.5, 3.5, 10.5, 3.890873))
    assert quality.upper_median(rows, "x", "g").first().upper_median == 4


def test_outliers(spark):
    rows = spark.createDataFrame([(i, 10.0, 1.0) for i in range(20)] + [(20, 100.0, 5.0)], "id int, a double, b double")
    out = [r for r in quality.outliers(rows, ("a", "b")).collect() if r.axis]
    assert [(r.id, r.axis) for r in out] == [(20, "a")]
    few = spark.createDataFrame([(i, 10.0) for i in range(8)] + [(8, 100.0), (9, math.nan)], "id int, a double").where("NOT isnan(a)")
    assert quality.outliers(few, ("a",)).where("axis IS NOT NULL").count() == 0


CLIP = "id long, sentence string, duration_s double, peak double, rms double, silences int, wer double, ecapa double, wavlm double, f0_mean double, centroid double, has_file boolean, load_error string, asr_error string"


def clip(i, **changes):
    base = dict(id=i, sentence="x" * 50, duration_s=4.0, peak=0.5, rms=0.1, silences=0, wer=0.0, ecapa=0.9, wavlm=0.9, f0_mean=100.0, centroid=1000.0, has_file=True, load_error=None, asr_error=None)
    return tuple((base | changes).values())


def test_ladder_boundaries(spark):
    q = Quality()
    cases = [
        ({}, "kept"), ({"has_file": False, "load_error": "x"}, "missing_file"), ({"load_error": "x"}, "load_error"), ({"duration_s": 2.0}, "kept"), ({"duration_s": 1.99}, "duration_ratio"), ({"duration_s": 6.01}, "duration_ratio"),
        ({"peak": 0.999}, "clipping"), ({"rms": 0.005}, "kept"), ({"rms": 0.0049}, "rms_low"), ({"silences": 1}, "internal_silence"), ({"asr_error": "x", "wer": 1.0}, "whisper_error"), ({"wer": 0.08}, "kept"), ({"wer": 0.081}, "wer"),
        ({"ecapa": 0.7}, "kept"), ({"ecapa": 0.69}, "speaker_verify"), ({"wavlm": math.nan}, "kept"),
    ]
    clips = spark.createDataFrame([clip(i, **c) for i, (c, _) in enumerate(cases)], CLIP)
    limits = spark.createDataFrame([(0.7, 0.7)], "ecapa_min double, wavlm_min double")
    out = quality.ladder(clips, limits, q)
    assert [r.outcome for r in out.orderBy("id").collect()] == [want for _, want in cases]
    assert out.count() == len(cases)
    files_ = spark.createDataFrame([(12,)], "id long")
    corpus = spark.createDataFrame([(12, "again")], "id long, sentence string")
    assert [r.sentence for r in quality.recover(out, corpus, files_).where("origin = '2_recovered'").collect()] == ["again"]
    assert quality.skipped(out, corpus, files_).first().n_skipped == 0
    assert quality.ladder(clips.limit(0), limits).count() == 0


def test_split_is_disjoint_exhaustive_and_stable(spark):
    clips = spark.createDataFrame([(f"{i:05d}",) for i in range(10)], "clip_id string")
    from quern.config import Evaluation

    parts = evaluation.train_eval_split(clips, Evaluation(eval_size=3))
    assert {r.clip_id for r in parts.where("split = 'eval'").collect()} == {"00007", "00009", "00002"}
    assert parts.count() == 10
    assert evaluation.train_eval_split(clips, Evaluation(eval_size=50)).where("split = 'train'").count() == 0
    assert evaluation.train_eval_split(clips.limit(0)).count() == 0


def test_eval_summary_and_winner(spark):
    rows = spark.createDataFrame([("a", 0.0, 0.9, 0.95), ("a", 0.5, 0.8, 0.9), ("a", 1.6, 0.7, 0.8)], "checkpoint string, wer double, ecapa double, wavlm double")
    s = evaluation.summary(rows).first()
    assert (s.composite_mean, s.composite_var, s.rank_score) == pytest.approx((0.710833, 0.02768472, 0.69699097), abs=1e-6)
    assert s.ambiguous
    ranks = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "checkpoint string, rank_score double")
    assert evaluation.winner(ranks).first().checkpoint == "a"
    assert evaluation.winner(ranks.limit(0)).count() == 0


def test_dedupe_keeps_the_first_as_written(spark):
    rows = spark.createDataFrame([(2, 0, "Hello there"), (1, 5, "HELLO there"), (1, 9, "hello there"), (3, 0, "Other")], "doc_id long, pos int, sentence string")
    assert sorted(tuple(r) for r in curation.dedupe_first(rows).collect()) == [(1, 5, "HELLO there"), (3, 0, "Other")]


def test_greedy_invariants(spark, sf_dir):
    rows = _phonemised(spark, sf_dir).cache()
    exact = selection.greedy_exact(rows, 60, seed=3)
    picked = [(r.doc_id, r.pos) for r in exact.collect()]
    assert len(picked) == len(set(picked)) == 60
    assert picked == [(r.doc_id, r.pos) for r in selection.greedy_exact(rows.repartition(3), 60, seed=3).collect()]

    def covered(df):
        return df.select(F.explode("bigrams")).distinct().count()

    assert covered(exact) > covered(rows.orderBy(F.rand(1)).limit(60))
    two_rounds = selection.greedy_distributed(rows, 60, groups=4)
    assert two_rounds.count() == 60 and covered(two_rounds) > covered(rows.orderBy(F.rand(1)).limit(60))
    assert selection.greedy_exact(rows.limit(5), 60).count() == 5


def test_greedy_moves_only_rows_that_steps_look_at(spark, sf_dir):
    """The task that picks gets the sampled rows alone, and picks as if it had all."""
    c, size = Curation(sample_size=8), 12
    rows = _phonemised(spark, sf_dir).cache()
    out = selection.greedy_exact(rows, size, seed=4, c=c)
    found = [(r.doc_id, r.pos) for r in out.collect()]
    pdf = rows.orderBy("doc_id", "pos").toPandas()
    assert found == [(pdf.doc_id[i], pdf.pos[i]) for i in selection.greedy(pdf, size, 4, c)]
    node = out._jdf.queryExecution().executedPlan().executedPlan()
    while not node.metrics().contains("shuffleRecordsWritten"):
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().head()
    assert node.metrics().get("shuffleRecordsWritten").get().value() <= size * 9 < len(pdf)


def test_greedy_null_and_repeated_ids(spark):
    """Rows that repeat id and position are candidates each for itself, those without an id too."""
    rows = spark.createDataFrame([(None if i % 40 == 0 else i // 60, i % 5, "short", "complex", i % 3, [f"b{i % 7}", f"b{i % 11}"]) for i in range(600)], selection.FIELDS)
    whole = Counter((*r[:5], tuple(r.bigrams)) for r in rows.collect())
    for size in (5, 30, 700):
        for out in (selection.greedy_exact(rows, size, c=Curation(sample_size=3)), selection.greedy_distributed(rows, size, groups=3)):
            picked = Counter((*r[:5], tuple(r.bigrams)) for r in out.collect())
            assert picked.total() == min(size, 600) and picked <= whole


def test_greedy_against_brute_force():
    """Each pick is the best of the step's sample, scored term by term."""
    rng, c = np.random.default_rng(5), Curation(sample_size=9)
    rows = [(i // 3, i % 3, ["short", "med", "long", None][i % 4], ["declarative", "complex"][i % 2], int(rng.integers(0, 3)), [f"b{k}" for k in rng.integers(0, 12, rng.integers(0, 6))]) for i in range(80)]
    pdf = pd.DataFrame(rows, columns=["doc_id", "pos", "category", "prosody", "n_accent", "bigrams"])

    def score(i, picked):
        covered = Counter(b for j in picked for b in rows[j][5])
        value = sum(1 / (1 + covered[b]) for b in rows[i][5]) + c.accent_weight * rows[i][4]
        for column, target in ((2, c.length_target), (3, c.prosody_target)):
            share = sum(rows[j][column] == rows[i][column] for j in picked) / (len(picked) or 1)
            value -= c.balance_weight * max(0.0, share - target.get(rows[i][column], 0))
        return value if rows[i][5] else -1e9

    left, picked, draw = list(range(80)), [], np.random.default_rng(2)
    while left and len(picked) < 60:
        at = draw.choice(len(left), min(9, len(left)), replace=False)
        best = max(at, key=lambda k: (round(score(left[k], picked), 9), -list(at).index(k)))
        picked.append(left[best])
        left[best] = left[-1]
        left.pop()
    assert selection.greedy(pdf, 60, 2, c) == picked
    assert selection.greedy(pdf.iloc[:0], 5, 2, c) == []


def test_quality_flow_of_wav_files(spark):
    """Each filter of the flow on clips made for it; models see only what passes the filters before."""
    rate = 16_000
    t = np.arange(2 * rate) / rate
    tone = 0.3 * np.sin(2 * np.pi * 200 * t)
    hole = np.concatenate([tone, np.zeros(rate), tone])
    clips = {
        "good": (tone, "x" * 25, rate), "good48": (0.3 * np.sin(2 * np.pi * 200 * np.arange(2 * 48_000) / 48_000), "x" * 25, 48_000), "short": (tone, "x" * 100, rate), "loud": (np.sign(tone), "x" * 25, rate),
        "quiet": (tone / 100, "x" * 25, rate), "hole": (hole, "x" * 50, rate), "deaf": (tone, "deaf" + "x" * 21, rate), "wrong": (tone * 0.5, "y" * 25, rate), "other": (tone * 0.9, "x" * 25, rate),
    }
    rows = []
    for name, (x, sentence, own) in clips.items():
        pcm = spark.createDataFrame([(x.tolist(),)], "x array<double>").select(audio.to_wav(numeric.to_pcm16(F.col("x")), own).alias("w")).first().w
        rows.append((name, sentence, bytes(pcm)))
    rows += [("none", "x" * 25, None), ("bad", "x" * 25, b"RIFF"), ("empty", None, b"")]
    files_ = spark.createDataFrame(rows, "id string, sentence string, content binary")

    def transcriber():
        def model(x):
            if not 1000 < len(x) < 33_000:
                raise AssertionError("a clip that an earlier filter drops")
            return "x" * 25

        return model

    one = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0])], "ecapa array<double>, wavlm array<double>")
    least = spark.createDataFrame([(0.9, 0.9)], "ecapa_min double, wavlm_min double")
    encoder = lambda: lambda x: [1.0, 5.0 if 0.26 < np.abs(x).max() < 0.28 else 0.0]
    found = flow.figures(files_, one, least, transcriber, encoder, encoder, lambda: lambda x: 1 / 0)
    out = {r.id: r for r in quality.ladder(found, least).collect()}
    want = {"good": "kept", "good48": "kept", "short": "duration_ratio", "loud": "clipping", "quiet": "rms_low", "hole": "internal_silence", "deaf": "wer", "wrong": "wer", "other": "speaker_verify", "none": "missing_file", "bad": "load_error", "empty": "load_error"}
    assert {k: r.outcome for k, r in out.items()} == want
    assert out["good48"].duration_s == pytest.approx(2) and out["good"].f0_mean == 0 and out["good"].centroid > 0 and out["hole"].silences == 1
    assert out["other"].centroid is None and out["wrong"].ecapa is None and out["hole"].transcript is None
    made = {r.id: bytes(r.wav) for r in flow.output_clips(quality.ladder(found, least), files_).collect()}
    assert set(made) == {"good", "good48"}
    for raw in made.values():
        parsed = audio.read_wav(raw)
        assert parsed[0] == 22_050 and parsed[3] == pytest.approx(2, abs=1e-3) and np.abs(parsed[4]).max() == pytest.approx(0.3, abs=0.02)


def test_cache_is_idempotent(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "sentence string")
    cache = spark.createDataFrame([("a", "A"), ("b", "")], "sentence string, phonemes string")
    filled, after = curation.merge_cache(rows, cache, F.upper("sentence"))
    assert {tuple(r) for r in filled.select("sentence", "phonemes", "hit").collect()} == {("a", "A", True), ("b", "B", False), ("c", "C", False)}
    again, same = curation.merge_cache(rows, after, F.lit("never"))
    assert again.where("NOT hit").count() == 0 and {tuple(r) for r in same.collect()} == {tuple(r) for r in after.collect()}


def test_resume_and_restarts(spark):
    lines = spark.createDataFrame([(" 1 ",), ("1",), ("x2",), ("",), ("3",), (None,)], "line string")
    done = progress.done_ids(lines)
    assert sorted(r.id for r in done.collect()) == [1, 3]
    corpus = spark.range(5)
    left = progress.todo(corpus, done)
    assert sorted(r.id for r in left.collect()) == [0, 2, 4]
    assert progress.todo(left, done).count() == 3
    ticks = spark.createDataFrame([("u", i, s) for i, s in enumerate([True, False, False, False, False, False, True, False])], "unit string, ts int, active boolean")
    assert [r.ts for r in progress.restarts(ticks, "unit", "ts", "active").orderBy("ts").collect()] == [2, 4]
    assert progress.restarts(ticks, "unit", "ts", "active", Progress(most_restarts=1)).count() == 1


def test_retries_become_rows(spark):
    def call(v):
        if v == "bad":
            raise ValueError("no")
        return v.upper()

    rows = spark.createDataFrame([(1, "ok"), (2, "bad")], "id long, v string")
    out = {r.id: r for r in progress.with_retries(rows, call, "id", "v", lanes=2, wait=lambda s: None).collect()}
    assert (out[1].ok, out[1].result, out[1].attempts) == (True, "OK", 1)
    assert (out[2].ok, out[2].attempts, out[2].error) == (False, 5, "ValueError: no")


def test_models_fall_back_and_report(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "sentence string")
    short = models.phonemize(rows.coalesce(1), lambda: lambda batch: [batch[0].upper()])
    assert sorted(tuple(r) for r in short.collect()) == [("a", "A"), ("b", "B")]
    clips = spark.createDataFrame([(1, [1.0]), (2, [])], "id long, x array<double>")
    out = {r.id: r for r in models.apply_model(clips, lambda: lambda x: str(x[0]), "id", "x", "string").collect()}
    assert out[1].value == "1.0" and out[2].error.startswith("IndexError")


def test_pipe_files_keep_quotes(spark):
    rows = spark.createDataFrame([("00001", 'He said "go" | now, ok'), ("00002", '"Yes!" she said.'), ("00003", "plain")], files.PAIR_SCHEMA)
    path = shared_path(spark, "t")
    files.sink_psv(rows, path, header=True)
    assert sorted(files.scan_psv(spark, path, files.PAIR_SCHEMA).collect()) == sorted(rows.collect())


def test_text_files(spark, tmp_path):
    (tmp_path / "b.txt").write_bytes("zwei\n".encode())
    (tmp_path / "a.txt").write_bytes(b"on\xffe caf\xc3\xa9\n\n  two \n")
    assert [r.text for r in files.scan_text_docs(spark, str(tmp_path)).orderBy("path").collect()] == ["one café\n\n  two \n", "zwei\n"]
    assert [tuple(r) for r in files.scan_lines(spark, str(tmp_path / "b.txt")).collect()] == [(0, "zwei")]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.txt").write_bytes(b"a0\r\n\n a1 \na2")
    (tmp_path / "lines" / "b.txt").write_text("b0\n\nb1\n")
    assert sorted(tuple(r) for r in files.scan_lines(spark, str(tmp_path / "lines")).collect()) == list(enumerate(["a0", "a1", "a2", "b0", "b1"]))
    (tmp_path / "c.tsv").write_text("k\tv\tmore\nno tab\nk\tlast\n")
    assert [tuple(r) for r in files.scan_tsv_kv(spark, str(tmp_path / "c.tsv")).collect()] == [("k", "last")]
    listed = files.list_files(spark, str(tmp_path), "*.txt")
    assert listed.count() == 2
    files.append_once(spark.range(3), str(tmp_path / "log"))
    files.append_once(spark.range(4), str(tmp_path / "log"))
    assert files.read_once(spark, str(tmp_path / "log")).count() == 4
    files.sink_manifest({"total": F.col("n")}, spark.range(1).select(F.lit(5).alias("n")), str(tmp_path / "m"))
    assert files.scan_json_doc(spark, str(tmp_path / "m")).first().total == 5
    assert "| 5 |" in files.markdown_report("t", {"counts": spark.range(1).select(F.lit(5).alias("n"))})


def test_checkpoints(spark):
    rows = [("a-step=4000.ckpt", 1), ("a-step=39999.ckpt", 3), ("junk.ckpt", 2)]
    found = spark.createDataFrame(rows, "path string, modified int")
    assert not evaluation.milestone_reached(found, 40_000).first().reached
    assert evaluation.milestone_reached(found, 39_999).first().reached
    assert evaluation.resume_from(found, "base").first().resume_from == "a-step=39999.ckpt"
    assert evaluation.resume_from(found.limit(0), "base").first().resume_from == "base"
    assert [r.modified for r in evaluation.latest(found, 2).collect()] == [2, 3]


def test_shares_keep_empty_classes(spark):
    rows = spark.createDataFrame([("short",)] * 3 + [("med",)], "category string")
    out = {r["class"]: (r.n, r.share) for r in curation.shares(rows, "category", Curation().length_target).collect()}
    assert out == {"short": (3, 0.75), "med": (1, 0.25), "long": (0, 0.0)}


def test_union_prefers_the_first(spark):
    a, b = spark.createDataFrame([(1, "a")], "id int, v string"), spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string")
    assert sorted((r.id, r.v) for r in evaluation.deduped_union(a, b, "id").collect()) == [(1, "a"), (2, "c")]


def test_wav_files(spark):
    import io
    import wave

    def made(width, channels, data):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels), w.setsampwidth(width), w.setframerate(8000)
            w.writeframes(data)
        return out.getvalue()

    stereo = made(2, 2, np.array([16384, 0, -32768, 32767], "<i2").tobytes())
    rows = spark.createDataFrame([(1, stereo), (2, b"junk"), (3, None), (4, made(1, 1, bytes([0, 128, 255]))), (5, made(3, 1, b"\x00\x00\x40\xff\xff\xff"))], "id int, content binary")
    out = {r.id: r for r in audio.scan_audio(rows, "id").collect()}
    assert (out[1].rate, out[1].channels, out[1].frames, out[1].duration_s) == (8000, 2, 2, 2 / 8000)
    assert out[1].samples == pytest.approx([0.25, -1 / 65536], abs=1e-6)
    assert out[2].rate is None and out[3].samples is None and out[2].error.startswith("EOFError") and out[3].error and out[1].error is None
    half = {r.id: r for r in audio.scan_audio(rows, "id", target=4000).collect()}
    assert len(half[4].samples) == 2 and half[2].samples is None and half[1].rate == 8000
    assert out[4].samples == pytest.approx([-1, 0, 127 / 128]) and out[5].samples == pytest.approx([0.5, -1 / 2**23])


def test_signal_functions():
    t = np.arange(16_000) / 16_000
    tone = np.sin(2 * np.pi * 1000 * t)
    assert audio.spectral_centroid(tone, 16_000) == pytest.approx(1000, rel=0.05)
    assert audio.spectral_centroid(np.zeros(4000), 16_000) == 0
    down = audio.resample(tone, 16_000, 22_050)
    assert len(down) == 22_050
    assert down[200:-200] == pytest.approx(np.sin(2 * np.pi * 1000 * np.arange(22_050) / 22_050)[200:-200], abs=2e-3)
    assert (audio.resample(tone, 16_000, 16_000) == tone).all()


def test_spectral_centroids_of_the_table(spark, sf_dir):
    from quern.plans import catalogue
    from quern.session import table

    rows = {r.vec_id: r.embedding for r in table(spark, sf_dir, "embeddings").collect()}
    for r in catalogue.QUERIES["spectral_centroid_mean"](spark, sf_dir).limit(20).collect():
        x = np.pad(np.array(rows[r.vec_id], float), 16)
        want = []
        for s in range(0, len(x) - 31, 8):
            k = np.arange(32)
            w = x[s : s + 32] * (0.5 - 0.5 * np.cos(2 * np.pi * k / 32))
            mags = np.array([abs((w * np.exp(-2j * np.pi * f * k / 32)).sum()) for f in range(17)])
            want.append((mags * np.arange(17) * 500).sum() / mags.sum())
        assert r.centroid == pytest.approx(np.mean(want))


def test_gaps_do_not_depend_on_the_zone(spark):
    """Times without a zone across a change of the clock, in a zone that has it."""
    rows = spark.sql("SELECT 'w' AS worker, t FROM VALUES (TIMESTAMP_NTZ '2024-03-10 01:30:00.25'), (TIMESTAMP_NTZ '2024-03-10 03:30:00.5') AS v(t)")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert progress.throughput(rows, "t", 10).first().seconds == 7200.25
            assert progress.stalls(rows, "worker", "t", 90).count() == 1
            now = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 05:00:00' AS now")
            assert progress.open_stalls(rows, "worker", "t", now, 80).count() == 1 and progress.open_stalls(rows, "worker", "t", now, 100).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_file_is_missing(spark):
    clip = spark.sql("SELECT 1 AS id, CAST(NULL AS BOOLEAN) AS has_file, CAST(NULL AS STRING) AS load_error, 0.5 AS peak, 0.1 AS rms, 0 AS silences, 'ten chars!' AS sentence, 0.7 AS duration_s")
    assert clip.select(quality.first_stage().alias("why")).first().why == "missing_file"


def test_percentiles_by_rank(spark):
    rng = random.Random(4)
    inf, nan = float("inf"), float("nan")
    groups = {
        "even": [rng.gauss(0, 50) for _ in range(400)],
        "odd": [float(rng.randrange(-5, 5)) for _ in range(301)],
        "close": [1e6 + i / 1e6 for i in range(99)],
        "ends": [-inf, -1.0, 0.0, 2.5, inf],
        "nan": [nan, 3.0, 1.0, 2.0],
        "one": [7.0],
        None: [4.0, 5.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("even", None), ("none", None)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "g string, v double")
    native = {r.g: (r.a, r.b, r.c) for r in df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(a) for p, a in ((0.1, "a"), (0.5, "b"), (0.9, "c"))]).collect()}
    got = {r.g: (r.p10, r.p50, r.p90) for r in quality.consistency(df, "v", ["g"]).collect()}
    assert repr_near(got) == repr_near(native) and got["none"] == (None, None, None)
    upper = {r.g: r.upper_median for r in quality.upper_median(df, "v", "g").collect()}
    assert upper == {g: sorted(values, key=lambda x: (x != x, x))[len(values) // 2] for g, values in groups.items()}
    assert quality.consistency(df.limit(0), "v").collect()[0].p50 is None
    assert quality.consistency(df.where("g = 'odd'"), "v").collect()[0].p50 == native["odd"][1]


def repr_near(found):
    return {g: tuple(None if x is None else f"{x:.9g}" for x in xs) for g, xs in found.items()}
