"""Similarity join, passages, language model and nearest neighbours against brute force, and in odd cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import backoff_lm, count_exchange, hashing_index, jaccard_join, passage_dedup, queries, wordhash
from quern.llm.components import components
from quern.session import table

LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def words_of(text):
    return (text or "").translate(LOWER).encode().split()


def shingles(words, n):
    return frozenset(zip(*[words[i:] for i in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


def find_classes(docs, n, percent):
    """(id, size, smallest linked id, number of links) per row, by comparing all pairs that share an n-gram."""
    sets = [shingles(words_of(t), n) for _, t in docs]
    parent = {d: d for d, _ in docs}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index, links = defaultdict(set), Counter()
    for i, s in enumerate(sets):
        for j in {j for g in s for j in index[g]}:
            overlap = len(s & sets[j])
            if 100 * overlap >= percent * (len(s) + len(sets[j]) - overlap):
                a, b = sorted((top(docs[i][0]), top(docs[j][0])))
                parent[b] = a
                links.update((i, j))
        for g in s:
            index[g].add(i)
    return sorted((d, len(s), top(d), links[i]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True)))


def test_jaccard_join_matches_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in queries.op1_ngram_jaccard_join(spark, sf_dir).collect())
    assert got == find_classes(docs, 4, 85)


def family(seed, copies, edits, words=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block_bytes", [9000, 2_000_000])
def test_near_copies_in_blocks(spark, block_bytes, monkeypatch):
    """Near copies of one size, and of a chain of sizes that spans several bands; each counted once."""
    rng = random.Random(6)
    chain = [f"c{rng.randrange(10**6)}" for _ in range(160)]
    texts = family(1, 60, 6) + family(2, 40, 3) + family(3, 1, 1) * 20 + [" ".join(chain[: 60 + 5 * i]) for i in range(20)]
    docs = list(enumerate(random.Random(5).sample(texts, len(texts))))
    monkeypatch.setattr(jaccard_join.links, "__defaults__", (block_bytes,))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.classes(rows, 4, 85).collect())
    assert got == find_classes(docs, 4, 85)


def test_blocks_of_one_family_spread_over_tasks(spark):
    docs = spark.createDataFrame(list(enumerate(family(11, 60, 3))), "doc_id long, text string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        signed = jaccard_join.signatures(docs, "doc_id", "text", 4, 85).where("fingerprint IS NOT NULL").withColumn("copies", F.lit(1).cast("long"))
        families = components(jaccard_join._candidates(signed, 85))
        found = jaccard_join.links(signed, families, 85, 9000)
        tasks = found.groupBy(F.spark_partition_id()).count().count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert tasks > 1


def test_jaccard_threshold_is_exact(spark):
    """17 shared of 20 in all links at 85 percent, 16 of 20 don't."""
    a = " ".join(f"a{i}" for i in range(21))
    at = " ".join([f"a{i}" for i in range(20)] + ["b"])
    docs = [(1, a), (2, at)]
    s, t = (shingles(words_of(x), 4) for _, x in docs)
    assert len(s & t) / len(s | t) > 0.85
    for percent in (89, 90):
        rows = spark.createDataFrame(docs, "doc_id long, text string")
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.classes(rows, 4, percent).collect())
        assert got == find_classes(docs, 4, percent)


def test_jaccard_odd_cases(spark):
    long = " ".join(f"w{i}" for i in range(50_000))
    docs = [(9, None), (8, ""), (7, " \n"), (6, "one two"), (5, "ONE  two"), (4, long), (3, long + " tail"), (2, "same text here now ok"), (2, "same text here now ok"), (1, "a b c d")]
    rows = spark.createDataFrame([*docs, (None, "a b c d")], "doc_id long, text string").withColumn("component_id", F.lit("clash")).withColumn("key", F.lit(0))
    out = jaccard_join.classes(rows, 4, 85).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in out)
    assert got == Counter({(9, 0, 9, 0): 1, (8, 0, 8, 0): 1, (7, 0, 7, 0): 1, (6, 1, 5, 1): 1, (5, 1, 5, 1): 1, (4, 49_997, 3, 1): 1, (3, 49_998, 3, 1): 1, (2, 2, 2, 1): 2, (1, 1, 1, 0): 1, (None, 1, None, 0): 1})
    kept = jaccard_join.keep_first(rows, 4, 85)
    assert kept.columns == rows.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 8, 9]
    assert jaccard_join.classes(rows.limit(0)).count() == 0


def test_an_id_with_several_texts_joins_their_classes(spark):
    docs = [(5, "a b c d e f"), (9, "a b c d e f"), (9, "u v w x y z"), (7, "u v w x y z"), (8, "other words than those of all")]
    out = {(r.doc_id, r.component_id) for r in jaccard_join.classes(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85).collect()}
    assert out == {(5, 5), (9, 5), (7, 5), (8, 8)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("n_buckets", [1, 4, 5, 40])
def test_counts_by_hops(spark, n_buckets):
    """Counts of keys that are asked through one hop or several, in blocks of four, against a sum."""
    rng = np.random.default_rng(n_buckets)
    keys = {b: np.unique(np.concatenate((rng.integers(0, 2**63, 50, dtype=np.uint64) << np.uint64(1), rng.integers(0, 60, 30, dtype=np.uint64) << np.uint64(58)))) for b in range(n_buckets) if b != 2}
    want = Counter(k for ks in keys.values() for k in ks.tolist())
    buckets = spark.createDataFrame([(b, b) for b in keys], "bucket int, x int")
    found = count_exchange.exchange(buckets, n_buckets, lambda t: (keys[t.column("bucket")[0].as_py()], np.full(len(keys[t.column("bucket")[0].as_py()]), 2)), fan_bits=2)
    replies = defaultdict(list)
    for r in found.toArrow().to_pylist():
        replies[r["bucket"]].append(r)
    assert set(replies) == set(keys)
    for b, rows in replies.items():
        assert count_exchange.received(pa.Table.from_pylist(rows), len(keys[b]))[0].tolist() == [2 * want[k] for k in keys[b].tolist()]


@pytest.mark.parametrize("n_buckets", [1, 10, 1000, 100_000, 20_000_000])
def test_requests_do_not_grow_with_the_square(n_buckets):
    """Each bucket, and each sum of its fan of them, asks at most a fan of blocks; blocks suffice for the buckets."""
    hops = count_exchange.hops(n_buckets)
    assert all(2**h <= count_exchange.FAN for h in hops) and n_buckets <= 2 ** sum(hops) < max(2, 2 * n_buckets)
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, 100_000, dtype=np.uint64) << np.uint64(1))
    asked = list(count_exchange._split(keys, np.ones((1, len(keys)), np.int64), 0, 0, hops[0], 64))
    assert len(asked) == 2 ** hops[0] and len(asked) <= count_exchange.FAN


def test_words_of_structure_have_hashes_of_their_own():
    """Two words that a sum of powers modulo 2**64 makes equal, and words that differ in one place only."""
    bits = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    texts = [bits, bits.translate(str.maketrans("ab", "ba")), *("x" * i + "y" + "x" * (40 - i) for i in range(41)), "a", "a\0", "a" * 8, "a" * 8 + "\0", "a" * 16, "a" * 17]
    assert len(set(wordhash.word_hashes([t.encode() for t in texts])[0].tolist())) == len(texts)


def test_long_different_words_do_not_link(spark):
    bits = "".join("ab"[i.bit_count() & 1] for i in range(1024))
    docs = spark.createDataFrame([(1, bits), (2, bits.translate(str.maketrans("ab", "ba")))], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.classes(docs, 4, 85).collect()} == {(1, 1), (2, 2)}


def test_word_hashes_across_pieces(monkeypatch):
    texts = [b"one two  three\n", None, b"", b"x " * 5000 + b"END", b"Two ONE"]
    whole, owners = wordhash.word_hashes(texts)
    monkeypatch.setattr(wordhash, "PIECE_BYTES", 64)
    again, same = wordhash.word_hashes(texts)
    assert (whole == again).all() and (owners == same).all()
    by_word = dict(zip([w for t in texts if t for w in t.lower().split()], whole.tolist(), strict=True))
    assert whole[-2:].tolist() == [by_word[b"two"], by_word[b"one"]]
    assert np.bincount(owners, minlength=5).tolist() == [3, 0, 0, 5001, 2]


# ---- passages -----------------------------------------------------------------------------------


def sentence(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n)]


def test_planted_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(3)
    exact, fuzzy = sentence(rng, 55), sentence(rng, 90)
    docs, hit = {}, {}
    for d in range(60):
        own = sentence(rng, rng.randrange(80, 300))
        cut = rng.randrange(len(own))
        if d % 4 == 1:
            docs[d] = own[:cut] + exact + own[cut:]
            hit[d] = (cut, cut + 55)
        elif d % 4 == 3:
            w = list(fuzzy)
            for _ in range(3):
                w[rng.randrange(30, 60)] = f"z{rng.randrange(10**5)}"
            docs[d] = own[:cut] + w + own[cut:]
            hit[d] = (cut, cut + 90)
        else:
            docs[d] = own
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    out = {r.doc_id: r for r in passage_dedup.find(rows).collect()}
    first = {min(d for d in hit if d % 4 == k) for k in (1, 3)}
    for d, r in out.items():
        if d in hit and d not in first:
            spans = [(p.start, p.end) for p in r.passages]
            assert spans and min(a for a, _ in spans) == hit[d][0] and max(b for _, b in spans) == hit[d][1]
            assert r.cleaned.split() == docs[d][: hit[d][0]] + docs[d][hit[d][1] :]
        else:
            assert r.passages == [] and r.cleaned == " ".join(docs[d])


def test_exact_repeats_of_the_table(spark, sf_dir):
    """Words in sequences of fifty that an earlier document holds: nearly all are found, and no clean document is touched."""
    docs = {r.doc_id: words_of(r.text) for r in table(spark, sf_dir, "documents").collect()}
    first, repeated = {}, defaultdict(set)
    for d in sorted(docs):
        w = docs[d]
        for i in range(len(w) - 49):
            if first.setdefault(tuple(w[i : i + 50]), d) != d:
                repeated[d].update(range(i, i + 50))
    found = defaultdict(set)
    for r in queries.op8_passage_dedup(spark, sf_dir).collect():
        found[r.doc_id].update(range(r.start_word, r.end_word))
        assert r.source_doc_id < r.doc_id
    varied = {d for d in repeated if len({docs[d][i] for i in repeated[d]}) > 20}
    assert varied <= set(found)
    total = sum(len(repeated[d]) for d in varied)
    assert sum(len(repeated[d] - found[d]) for d in varied) < 0.02 * total


def test_hot_passages_are_cut_in_all_but_the_first(spark):
    """One passage in many documents, another in more and half of the first in still more: each but the first holder loses it."""
    rng = random.Random(4)
    passage, other = sentence(rng, 60), sentence(rng, 80)
    docs = {d: sentence(rng, 20) + passage + sentence(rng, 20) for d in range(30)}
    docs |= {100 + d: sentence(rng, 25) + other + passage[:30] + sentence(rng, 20) for d in range(50)}
    docs |= {200 + d: sentence(rng, 25) + passage[30:] + sentence(rng, 20) for d in range(70)}
    out = {r.doc_id: r.passages for r in passage_dedup.find(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")).collect()}
    assert all(out[d] == [] for d in (0, 100, *range(200, 270)))
    assert all({(p.source, p.start, p.end) for p in out[d]} == {(0, 20, 80)} for d in range(1, 30))
    assert all(25 in {p.start for p in out[d]} and 135 in {p.end for p in out[d]} for d in range(101, 150))


def common_words(a, b):
    """The most words that an alignment can bring together."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("hot", [False, True])
def test_recall_of_edited_passages(spark, hot):
    """100 words of which up to 15 are replaced, dropped or added at random places: nine in ten are found at every number of edits.

    hot: other documents before the source hold parts of the passage. What is reported agrees as it says, by an
    alignment of the whole.
    """
    rng = random.Random(21)
    docs, want = {}, {}
    for edits in range(0, 16, 3):
        for _ in range(40):
            base = len(docs) + 1
            passage = sentence(rng, 100)
            if hot:
                docs[base], docs[base + 1] = sentence(rng, 40) + passage[:30], passage[60:90] + sentence(rng, 40)
                base += 2
            copy = list(passage)
            for i in sorted(rng.sample(range(100), edits), reverse=True):
                copy[i : i + 1] = rng.choice(([f"z{rng.randrange(10**6)}"], [f"z{rng.randrange(10**6)}"], [], [copy[i], f"z{rng.randrange(10**6)}"]))
            docs[base] = sentence(rng, 50) + passage + sentence(rng, 50)
            docs[base + 1] = sentence(rng, 30) + copy + sentence(rng, 60)
            want[base + 1] = base, 30, 30 + len(copy), edits
    out = {r.doc_id: r.passages for r in passage_dedup.find(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")).collect()}
    hits = Counter()
    for d, (source, a, b, edits) in want.items():
        held = {k for p in out[d] if p.source == source for k in range(p.start, p.end)}
        hits[edits] += len(held & set(range(a, b))) >= 0.8 * (b - a)
        for p in out[d]:
            mine, other = docs[d][p.start : p.end], docs[p.source][p.source_start : p.source_end]
            assert common_words(mine, other) >= p.agreeing >= 0.8 * max(len(mine), len(other)) and len(mine) >= 50
    print("share found by edits in 100 words", {e: n / 40 for e, n in hits.items()})
    assert all(hits[e] >= (0.9 if not hot or e < 10 else 0.7) * 40 for e in range(0, 16, 3))
    assert all(not p for d, p in out.items() if d not in want)


def test_passages_odd_cases(spark):
    rng = random.Random(5)
    passage = " ".join(sentence(rng, 70))
    long = " ".join(sentence(rng, 30_000))
    docs = [(1, passage), (2, passage), (2, passage), (3, None), (4, ""), (5, "short"), (None, passage), (6, long), (7, long + " " + passage), (8, passage + " " + passage)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("cleaned", F.lit(1)).withColumn("key", F.lit(2)).withColumn("bucket", F.lit(3))
    out = passage_dedup.find(rows)
    assert set(out.columns) == {"doc_id", "text", "key", "bucket", "cleaned", "passages"} and out.count() == len(docs)
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r)
        assert r.key == 2 and r.bucket == 3
    assert [r.cleaned for r in got[1]] == [passage] and [r.cleaned for r in got[2]] == ["", ""]
    assert got[3][0].cleaned is None and got[4][0].cleaned == "" and got[None][0].cleaned == passage
    assert got[6][0].cleaned == long and got[7][0].cleaned == "" and got[8][0].cleaned == ""
    assert passage_dedup.find(rows.limit(0)).count() == 0


def test_chain_takes_the_collinear_matches():
    place, source = [0, 6, 12, 18, 24], [100, 106, 40, 118, 124]
    best = passage_dedup.chain(place, source)[0]
    assert best == [0, 1, 3, 4]


def test_passages_meet_their_texts_no_more_than_needed(spark):
    """The buckets' texts, the dear part, are hashed with the windows' requests, for all chains at once, for fetching and for alignment."""
    plan = passage_dedup.find(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("FlatMapCoGroupsInArrow") == 4


def test_least_of_windows():
    h = np.random.default_rng(4).integers(0, 20, 300).astype(np.uint64)
    assert passage_dedup._least(h).tolist() == [i + int(np.argmin(h[i : i + passage_dedup.WINDOW])) for i in range(300 - passage_dedup.WINDOW + 1)]


def test_chain_takes_the_best_predecessor_within_reach():
    """Scores against all pairs; the places of far runs, repeats and crossings are mixed."""
    rng = random.Random(7)
    reach = passage_dedup.MOST_GAP + passage_dedup.K
    for _ in range(200):
        pairs = sorted({(rng.randrange(rng.choice((40, 400))), rng.randrange(rng.choice((40, 400)))) for _ in range(rng.randrange(1, 60))})
        score = []
        for i, (p, s) in enumerate(pairs):
            score.append(passage_dedup.K + max([0, *(score[j] - passage_dedup.GAP_COST * (p - q + s - t) for j, (q, t) in enumerate(pairs[:i]) if 0 < p - q <= reach and 0 < s - t <= reach)]))
        got = passage_dedup.chain([p for p, _ in pairs], [s for _, s in pairs])
        assert sorted(i for one in got for i in one) == list(range(len(pairs)))
        best = [pairs[i] for i in got[0]]
        steps = list(zip(best, best[1:], strict=False))
        assert all(0 < p - q <= reach and 0 < s - t <= reach for (q, t), (p, s) in steps)
        assert passage_dedup.K * len(best) - sum(passage_dedup.GAP_COST * (p - q + s - t) for (q, t), (p, s) in steps) == pytest.approx(max(score))


def test_two_passages_of_one_source_at_any_gap(spark):
    rng = random.Random(8)
    docs, want, base = [], {}, 0
    for gap in (69, 100, 200, 500, 1000, 2000):
        x, y = sentence(rng, 60), sentence(rng, 100)
        docs += [(base, " ".join(x + sentence(rng, gap) + y)), (base + 1, " ".join(x + sentence(rng, gap) + y))]
        want[base + 1] = {(0, 60), (60 + gap, 160 + gap)}
        base += 2
    out = passage_dedup.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: {(p.start, p.end) for p in r.passages} for r in out if r.passages} == want


@pytest.mark.parametrize("parts", [2, 3, 5])
def test_holders_of_parts_do_not_hide_the_holder_of_the_whole(spark, parts):
    rng = random.Random(9)
    passage, size = sentence(rng, 60), 60 // parts
    docs = [(1, " ".join(sentence(rng, 30) + passage + sentence(rng, 30)))]
    for k in range(parts):
        docs += [(10 * k + j, " ".join(sentence(rng, 30) + passage[k * size : (k + 1) * size] + sentence(rng, 30))) for j in (10, 11, 12)]
    docs.append((1000, " ".join(sentence(rng, 20) + passage + sentence(rng, 20))))
    out = {r.doc_id: {(p.source, p.start, p.end) for p in r.passages} for r in passage_dedup.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d: p for d, p in out.items() if p} == {1000: {(1, 20, 80)}}


def test_every_window_of_an_earlier_document_is_cut(spark):
    """Brute force over texts of few words, lines that repeat, and cuts of each other."""
    rng = random.Random(10)
    lines = [sentence(rng, rng.randrange(3, 30)) for _ in range(12)]
    texts = [sum((rng.choice(lines) for _ in range(rng.randrange(1, 25))), []) for _ in range(60)]
    texts += [lines[0] * 10, sentence(rng, 9) + lines[0] * 40, ["x"] * 70, ["x"] * 400, ["x", "y"] * 90, sentence(rng, 30) + ["x", "y"] * 300]
    first, want = {}, {}
    for d, w in enumerate(texts):
        want[d] = {k for i in range(len(w) - 49) if first.setdefault(tuple(w[i : i + 50]), d) != d for k in range(i, i + 50)}
    rows = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(texts)], "doc_id long, text string")
    for r in passage_dedup.find(rows).collect():
        assert want[r.doc_id] <= {k for p in r.passages for k in range(p.start, p.end)}


def test_repeats_beyond_those_of_the_source_are_cut(spark):
    rng = random.Random(12)
    docs = []
    for k, n in enumerate((1, 2, 8, 20)):
        line, times = sentence(rng, n), -(-60 // n)
        docs += [(2 * k, " ".join(sentence(rng, 20) + line * times)), (2 * k + 1, " ".join(sentence(rng, 20) + line * (4 * times)))]
    out = {r.doc_id: r for r in passage_dedup.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    left = {d: len(r.cleaned.split()) - 20 for d, r in out.items() if d % 2}
    print("words left", left)
    assert left == {1: 0, 3: 0, 5: 0, 7: 0}


def test_extensions_are_those_of_one_pair_at_a_time():
    rng = np.random.default_rng(5)
    for _ in range(40):
        a = rng.integers(0, 4, rng.integers(0, 30))
        others = [np.delete(a, rng.integers(0, len(a), 2)) if len(a) and k % 3 else rng.integers(0, 4, rng.integers(0, 30)) for k in range(20)]
        others += [np.where(rng.random(len(a)) < 0.1, 9, a), a]
        size = np.array([len(x) for x in others])
        start, flat = np.concatenate(([0], np.cumsum(size)[:-1])), np.concatenate([*others, [7]]).astype(np.int64)
        want = [passage_dedup._extend(a.tolist(), x.tolist()) for x in others]
        assert list(zip(*(x.tolist() for x in passage_dedup.extensions(a, flat, start, size, 1)), strict=True)) == want
        want = [passage_dedup._extend(a.tolist(), x[::-1].tolist()) for x in others]
        assert list(zip(*(x.tolist() for x in passage_dedup.extensions(a, flat, start + size - 1, size, -1)), strict=True)) == want


def test_edits_are_not_counted_where_bounds_settle_it(monkeypatch):
    """Two texts with two seeds in common, 20 words apart, and nothing else: no passage, without a comparison word by word."""
    rng = np.random.default_rng(7)
    own, other = (rng.integers(1, 1 << 32, 200, dtype=np.uint32) for _ in range(2))
    for a, b in ((100, 90), (126, 118)):
        other[b : b + passage_dedup.K] = own[a : a + passage_dedup.K]
    places, other_places, keys = np.array([100, 126]), np.array([90, 118]), np.array([5, 9], np.uint64)
    calls, count = [], passage_dedup._edit_distance
    monkeypatch.setattr(passage_dedup, "_edit_distance", lambda a, b: calls.append(1) or count(a, b))
    assert passage_dedup._passages_of(own, keys, places, other, keys, other_places, 50, 0.8) == [] and not calls
    # 20 and 22 words between the seeds, with 5 edits, are a passage
    other[96:114] = own[107:125]
    start, end, other_start, other_end, agreeing = passage_dedup._passages_of(own, keys, places, other, keys, other_places, 30, 0.8)[0]
    assert (start, end, other_start, other_end, agreeing) == (100, 132, 90, 124, 2 * passage_dedup.K + 22 - 5) and calls


def test_short_ways_give_the_same(monkeypatch):
    rng = random.Random(8)

    def distance(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            rows.append([i])
            for j, y in enumerate(b, 1):
                rows[i].append(min(rows[i][j - 1] + 1, rows[i - 1][j] + 1, rows[i - 1][j - 1] + (x != y)))
        return rows[-1][-1]

    for _ in range(2000):
        a, b = ([rng.randrange(rng.choice((2, 5, 40))) for _ in range(rng.randrange(9))] for _ in range(2))
        assert passage_dedup._edit_distance(a, b) == distance(a, b)
    # matches that all follow each other, and the same behind one that lets the tree be used
    for _ in range(300):
        place, source = (np.cumsum([rng.choice((1, 4, 8, 30, 62, 66, 67)) for _ in range(rng.randrange(2, 30))]).tolist() for _ in range(2))
        n = min(len(place), len(source))
        place, source = place[:n], source[:n]
        far = [-1000, -999], [9_000, 8_000]
        behind = [[i - 2 for i in one] for one in passage_dedup.chain(far[0] + place, far[1] + source) if min(one) > 1]
        assert passage_dedup.chain(place, source) == behind
    monkeypatch.setattr(passage_dedup, "_PIECE", 7)
    row = np.sort(np.array([rng.randrange(4) for _ in range(60)]))
    place = np.concatenate([np.sort(rng.sample(range(300), int((row == r).sum()))) for r in range(4)]).astype(np.int64)
    key = np.array([rng.randrange(9) for _ in row], np.uint64)
    want = [(i, j) for i in range(60) for j in range(i + 1, 60) if row[i] == row[j] and place[j] - place[i] <= passage_dedup.MOST_GAP + passage_dedup.K and key[i] != key[j]]
    assert sorted((i, j) for x, y in passage_dedup._reached(place, row, key) for i, j in zip(x.tolist(), y.tolist(), strict=True)) == want
    words, owners = np.array([rng.randrange(1 << 30) for _ in range(100)], np.uint64), np.repeat([0, 1, 3], [40, 9, 51])
    pieces = passage_dedup._sampled(words, owners)
    monkeypatch.undo()
    assert all((x == y).all() for x, y in zip(pieces, passage_dedup._sampled(words, owners), strict=True))


def all_passages(texts, min_words=50, identity=0.8):
    """By brute force, for each document and each earlier one: the passages that all their common seeds make, and the seeds that both hold."""
    words, owners = wordhash.word_hashes([t.encode() for t in texts])
    at, key = passage_dedup.seeds(words, owners)
    key, start = wordhash.keys(key, wordhash.key_bits(1)), np.searchsorted(owners, np.arange(len(texts)))
    of = [((words[owners == d] >> np.uint64(32)).astype(np.uint32), key[owners[at] == d], (at - start[owners[at]])[owners[at] == d].astype(np.int32)) for d in range(len(texts))]
    for d in range(len(texts)):
        for s in range(d):
            found = passage_dedup._passages_of(*(of[d][i] for i in (0, 1, 2)), *of[s], min_words, identity)
            both = of[d][2][np.isin(of[d][1], of[s][1])].tolist()
            for a, b, *_ in found:
                yield d, s, a, b, [x for x in both if a <= x and x + passage_dedup.K <= b]


@pytest.mark.parametrize("block_bytes", [2_000_000, 3000])
def test_no_holder_hides_an_edited_passage(spark, block_bytes):
    """Seeds whose first holders are others, a line that many hold, and edited copies of each: by brute force over all pairs no passage with a seed that isn't cut is left."""
    rng = random.Random(31)
    texts, hidden = [], []
    hot = sentence(rng, 30)
    passages = [sentence(rng, 90) for _ in range(4)]
    passages.append(sentence(rng, 20) + hot + sentence(rng, 30))
    # earlier documents hold each passage in parts, by turns
    for p in passages:
        for at in range(0, len(p), 15):
            texts += [sentence(rng, 30) + p[at : at + 22] + sentence(rng, 30)]
    texts += [sentence(rng, 40) + hot + sentence(rng, 40) for _ in range(30)]
    for p in passages:
        texts.append(sentence(rng, 20) + p + sentence(rng, 25))
        for step in (24, 17, 12):
            copy = [f"z{rng.randrange(10**6)}" if i % step == step - 1 else w for i, w in enumerate(p)]
            hidden.append((len(texts), 20, 20 + len(copy)))
            texts.append(sentence(rng, 20) + copy + sentence(rng, 25))
    texts += [sentence(rng, 40) + hot + sentence(rng, 40) for _ in range(30)]
    texts = [" ".join(w) for w in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def covered(out):
        return {r.doc_id: {k for p in r.passages for k in range(p.start, p.end)} for r in out}

    def missed(cut):
        return [(d, s, a, b) for d, s, a, b, seeds in all_passages(texts) if any(not set(range(x, x + passage_dedup.K)) <= cut[d] for x in seeds)]

    out = passage_dedup.search(rows, block_bytes=block_bytes).collect()
    first = covered(passage_dedup.find(rows).collect())
    cut = covered(out)
    print("passages missed by first holders and by all", len(missed(first)), len(missed(cut)), "hidden", sum(not first[d] for d, _, _ in hidden))
    assert missed(first) and not missed(cut)
    assert all(first[d] <= cut[d] for d in cut)
    for r in out:
        for p in r.passages:
            mine, other = texts[r.doc_id].split()[p.start : p.end], texts[p.source].split()[p.source_start : p.source_end]
            assert p.source < r.doc_id and len(mine) >= 50 and common_words(mine, other) >= p.agreeing >= 0.8 * max(len(mine), len(other))


def test_search_in_odd_cases(spark):
    rng = random.Random(6)
    passage = " ".join(sentence(rng, 70))
    docs = [(1, passage), (2, passage), (2, passage), (2, "other " + passage), (3, None), (4, ""), (None, passage), (6, " ".join(sentence(rng, 20)) + " " + passage)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("mark", F.lit("x"))
    out = passage_dedup.search(rows)
    assert out.columns == ["doc_id", "text", "mark", "cleaned", "passages"]
    got = sorted(((r.doc_id, r.text, r.cleaned, r.mark) for r in out.collect()), key=str)
    cut = {2: lambda t: "" if t == passage else "other ", 6: lambda t: t[: -len(passage)]}
    assert got == sorted(((d, t, cut[d](t) if d in cut else t, "x") for d, t in docs), key=str)
    assert passage_dedup.search(rows.limit(0)).count() == 0


# ---- language model -----------------------------------------------------------------------------


def test_backoff_scores_match_brute_force(spark, sf_dir):
    docs = [(r.doc_id, words_of(r.text)) for r in table(spark, sf_dir, "documents").collect()]
    got = {r.doc_id: r for r in queries.op5_backoff_lm(spark, sf_dir).collect()}
    check_scores(docs, got)


def check_scores(docs, got):
    counts = [None, Counter(), Counter(), Counter()]
    for _, w in docs:
        for n in (1, 2, 3):
            counts[n].update(zip(*[w[i:] for i in range(n)]))
    total = sum(len(w) for _, w in docs)
    for d, w in docs:
        own = [None, *(Counter(zip(*[w[i:] for i in range(n)])) for n in (1, 2, 3))]
        left = lambda g, own=own: counts[len(g)][g] - own[len(g)][g]
        score, rest = 0.0, max(1, total - len(w))
        for i in range(len(w)):
            top = min(3, i + 1)
            for n in range(top, 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if left(g) > 0 and (n == 1 or left(g[:-1]) > 0):
                    score += math.log(left(g) / (left(g[:-1]) if n > 1 else rest)) + (top - n) * math.log(0.4)
                    break
            else:
                score += top * math.log(0.4) - math.log(rest)
        grams = [tuple(w[max(0, i - 2) : i + 1]) for i in range(len(w))]
        full = sum(math.log(counts[len(g)][g] / (counts[len(g) - 1][g[:-1]] if len(g) > 1 else total)) for g in grams)
        assert got[d].n_words == len(w)
        assert got[d].log_score == pytest.approx(score, rel=1e-9, abs=1e-6)
        assert got[d].full_log_score == pytest.approx(full, rel=1e-9, abs=1e-6)


def test_backoff_odd_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, "\n"), (4, "a"), (5, "a b a b a b"), (6, "A b"), (7, long)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("log_score", F.lit("clash")).withColumn("key", F.lit(0))
    assert set(backoff_lm.score(rows).columns) == {"doc_id", "n_words", "log_score", "mean_log_score", "full_log_score"}
    got = {r.doc_id: r for r in backoff_lm.score(rows).collect()}
    check_scores([(d, words_of(t)) for d, t in docs], got)
    assert got[1].mean_log_score is None and got[1].log_score == 0
    twice = backoff_lm.score(rows.union(rows))
    assert twice.count() == 2 * len(docs)
    assert backoff_lm.score(rows.limit(0)).count() == 0


# ---- nearest neighbours -------------------------------------------------------------------------


def recall(rows, got, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    hit = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        apart = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        others = ids != ids[i]
        best = np.lexsort((ids[others], apart[others]))[:k]
        want = dict(zip(ids[others][best].tolist(), apart[others][best].tolist(), strict=True))
        mine = got[ids[i]]
        assert [r["rank"] for r in mine] == list(range(1, len(want) + 1))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        for r in mine:
            assert r.score == pytest.approx(np.sqrt(((x[ids == r.vec_id][0] - x[i]) ** 2).sum()), abs=1e-12)
        hit += len(set(want) & {r.vec_id for r in mine})
        total += len(want)
    return hit / max(1, total)


def grouped(out):
    by = defaultdict(list)
    for r in sorted(out, key=lambda r: r["rank"]):
        by[r.query_id].append(r)
    return by


def test_recall_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    assert recall(rows, grouped(queries.op3_multi_index_hashing(spark, sf_dir).collect())) >= 0.9


def test_recall_with_a_hot_vector(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 32))
    x[500:1500] = x[500]
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert recall(rows, grouped(hashing_index.search(df, F.col("vec_id") % 100 == 0).collect())) >= 0.9


def test_index_odd_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 0.1]), (9, [1.0, 2.0, 3.0]), (100, [0.0, 0.0]), (200, [0.0, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = grouped(hashing_index.search(df, F.col("vec_id") % 100 == 0).collect())
    assert {q: [r.vec_id for r in rs] for q, rs in got.items()} == {0: [1, 8, 200], 200: [1, 8, 0]}
    assert hashing_index.search(df.limit(0), F.lit(True)).count() == 0
    assert hashing_index.search(df.where("vec_id IN (2, 3, 4)"), F.lit(True)).count() == 0


def test_probing_retrieves_every_code_within_the_radius():
    """Pigeonhole: with m substrings probed to a reach, every code within m * (reach + 1) - 1 bits; and no row that has no substring in reach."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 32))
    x[:200] = x[0] + rng.normal(scale=0.3, size=(200, 32))
    coder = hashing_index.fit(x, 10)
    index = hashing_index.Index(coder, np.arange(len(x)), x)
    codes = coder.codes(x)
    m = codes.shape[1]
    for reach in range(4):
        apart = hashing_index._BITS_SET[codes ^ codes[0]]
        got = set(index.retrieve(codes[0], reach).tolist())
        assert got == set(np.flatnonzero((apart <= reach).any(axis=1)))
        assert got >= set(np.flatnonzero(apart.sum(axis=1, dtype=int) <= m * (reach + 1) - 1))


def test_index_prunes(spark):
    """Of the largest table at hand less than a fifth of the rows is ranked per query."""
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    coder = hashing_index.fit(x, 10)
    index = hashing_index.Index(coder, ids, x)
    codes = coder.codes(x)
    hit = ranked = asked = 0
    for i in np.flatnonzero(ids % 20 == 0):
        found, _, n = index.nearest(ids[i], x[i], codes[i], 10)
        apart = ((x - x[i]) ** 2).sum(axis=1)
        apart[i] = np.inf
        hit += len(set(found.tolist()) & set(ids[np.argsort(apart)[:10]].tolist()))
        ranked, asked = ranked + n, asked + 1
    print("share ranked", ranked / asked / len(ids), "recall", hit / asked / 10, "bits", coder.planes.shape[1], "reach", coder.reach)
    assert hit / asked / 10 >= 0.9 and ranked / asked / len(ids) < 0.25


def test_queries_that_repeat_are_one(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])]
    got = hashing_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2)]
