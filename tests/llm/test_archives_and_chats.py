"""WARC round trips, tool calls and the pipeline."""

import base64
import hashlib
import json
import struct
from collections import Counter, defaultdict

import numpy as np
import oracle
import pyarrow.fs
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import queries, tool_calls, warc
from quern.session import shared_path, table

# ---- archives -----------------------------------------------------------------------------------


def expected(pages, revisit_from=0):
    groups = defaultdict(list)
    for page, html in pages:
        groups[(html or "").encode()].append(page)
    out = []
    for payload, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        known = [i for i in ids if i is not None]
        keeper = max(known, default=None) if len(payload) >= revisit_from else None
        for i in ids:
            revisit = keeper is not None and i is not None and i < keeper
            out.append((i, len(payload), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=repr)


def summary(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip_of_the_table(spark, sf_dir):
    pages = [(r.page_id, r.html) for r in table(spark, sf_dir, "pages").collect()]
    assert summary(queries.op9_warc_dictionary(spark, sf_dir)) == expected(pages)


ODD = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (3, "http://c/", "same"), (4, "http://d/", None), (5, "http://e/", ""), (-7, "http://f/\r\nX: y", "é" * 200_000), (None, "http://g/", "same"), (2**62, "http://h/", "tiny")]


@pytest.mark.parametrize("revisit_from", [0, 3, 5])
def test_odd_cases_and_payloads(spark, revisit_from):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("digest", F.lit(1))
    folder = shared_path(spark, "warc")
    archives = warc.write_archives(pages, folder, revisit_from, archive_size=1000)
    out = warc.read_archives(archives, folder)
    assert summary(out) == expected([(p, h) for p, _, h in ODD], revisit_from)
    stored = {r.page_id: bytes(r.payload).decode() for r in out.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert stored[-7] == "é" * 200_000 and stored[3] == "same" and stored[5] == ""
    assert {r.url for r in out.where("page_id = -7").collect()} == {"http://f/%0D%0AX:%20y"}
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_archives_lead_with_their_dictionary(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<html><body><p>page {i} " + "shared words of all pages " * (i % 9) + "</p></body></html>") for i in range(400)], "page_id long, url string, html string")
    folder = shared_path(spark, "warc")
    for r in warc.write_archives(pages.coalesce(1), folder).collect():
        store, _ = pyarrow.fs.FileSystem.from_uri(folder)
        with store.open_input_stream(r.path, compression=None) as source:
            raw = source.read()
        magic, size = struct.unpack_from("<II", raw)
        assert magic == 0x184D2A5D
        words = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
        assert words.dict_id() or size <= 4096
        # a reader that is given the dictionary finds one frame per record
        assert sum(1 for _ in warc.archive_records(raw)) == r.records
        first = zstandard.ZstdDecompressor(dict_data=warc._dictionary(raw[8 : 8 + size])).decompressobj().decompress(raw[8 + size :])
        assert first.startswith(b"WARC/1.1\r\n")


def test_damage_is_noticed():
    record = warc.make_record(5, "http://x/", b"payload", None)
    assert warc.parse_record(record)["page_id"] == 5
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload", b"paylaod"))


# ---- tool calls ---------------------------------------------------------------------------------

TOOLS = [("add", json.dumps({"properties": {"x": {"type": "integer"}, "y": {"type": "number", "minimum": 0, "maximum": 9}, "s": {"type": "string", "maxLength": 3, "enum": ["a", "bb", "cccc"]}, "l": {"type": "array"}}, "required": ["x"], "additionalProperties": False}))]


def call(i, args, name="add"):
    return {"id": i, "name": name, "arguments": args}


def link(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("level", F.lit("clash")).withColumn("errors", F.lit(1))
    return tool_calls.link(messages, spark.createDataFrame(TOOLS, "name string, schema string"))


def test_tool_calls_match_sql(spark, sf_dir):
    ours, theirs = oracle.compare(queries.op6_tool_calls(spark, sf_dir), queries.OP6_SQL, oracle.connection(sf_dir))
    assert (ours[:2], theirs[:2]) == ([], [])


def test_order_over_chains_joins_and_circles(spark):
    needs = {"a": [], "b": ["a"], "c": ["a", "b"], "d": ["c"], "e": ["d", "a"], "p": ["q"], "q": ["p"], "r": ["p", "a"], "m": ["none"], "n": ["m"]}
    calls = [call(i, {f"k{j}": f"$result:{n}" for j, n in enumerate(ns)}) for i, ns in needs.items()]
    rows = [(1, 0, "assistant", json.dumps({"tool_calls": calls}))] + [(1, 1 + k, "tool", json.dumps({"tool_call_id": i, "content": k})) for k, i in enumerate(needs)]
    chain = [(2, 2 * k, "assistant", json.dumps({"tool_calls": [call(f"c{k}", {"after": f"$result:c{k - 1}"} if k else {})]})) for k in range(70)]
    chain += [(2, 2 * k + 1, "tool", json.dumps({"tool_call_id": f"c{k}", "content": "ok"})) for k in range(70) if k != 50]
    out = link(spark, rows + chain).where("kind = 'call'").collect()
    assert {r.call_id: r.level for r in out if r.conv_id == 1} == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "p": None, "q": None, "r": None, "m": None, "n": None}
    assert {int(r.call_id[1:]): r.level for r in out if r.conv_id == 2} == {k: (k if k <= 50 else None) for k in range(70)}


def test_validation(spark):
    cases = {
        '{"x": 1}': [], '{"x": 1, "y": 2.5, "s": "a", "l": [1]}': [], "{}": ["x: missing"], '{"x": "1"}': ["x: wrong type"], '{"x": 1.5, "y": -1}': ["x: wrong type", "y: too small"], '{"x": 1, "y": 10}': ["y: too large"],
        '{"x": 1, "s": "cccc"}': ["s: too long"], '{"x": 1, "s": "b"}': ["s: not allowed"], '{"x": 1, "z": 0}': ["z: unexpected"], '{"x": null}': ["x: wrong type"], "[1]": ["not an object"], "not json": ["not an object"],
    }
    rows = [(i, 0, "assistant", json.dumps({"tool_calls": [call("a", text)]})) for i, text in enumerate(cases)]
    rows.append((99, 0, "assistant", json.dumps({"tool_calls": [call("a", {"x": 1}, "other")]})))
    found = {r.conv_id: r.errors for r in link(spark, rows).collect()}
    assert [found[i] for i in range(len(cases))] == list(cases.values())
    assert found[99] == ["unknown tool"]


def test_rules_of_all_kinds(spark):
    """Several types, bounds of every kind, and rules that aren't known, which never pass in silence."""
    schema = {
        "$schema": "x", "type": "object", "additionalProperties": {"type": "string"},
        "properties": {
            "t": {"type": ["string", "null"], "description": "either"}, "e": {"exclusiveMinimum": 0, "exclusiveMaximum": 5}, "s": {"type": "string", "minLength": 2}, "l": {"type": "array", "minItems": 1, "maxItems": 2},
            "p": {"type": "string", "pattern": "^a"}, "n": {"type": "object", "properties": {"q": {"type": "integer"}}, "required": ["q"]}, "i": {"type": "array", "items": {"type": "integer"}}, "any": {},
        },
    }
    top = "unsupported rule additionalProperties"
    cases = {
        '{"t": "a", "e": 3, "s": "ab", "l": [1], "any": {"q": 1}}': [], '{"t": null}': [], '{"t": 1}': ["t: wrong type"], '{"e": 0}': ["e: too small"], '{"e": 5}': ["e: too large"], '{"s": "a"}': ["s: too short"],
        '{"l": []}': ["l: too few"], '{"l": [1, 2, 3]}': ["l: too many"], '{"p": "b"}': ["p: unsupported rule pattern"], '{"p": 1}': ["p: wrong type"],
        '{"n": {"q": "x"}}': ["n: unsupported rule properties, required"], '{"i": ["x"]}': ["i: unsupported rule items"],
    }
    rows = [(i, 0, "assistant", json.dumps({"tool_calls": [call("a", text, "many")]})) for i, text in enumerate(cases)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    tools = spark.createDataFrame([("many", json.dumps(schema))], "name string, schema string")
    found = {r.conv_id: r.errors for r in tool_calls.link(messages, tools).collect()}
    assert [found[i] for i in range(len(cases))] == [sorted([*errors, top]) for errors in cases.values()]


def test_no_tools_and_no_messages(spark):
    tools = spark.createDataFrame(TOOLS, "name string, schema string")
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tool_calls.link(empty, tools).count() == 0
    rows = spark.createDataFrame([(1, 0, "assistant", json.dumps({"tool_calls": [call("a", {"x": 1})]}))], empty.schema)
    assert [r.errors for r in tool_calls.link(rows, tools.limit(0)).collect()] == [["unknown tool"]]


def test_names_of_stores():
    assert [warc.arrow_uri(x) for x in ("s3a://b/c", "s3n://b", "s3://b", "hdfs://h/p", "/tmp/x", "file:///tmp/x")] == ["s3://b/c", "s3://b", "s3://b", "hdfs://h/p", "file:///tmp/x", "file:///tmp/x"]


def test_chat_odd_cases(spark):
    rows = [
        (1, 0, "system", "hi"), (1, 1, "assistant", json.dumps({"tool_calls": [call("a", {"y": 1, "x": {"q": 1, "b": [1, {"z": 1, "a": None}]}}), call("a", {"x": 2}), call(None, {"x": 3})]})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": {"z": 1, "b": "é\n"}})), (1, 3, "tool", json.dumps({"tool_call_id": "a", "content": 2})), (1, 4, "tool", json.dumps({"tool_call_id": "zz", "content": None})),
        (1, 5, "assistant", '{"tool_calls": broken'), (1, 6, "assistant", '{"tool_calls": []}'), (1, 7, "tool", "text"), (None, None, None, None), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (3, 0, "user", "long " * 100_000),
    ]
    out = link(spark, rows).collect()
    by = {(r.conv_id, r.turn, r.kind, r.pos): r for r in out}
    assert len(out) == 14
    assert [by[1, 1, "call", k].status for k in range(3)] == ["linked", "duplicate", "unanswered"]
    assert [by[1, k, "result", 0].status for k in (2, 3, 4)] == ["linked", "duplicate", "orphan"]
    assert by[1, 1, "call", 0].canonical == '{"args":{"x":{"b":[1,{"a":null,"z":1}],"q":1},"y":1},"id":"a","name":"add","type":"call"}'
    assert by[1, 2, "result", 0].canonical == '{"content":{"b":"é\\n","z":1},"id":"a","type":"result"}'
    assert [by[1, k, "message", 0].status for k in (5, 6, 7)] == ["plain"] * 3
    assert by[None, None, "message", 0].canonical == '{"content":null,"role":null,"type":"message"}'
    assert link(spark, []).count() == 0


# ---- the pipeline -------------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    counts = [docs.count()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        if name != "best_fit_packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before)
            if name != "passage_dedup":
                assert all(before[d] == t for d, t in after.items())
            assert all(r.n_chars == len(r.text) for r in docs.collect()) or name != "passage_dedup"
    assert all(b <= a for a, b in zip(counts[:4], counts[1:5]))
    assert counts[4] > 0.5 * counts[0]
    assert {r.doc_id for r in docs.collect()} == set(after)


def test_pipeline_of_an_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_pipeline_of_odd_rows(spark, sf_dir):
    """Repeated rows, null ids, texts and languages, ties, a very long text, and columns named like those that operators add."""
    docs = table(spark, sf_dir, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, sf_dir)
    one = kept.where("length(text) > 2000").orderBy("doc_id").first()
    own = sum((r.text.split() for r in kept.orderBy("doc_id").collect()), [])
    long = " ".join(own[i] for i in np.random.default_rng(1).integers(0, len(own), 300_000))
    row = lambda i, text, lang="en": (i, text, lang, "x", len(text or ""))
    odd = [row(one.doc_id, one.text), row(one.doc_id, one.text), row(None, one.text), row(None, None, None), row(10**9, None), row(10**9 + 1, ""), row(10**9 + 2, long, None), row(10**9 + 3, one.text)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for name in ("score", "kept", "bucket", "key", "cleaned", "_key", "_gone", "component_id"):
        rows = rows.withColumn(name, F.lit("clash"))
    now = rows
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, sf_dir)
        assert now.columns == rows.columns
        ids = Counter(r.doc_id for r in now.collect())
        if name == "ngram_jaccard_join":
            assert ids[one.doc_id] == 1 and ids[None] == 1 and ids[10**9 + 3] == 0
    assert ids[10**9] == ids[10**9 + 1] == 0 and ids[10**9 + 2] == 1
    pieces = corpus_pipeline.STAGES[4][1](spark, now, sf_dir).collect()
    assert {r.doc_id for r in pieces} == set(ids) and all(r.length <= 2048 for r in pieces)
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
