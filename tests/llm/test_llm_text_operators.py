"""Quality, licence, mixing, tool-call and packing operators: edge cases and brute force."""

import hashlib
import json
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import corpus_pipeline
from graphloom.llm import licenses, mixing, packing, quality, tool_calls
from graphloom.llm.common import Scratch, numbered, small_frame

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------------------------------ packing

def tokenizer():
    from graphloom.llm.queries import tokenizer_path

    return tokenizer_path()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é'st.,!? \n\t\r\x0b\x1c\xa0 ²½3_-đ中́"), max_size=40))
def test_word_cache_gives_the_tokenizers_ids(text):
    coder = packing._tokenizer(tokenizer())
    want = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aB é'st.,!? \n\t\r\x0b\xa0 ²½3_-đ中́"), max_size=30))
def test_plain_words_are_cut_as_by_the_general_rule(text):
    general = re.compile(r" ?[^\W\d_]+(?=[.,]?(?:\s|\Z))|[.,](?=\s|\Z)| ?\S+|\s+(?!\S)|\s+")
    assert packing.UNITS.findall(text) == general.findall(text)


def test_long_words_and_their_ids():
    coder = packing.WordCachedTokenizer(tokenizer())
    for n in (1, 31, 32, 33, 34, 200):  # as many ids as the prepared packs hold, and more
        word = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(n))
        ids = coder.tokenizer.encode(word, add_special_tokens=False).ids
        assert coder._unit_ids([word])[word] == np.array(ids, "<u4").tobytes()
    assert len(packing.PACKS) > 32


def test_special_strings_and_a_small_cache():
    coder = packing.WordCachedTokenizer(tokenizer(), remembered=3)
    for text in ("a<|endoftext|>b", "one two three four five six", "don't, won't; I'll", ""):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


def test_blocks_of_texts_are_cut_in_arrays_to_the_same_ids(monkeypatch):
    coder, draw = packing.WordCachedTokenizer(tokenizer()), random.Random(7)
    parts = ["a", "Word", "'s", "'ll", "'", "don't", " ", "  ", "\n", "\t", "\r", "\x0c", ".", ",", "1", "23", "-", "(", "ñandú", "漢字", "\x00",
             "\u0301", "😀", "\u2019", "\x1c", "\x85", "\xa0", "\u180e", "\u2003", "\u3000", "<|endoftext|>"]
    texts = ["".join(draw.choice(parts if i % 3 else parts[:24]) for _ in range(draw.randrange(25))) for i in range(3000)]
    texts = pa.array([*texts, None, "", " ", "\n ", "word " * 50])
    want = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    for most in (1 << 20, 100, 9):  # whole blocks, some texts each, texts in parts
        monkeypatch.setattr(packing, "BLOCK_BYTES", most)
        got, open_ = [], []
        for _, ids, counts, done in packing._encoded(coder, texts):
            told = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
            open_ += told[0]
            if done:
                got += [open_, *told[1:]]
                open_ = []
        assert got == want
    # each distinct unit of a block is looked up once, however many texts have it
    asked = []
    monkeypatch.setattr(packing, "BLOCK_BYTES", 1 << 20)
    monkeypatch.setattr(coder, "_ids_of", lambda units: asked.extend(units) or type(coder)._ids_of(coder, units))
    list(packing._encoded(coder, pa.array(["some words, some more words"] * 500)))
    assert sorted(asked) == [" more", " some", " words", ",", "some"]
    row, start, size = packing._cut(np.array([1, 5000, 1024, 7]), 1024)
    assert [*zip(row, start, size)] == [(i, a, n) for i, t in enumerate((1, 5000, 1024, 7)) for a, n in packing.binary_pieces(t)]


def test_long_texts_are_packed_in_parts(spark):
    rows = [(1, " some  words\n\nhere, and there" * 200_000), (2, "short"), (3, None)]  # more than a block
    out = packing.cut_pieces(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer()).collect()
    coder = packing._tokenizer(tokenizer())
    for doc, text in rows:
        pieces = sorted((r for r in out if r["doc_id"] == doc), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == coder.encode(text or "") + bytes(4)
        assert [(r["start"], r["length"]) for r in pieces] == packing.binary_pieces(pieces[0]["doc_tokens"])


def test_binary_pieces():
    for n in (1, 2, 7, 1023, 1024, 1025, 5000):
        pieces = packing.binary_pieces(n)
        assert sum(size for _, size in pieces) == n
        assert all(start == sum(s for _, s in pieces[:i]) for i, (start, _) in enumerate(pieces))
        assert [s for _, s in pieces if s < 1024] == sorted({s for _, s in pieces if s < 1024}, reverse=True)
    with pytest.raises(ValueError):
        packing.cut_pieces(None, "", max_tokens=1000)


def test_packing_of_odd_rows(spark):
    rows = [(1, "some words here " * 900, "x"), (2, None, "y"), (3, "", "y"), (None, "null key", "z"), (4, "same", "z"), (4, "same", "z")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, length string")
    out = packing.pack(frame, tokenizer()).collect()
    assert sorted(r["sequence_id"] for r in out) == list(range(len(out)))
    assert all(len(r["ids"]) == 4 * r["_length"] and r["offset"] == 0 for r in out)
    by: dict = {}
    for r in sorted(out, key=lambda r: r["start"]):
        by.setdefault(r["doc_id"], []).append(bytes(r["ids"]))
    assert b"".join(by[2]) == b"".join(by[3]) == bytes(4)
    coder = packing._tokenizer(tokenizer())
    assert b"".join(by[1]) == coder.encode(rows[0][1]) + bytes(4)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(empty, tokenizer()).collect() == []


# ------------------------------------------------------------------------------------------ quality

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r["doc_id"]: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert sum(p == q for p, q in held) / len(held) >= 0.95
    assert all(p == 1 for p, q in held if q == 1)


def test_training_reads_whole_documents_within_the_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, y: seen.append((sorted(len(b) for b in bags), len(y))))
    docs = [(i, "w " * (64 * (i % 7 + 1) - i % 64), "x") for i in range(1, 60)] + [(100, "long " * 64 * 200, "x"), (101, "", "x"), (3, "w " * 64 * 4 , "x")]
    docs = spark.createDataFrame([*docs, docs[-1]], "doc_id bigint, text string, h string")
    labels = spark.createDataFrame([(i, i % 2) for i in [*range(1, 60), 100, 101]], "doc_id bigint, quality int")
    used = [r for r in {(r["doc_id"], r["text"]) for r in docs.collect()} if zlib.crc32(str(r[0]).encode()) % 5]
    whole = sorted(len(quality.encode(t)) for _, t in used)
    for docs_most, most in ((2500, 40_000), (2500, 150), (10, 40_000)):
        quality.train(docs, labels, sample_docs=docs_most, sample_passages=most)
        sizes, n = seen.pop()
        assert n == len(sizes) <= docs_most and sum(sizes) <= most
        rest = list(whole)
        for size in sizes:
            rest.remove(size)
    quality.train(docs, labels)
    assert seen.pop()[0] == whole and max(whole) in (7, 200)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    bags = [rng.random((n, quality.FEATURES)).astype(np.float32) for n in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0], np.float32)
    model = quality.fit(bags * 4, np.tile(y, 4))
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, starts = np.concatenate(bags), np.array([0, 1, 4])

    def loss():
        p = model.parts(x, starts)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grad = quality._gradient(model.weights, model.parts(x, starts), y)
    for name, at in (("W", (5, 2)), ("b", (1,)), ("V", (2, 3)), ("U", (4, 1)), ("a", (2,)), ("c", (3,)), ("d", (0,))):
        old = model.weights[name][at]
        model.weights[name][at] = old + 1e-5
        up = loss()
        model.weights[name][at] = old - 1e-5
        down = loss()
        model.weights[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8), name


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "w " * 100_000, "c"), (None, "x", "d"), (4, "t", "e"), (4, "t", "e")],
                                 "doc_id bigint, text string, score string")
    nothing = spark.createDataFrame([], "doc_id bigint, quality int")
    out = quality.score(docs, quality.train(docs, nothing)).collect()
    assert len(out) == 6 and all(r["_score"] == 0.5 and r["predicted"] == 1 for r in out)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (3, None), (None, 1), (4, 1), (4, 1)], "doc_id bigint, quality int")
    assert len(quality.score(docs, quality.train(docs, labels)).collect()) == 6
    assert quality.keep_good(docs.where("doc_id < 0"), labels).collect() == []


# ------------------------------------------------------------------------------------------ mixing

def test_targets_and_taken_words(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 200), rng.choice(["a", "b", "c", "d", None])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(frame).collect()
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted((r["doc_id"], r["repeats"]) for r in out) == sorted((r["doc_id"], r["repeats"]) for r in again)
    sizes, targets, taken = {}, {}, {}
    for r in out:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * r["repeats"]
        targets[s] = r["target"]
        assert 0 <= r["repeats"] <= 2
    names = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, free, budget = {}, set(names), 1.5 * sum(sizes.values())
    while free:
        level = (budget - sum(want.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        want.update({s: 2.0 * sizes[s] for s in above} if above else {s: weight[s] * level for s in free})
        free = free - above if above else set()
    for s in names:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - targets[s]) <= 200
    repeated = mixing.mixed_documents(frame).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in repeated} == {r["doc_id"]: r["repeats"] for r in out if r["repeats"]}


def test_mixing_of_odd_rows(spark):
    rows = [(1, None, "s", 1), (2, "", "s", 1), (None, "a b", None, 1), (3, "c d e", "t", 1), (3, "c d e", "t", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    out = mixing.mix(frame).collect()
    assert len(out) == 5 and {r["doc_id"]: r["_size"] for r in out} == {1: 0, 2: 0, None: 2, 3: 3}
    assert len({r["repeats"] for r in out if r["doc_id"] == 3}) == 1
    assert mixing.mix(frame.where("doc_id < 0")).collect() == []
    assert mixing.mixed_documents(frame.where("doc_id < 0")).collect() == []


# ------------------------------------------------------------------------------------------ licences

def test_known_licences_however_wrapped(spark):
    notice = "Copyright (c) 2020 Jane Doe\nCopyright 2021, 2022 Jane Doe\nCopyright by Jane Doe\n© Jane Doe\n(c) 2020 Jane Doe\nAll rights reserved.\n\n"
    rows, want = [], []
    for name, text in licenses.KNOWN:
        for width in (24, 40, 60, 72, 79, 80, 100, 10 ** 6):
            for head in ("", notice):
                rows.append((len(rows), head + textwrap.fill(" ".join(text.split()), width, break_long_words=False, break_on_hyphens=False)))
                want.append(name)
    rows.append((len(rows), "Copyright law is a line of terms"))
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [got[i]["license_id"] for i in range(len(want))] == want
    assert got[len(want)]["digest"] == hashlib.sha256(b"copyright law is a line of terms").hexdigest()


def test_lettered_clauses_are_terms_however_wrapped(spark):
    terms = "You may copy if (a) you keep this list, (b) you name the changes and (c) you must retain every notice of the source form."
    other = terms.replace("retain", "drop")
    rows = [(i, "(c) 2020 Jane Doe\n(c) copyright Jane Doe\n" + textwrap.fill(text, width))
            for i, (text, width) in enumerate((t, w) for t in (terms, other) for w in range(20, 120, 3))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in licenses.license_scan(frame, known=[("lettered", terms)]).collect()}
    half = len(rows) // 2
    assert any(line.startswith("(c) you") for _, t in rows for line in t.split("\n"))
    assert [got[i]["license_id"] for i in range(len(rows))] == ["lettered"] * half + [None] * half
    assert len({got[i]["digest"] for i in range(len(rows))}) == 2


def test_licence_sql_states_the_same_rule(spark):
    import duckdb

    mit = dict(licenses.KNOWN[:1])["MIT"]
    texts = [None, "", "(c) you must retain it", "(c) 2020 x\nterms", "all rights reserved. and more", "copyright\nholder", "sub\nlicense",
             "Copyright law\r\nterms", "Copyright 2020 x\r\nterms", *(textwrap.fill(mit, w) for w in (30, 50, 79))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    documents = frame.toPandas()  # noqa: F841 (read by the SQL)
    want = duckdb.connect().sql(licenses.scan_sql()).fetchall()
    assert sorted(tuple(r) for r in licenses.license_scan(frame).collect()) == sorted(want)


def test_licences_in_other_dress(spark):
    mit = dict(licenses.KNOWN[:1])["MIT"]
    dressed = "Copyright (c) 2020 Some One\n(C) 2021 others\n\n" + mit.upper().replace(",", " ,").replace("SUBLICENSE", "SUB-LICENSE")
    british = "licensed under the apache  Licence -- version 2.0"
    rows = [(1, dressed), (2, mit + "\nand more"), (3, "words\n" + british + "\nwords"), (4, british), (5, None), (6, ""), (7, "...\n!!"),
            (None, british), (8, "x " * 50_000), (4, british)]
    frame = spark.createDataFrame([(*r, "d") for r in rows], "doc_id bigint, text string, digest string")
    out = {r["doc_id"]: r for r in licenses.license_scan(frame).collect()}
    assert licenses.license_scan(frame).count() == len(rows)
    assert out[1]["license_id"] == "MIT" and out[2]["license_id"] is None
    assert (out[3]["license_id"], out[3]["line_licenses"], out[3]["license_lines"]) == (None, "Apache-2.0", 1)
    assert (out[4]["license_id"], out[4]["license_lines"]) == ("Apache-2.0", 1) and out[None]["license_id"] == "Apache-2.0"
    assert out[5]["_digest"] == out[6]["_digest"] == out[7]["_digest"] and out[7]["license_id"] is None
    assert licenses.license_scan(frame.where("doc_id < 0")).collect() == []


# ------------------------------------------------------------------------------------------ tool calls

CALLS = "conv_id bigint, call_id string, parent_id string, turn bigint, name string, arguments string, valid string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"
SCHEMAS = [("f", "x", "integer", True, 0.0, 10.0), ("f", "s", "string", False, None, None), ("g", "o", "object", True, None, None)]


def linked(spark, calls, results):
    schemas = spark.createDataFrame(SCHEMAS, tool_calls.SCHEMA_COLUMNS)
    frame = spark.createDataFrame([(*c, "z") for c in calls], CALLS)
    return tool_calls.link_calls(frame, spark.createDataFrame(results, RESULTS), schemas).collect()


def test_tool_calls(spark):
    calls = [
        (1, "a", None, 0, "f", '{"s":"t","x":3}'), (1, "b", "a", 1, "f", '{"x": 11, "y": {"b":1,"a":[2, 1]}}'), (1, "c", "b", 2, "f", '{"s": 5}'),
        (1, "d", "gone", 3, "g", '{"o": {}}'), (1, "e", "e2", 4, "g", "not json"), (1, "e2", "e", 5, "g", "[1]"),
        (2, "a", "a", 0, "h", None), (2, None, None, 1, "f", '{"x":1}'), (2, None, None, 1, "f", '{"x":1}'), (2, "r", None, 3, "f", '{"x":1}'), (2, "r", None, 3, "f", '{"x":1}'),
    ]
    results = [(1, "a", 1, 'line\n"q"'), (1, "a", 5, "later"), (1, "z", 2, None), (2, None, 9, "lost"), (2, "r", 4, None)]
    out = linked(spark, calls, results)
    by = {(r["conv_id"], r["call_id"]): r for r in out if r["call_id"]}
    assert len(out) == 8 + 1 + 3
    assert [by[1, c]["generation"] for c in "abcd"] == [0, 1, 2, 0]
    assert by[1, "e"]["generation"] is None and "cycle" in by[1, "e"]["errors"] and by[2, "a"]["generation"] is None
    assert by[1, "a"]["valid"] and by[1, "a"]["status"] == "linked"
    assert by[1, "a"]["json"] == '{"arguments":{"s":"t","x":3},"call_id":"a","name":"f","result":"line\\n\\"q\\"","status":"linked"}'
    assert by[1, "b"]["errors"] == "out of range x,unknown y"
    assert '"y":{"a":[2,1],"b":1}' in by[1, "b"]["json"]
    assert by[1, "c"]["errors"] == "missing x,not string s"
    assert by[1, "e"]["errors"].startswith("arguments are not JSON") and by[1, "e2"]["errors"].startswith("arguments are no object")
    assert by[2, "a"]["errors"].startswith("unknown tool")
    assert by[1, "z"]["status"] == "no call" and by[1, "d"]["status"] == "no result"
    assert json.loads(by[2, "r"]["json"])["result"] is None and by[2, "r"]["status"] == "linked"
    assert sum(r["call_id"] is None for r in out) == 3


def test_long_chain_and_empty_tables(spark):
    calls = [(1, f"c{i}", f"c{i - 1}" if i else None, i, "f", '{"x":1}') for i in range(70)]
    assert [r["generation"] for r in sorted(linked(spark, calls, []), key=lambda r: r["turn"])] == list(range(70))
    assert linked(spark, [], []) == []


def test_pieces_are_numbered_without_a_shuffle_of_their_ids(spark, monkeypatch):
    rows = [(None if i % 17 == 3 else (i * 7) % 40, " ".join(["word"] * ((i * 37) % 2500)), "x") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, length string").repartition(5)
    written = []
    table = packing.Scratch.table
    monkeypatch.setattr(packing.Scratch, "table", lambda self, f: written.append(table(self, f)) or written[-1])
    out = packing.pack(frame, tokenizer())
    assert len(written) == 1 and "ids" in written[0].columns and "Exchange rangepartitioning" not in out._jdf.queryExecution().toString()
    got = sorted(out.collect(), key=lambda r: r["sequence_id"])
    assert [r["sequence_id"] for r in got] == list(range(len(got)))
    place = [(-r["_length"], r["doc_id"] is None, r["doc_id"] or 0, r["start"]) for r in got]
    assert place == sorted(place)
    known = sorted((r["doc_id"], r["start"], r["_length"], r["length"], bytes(r["ids"])) for r in got if r["doc_id"] is not None)
    want = packing.cut_pieces(frame, tokenizer()).where("doc_id is not null").collect()
    assert known == sorted((r["doc_id"], r["start"], r["_length"], r["length"], bytes(r["ids"])) for r in want)


def test_small_frames_need_no_python_workers(spark):
    # a list given to createDataFrame is read by Python workers of another kind, which stay beside the operators'
    frame = spark.createDataFrame([(2, "b c"), (1, None)], "doc_id bigint, text string")
    slim = small_frame(spark, [(1, "x"), (2, None)], StructType().add("a b", "integer").add("t", "string"))
    none = small_frame(spark, [], StructType().add("n", "long"))
    assert [tuple(r) for r in slim.collect()] == [(1, "x"), (2, None)] and none.collect() == []
    parts = Scratch(spark, "test-small")
    written = parts.table(frame)
    for made in (slim, none, packing.pack(written, tokenizer()), numbered(parts, written, F.col("doc_id"))):
        assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()


def test_pipeline_stages_bound_the_batches_of_workers(spark):
    docs = spark.createDataFrame([(1, "s", "a b")], "doc_id bigint, source string, text string")
    before = spark.conf.get(corpus_pipeline.ARROW_BYTES)
    try:
        for found, wanted in ((before, "4194304"), ("64m", "4194304"), ("1m", "1m")):
            spark.conf.set(corpus_pipeline.ARROW_BYTES, found)
            corpus_pipeline.packing_stage(spark, docs, "")
            assert spark.conf.get(corpus_pipeline.ARROW_BYTES).removesuffix("b") == wanted
    finally:
        spark.conf.set(corpus_pipeline.ARROW_BYTES, before)
