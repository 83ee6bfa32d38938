"""JSON fields that a written schema does not know."""

import json
import os

from graphloom.operators.fields import json_fields, read_variants, schema_fields, unknown_fields
from graphloom.sources.runlogs import SCHEMAS

from pyspark.sql.types import StructType


def told(frame):
    return {(r.field, r.kind): (r.records, r.known) for r in frame.collect()}


def brute(records, known):
    from collections import Counter

    kinds = {str: "string", bool: "boolean", int: "number", float: "number", dict: "object", list: "array", type(None): "null"}
    seen = Counter()

    def visit(value, path):
        if path:
            seen[path, kinds[type(value)]] += 1
        members = value.items() if isinstance(value, dict) else [("[]", v) for v in value] if isinstance(value, list) else []
        for key, v in members:
            visit(v, path + key if key == "[]" else f"{path}.{key}" if path else key)

    for r in records:
        visit(r, "")
    return {k: (n, k[0] in known) for k, n in seen.items()}


def test_nested_fields_kinds_and_malformed_text(spark):
    records = [{"a": 1, "b": {"c": "x", "d": [1, {"e": 2.5}]}, "f": None}, {"a": "one", "b": {}}, {}, {"b": {"c": True}, "g": []}]
    lines = [json.dumps(r) for r in records] + [None, "{not json"]
    frame = spark.createDataFrame([(x, 1) for x in lines], "record string, field int")
    known = "a INT, b STRUCT<c: STRING, d: ARRAY<STRUCT<e: DOUBLE>>>"
    want = brute(records, {"a", "b", "b.c", "b.d", "b.d[]", "b.d[].e"})
    assert told(json_fields(frame, known)) == {**want, ("", "malformed"): (1, False)}
    # below the depth asked for fields are not taken apart
    shallow = told(json_fields(frame, known, depth=1))
    assert ("b", "object") in shallow and not any("." in f for f, _ in shallow)
    assert told(json_fields(frame.limit(0), known)) == {}


def test_schema_paths():
    got = schema_fields(StructType.fromDDL("a INT, b STRUCT<c: ARRAY<ARRAY<INT>>>, d ARRAY<STRUCT<e: INT>>"))
    assert got == ["a", "b", "b.c", "b.c[]", "b.c[][]", "d", "d[]", "d[].e"]


def test_run_folders_with_a_renamed_field(spark, scratch):
    runs = {"app-1": [{"stageId": 1, "inputBytes": 5}, {"stageId": 2, "bytesIn": 7}], "app-2": [{"stageId": 1, "extra": {"x": 1}}]}
    for app, records in runs.items():
        os.makedirs(f"{scratch}/{app}")
        with open(f"{scratch}/{app}/stages.json", "w") as f:
            json.dump(records, f)
    read = read_variants(spark, f"{scratch}/app-*", "stages")
    assert {r.app_id for r in read.collect()} == {"app-1", "app-2"}
    assert told(unknown_fields(read, "stages")) == {
        ("bytesIn", "number"): (1, False), ("extra", "object"): (1, False), ("extra.x", "number"): (1, False)}
    assert told(json_fields(read, SCHEMAS["stages"]))["stageId", "number"] == (3, True)
