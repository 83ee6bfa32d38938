"""SimHash groups against a brute-force version; edge cases of the operator and of its stage."""

import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from graphloom.llm import simhash


def slow_fingerprint(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def slow_groups(fps, distance=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aAbÉ \t\n .", max_size=60)))
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text) & ((1 << 64) - 1) == slow_fingerprint(text)


def test_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    monkeypatch.setattr(simhash, "COUNT_BLOCK", 64)
    assert simhash.fingerprint(text) & ((1 << 64) - 1) == slow_fingerprint(text)


def near_links(spark, fps, **kw):
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    mask = (1 << 64) - 1
    return {tuple(sorted((r["a"] & mask, r["b"] & mask))) for r in simhash.linked_fingerprints(frame, **kw).collect()}


def test_index_finds_every_link(spark):
    import random

    rng = random.Random(3)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for flips in (1, 2, 3, 4):
            g = f
            for b in rng.sample(range(64), flips):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps))
    for distance, segments in ((2, 2), (3, 2), (3, 4), (1, 2), (4, 2)):
        want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= distance}
        assert near_links(spark, fps, distance=distance, segments=segments) == want


ROWS = [
    (1, "one two three four five six seven eight nine ten", 7),
    (2, "ONE two three four five six seven eight nine ten", 7),
    (2, "ONE two three four five six seven eight nine ten", 7),  # a repeated row
    (3, None, 7), (4, "", 7), (5, " \n\t", 7),
    (None, "something else entirely here", 7),
    (6, "word " * 5000, 7), (7, "word " * 5000, 8),
]


def test_groups_of_odd_rows(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, component_id int")
    got = simhash.simhash_groups(frame).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["_component_id"] == 1 and by[2]["component_id"] == 7  # the input's own column stays
    assert by[3]["_component_id"] == by[4]["_component_id"] == by[5]["_component_id"] == 3
    assert by[3]["fp"] == 0
    assert by[None]["_component_id"] is None
    assert by[7]["_component_id"] == 6


def test_stage_keeps_one_of_each_group(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, component_id int")
    kept = simhash.keep_one(frame).collect()
    assert sorted((r["doc_id"] or 0) for r in kept) == [0, 1, 3, 6]
    # repeated rows of the kept document: one stays
    twice = spark.createDataFrame([(1, "a b c d e")] * 5 + [(None, "x y z")] * 3, "doc_id bigint, text string")
    assert sorted((r["doc_id"] or 0) for r in simhash.keep_one(twice).collect()) == [0, 1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.simhash_groups(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_given_documents_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    fps = [slow_fingerprint(r["text"]) for r in rows]
    want = {r["doc_id"]: rows[g]["doc_id"] for r, g in zip(rows, slow_groups(fps))}
    assert {r["doc_id"]: r["component_id"] for r in simhash.simhash_groups(docs).collect()} == want
