"""Vector near-duplicates and exact top-k against brute force."""

import math

import numpy as np
import pytest

from graphloom.llm import cap_filters, vafile
from graphloom.llm.common import Scratch

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def clustered(seed, clusters=40, size=6, dim=64, noise=0.09):
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for c in range(clusters):
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            x = centre + noise * rng.standard_normal(dim) / math.sqrt(dim) * rng.uniform(0.5, 1.7)
            rows.append((n, [float(v) for v in x.astype(np.float32)], c % 3))
            n += 1
    return rows


def slow_links(rows, cosine=0.98):
    links = {}
    unit = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v, _ in rows}
    for i, _, a in rows:
        links[i] = {j for j, _, b in rows if i != j and a == b and float(unit[i] @ unit[j]) >= cosine}
    return links


def test_recall_and_precision(spark):
    rows = clustered(1)
    links = slow_links(rows)
    total = sum(map(len, links.values()))
    assert total > 200
    got = {r["vec_id"]: r["n_links"] for r in cap_filters.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] <= len(links[i]) for i in links)
    assert sum(got.values()) >= 0.98 * total


def test_recall_at_the_threshold_for_any_number_of_rows():
    # pairs of cosine 0.98 exactly; the code changes with the number of vectors searched
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((400, 64))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    for total in (300, 50_000, 10_000_000):
        code = cap_filters.ProductCode(64, total)
        shared = [bool(set(a) & set(b)) for a, b in zip(code.filters(x), code.filters(y))]
        assert sum(shared) / len(shared) >= 0.95, total


@pytest.mark.parametrize("dim,total", [(64, 10 ** 8), (64, 10 ** 9), (384, 50_000), (384, 10 ** 8), (384, 10 ** 9), (8, 1000)])
def test_recall_of_other_dimensions_and_more_rows(dim, total):
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((2, 400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98 ** 2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    code = cap_filters.ProductCode(dim, total)
    assert np.mean([bool(set(a) & set(b)) for a, b in zip(code.filters(x), code.filters(y))]) >= 0.95


def test_list_decoding_finds_all_filters():
    code = cap_filters.ProductCode(16, 500)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((20, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, filters, _ = code.decode(x, code.threshold, np.arange(20))
    scores = np.zeros((20, 1))
    for (lo, hi), w in zip(zip(code.cuts, code.cuts[1:]), code.words):
        scores = (scores[:, :, None] + ((x @ code.rotation)[:, lo:hi] @ w.T)[:, None, :]).reshape(20, -1)
    want = set(zip(*map(list, np.nonzero(scores >= code.threshold))))
    assert set(zip(row.tolist(), filters.tolist())) == {(int(a), int(b)) for a, b in want}


def test_blocks_of_a_hot_bucket_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "BUCKET_ROWS", 10)
    rows = clustered(3, clusters=2, size=45, noise=0.05)
    links = slow_links(rows)
    got = cap_filters.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: len(v) for i, v in links.items()}
    assert {r["component_id"] for r in got} == {0, 45}
    assert sorted(r["vec_id"] for r in got if r["kept"]) == [0, 45]


def linked_shapes(seed, chains, stars, dim=64, cosine=0.985):
    """Rows of 3-chains and of stars with 5 leaves: neighbours have ``cosine``, others less than 0.98; shape of each row."""
    rng = np.random.default_rng(seed)
    vectors, shape = [], []
    for c in range(chains + stars):
        basis = np.linalg.qr(rng.standard_normal((dim, 6)))[0].T
        far = math.sqrt(1 - cosine ** 2)
        leaves = [cosine * basis[0] + far * s for s in ((basis[1], -basis[1]) if c < chains else basis[1:])]
        for x in (basis[0], *leaves):
            vectors.append(x)
            shape.append(c)
    order = rng.permutation(len(vectors))
    return [(n, [float(v) for v in vectors[i].astype(np.float32)], 1) for n, i in enumerate(order)], [shape[i] for i in order]


def slow_components(links):
    least = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in least:
                least[j] = i
                todo.extend(links[j])
    return least


def test_bucket_hands_on_components_that_are_no_cliques():
    rows, _ = linked_shapes(11, chains=250, stars=60)
    links = slow_links(rows)
    least = slow_components(links)
    unit = np.array([v for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    n = len(rows)
    assert n > 2 * 512  # several stripes
    key, mult = np.arange(n), np.ones(n, np.int64)
    packed = np.array([np.array([0], "<i8").tobytes()] * n, dtype=object)
    keys, count, roots = cap_filters._bucket(unit, np.zeros(n, np.int64), np.zeros(n, np.int32), mult, key, packed, 0.98)
    assert dict(zip(keys.tolist(), roots.tolist())) == least and dict(zip(keys.tolist(), count.tolist())) == {i: len(v) for i, v in links.items()}


def test_components_of_chains_and_stars(spark):
    rows, shape = linked_shapes(12, chains=300, stars=50)
    links = slow_links(rows)
    least = slow_components(links)
    got = {r["vec_id"]: r for r in cap_filters.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = {c: all(got[i]["n_links"] == len(links[i]) for i in links if shape[i] == c) for c in shape}
    assert sum(found.values()) >= 0.9 * len(found)  # recall: the shapes whose links are all found
    for i in links:
        if found[shape[i]]:
            assert (got[i]["component_id"], got[i]["kept"]) == (least[i], least[i] == i)


def test_a_hot_bucket_goes_to_groups_of_a_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "BUCKET_ROWS", 10)
    monkeypatch.setattr(cap_filters, "GROUP_ROWS", 100)
    posts = spark.range(400).selectExpr("'1' label", "4 dim", "7L filter", "cast(id as string) key", "1L mult", "binary('') vec", "binary('') filters")
    dealt, _ = cap_filters._dealt(posts, Scratch(spark, "dealt"))
    sizes = [r["count"] for r in dealt.groupBy("g").count().collect()]
    assert sum(sizes) == 400 * 40 and max(sizes) <= 6 * 100


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, v, 1, "a"), (2, v, 1, "a"), (2, v, 1, "a"), (3, v, None, "a"), (4, v, 2, "a"), (5, None, 1, "a"), (6, [0.0] * 4, 1, "a"),
        (7, [1.0, None, 3.0, 4.0], 1, "a"), (8, [1.0, float("nan"), 3.0, 4.0], 1, "a"), (9, [float("inf")] + v[1:], 1, "a"),
        (10, [], 1, "a"), (11, v[:3], 1, "a"), (None, v, 1, "a"), (12, [2.0, 4.0, 6.0, 8.0], 1, "a"),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int, kept string")
    got = cap_filters.near_vectors(frame).collect()
    assert len(got) == len(rows)
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["_kept"]) for r in got}
    assert by[1] == (4, 1, True) and by[2] == (4, 1, False) and by[12] == (4, 1, False) and by[None] == (4, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert by[i] == (0, i, True), i
    empty = spark.createDataFrame([], SCHEMA)
    assert cap_filters.near_vectors(empty).collect() == []


# ------------------------------------------------------------------------------------------ top-k

def slow_top(rows, queries, k=10):
    whole = {i: [math.floor(1024 * float(x)) for x in v] for i, v in rows}
    out = set()
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def top(spark, rows, queries, **kw):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    asked = frame.where(frame["vec_id"].isin(queries))
    return {tuple(r) for r in vafile.top_vectors(frame, asked, **kw).collect()}


def test_top_equals_brute_force_in_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.standard_normal(16).astype(np.float32)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # many copies of one vector: ties go to smaller ids
    rows += [(2000 + i, [x + 1e-3 * i for x in rows[9][1]]) for i in range(60)]  # many near copies
    queries = [0, 5, 9, 100, 200, 1000, 2030]
    want = slow_top(rows, queries)
    assert top(spark, rows, queries) == want
    monkeypatch.setattr(vafile, "BLOCK_ROWS", 50)
    monkeypatch.setattr(vafile, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(vafile, "FIRST_READ", 1)
    assert top(spark, rows, queries) == want


def test_top_of_odd_vectors(spark):
    v = [0.5, -0.25]
    rows = [(0, v), (1, v), (1, v), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, []), (6, [0.1, 0.2]), (7, [1.0, 2.0, 3.0]),
            (None, v), (8, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, rank int")
    got = {tuple(r) for r in vafile.top_vectors(frame, frame.where("vec_id in (0, 2, 5, 7, 8)"), k=2).collect()}
    assert got == {(0, 1, 1, 512 * 512 + 256 * 256), (0, 2, 6, 512 * 102 - 256 * 204),
                   (8, 1, 0, 0), (8, 2, 1, 0)}
    empty = frame.where("vec_id < 0")
    assert vafile.top_vectors(empty, empty).collect() == [] and vafile.top_vectors(frame, empty).collect() == []
