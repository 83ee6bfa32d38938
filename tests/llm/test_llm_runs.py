"""Periodic runs on a Re-Pair grammar against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from graphloom.llm import queries, runs


def slow_runs(words, min_words=6):
    """Every period in turn: stretches of words that agree with the word a period ahead."""
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, 4 * q):
                out.setdefault((i, j + q), q)  # a smaller period of the same stretch came before
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def random_document(rng):
    n, kinds = rng.choice([0, 1, 5, 6, 20, 60, 200, 400]), rng.choice([1, 2, 3, 5, 50])
    words = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.5:
        p, s = rng.randint(1, max(1, n // 3)), rng.randrange(n)
        words = [words[i] if i < s else words[s + (i - s) % p] for i in range(n)]
    if rng.random() < 0.3:
        block = [rng.randrange(30) for _ in range(rng.randint(1, 60))]
        words += block * rng.randint(2, 9) + words[:20] + block * rng.randint(2, 9) + block[:rng.randint(0, len(block))]
    return words


def test_group_runs_equal_brute_force():
    rng = random.Random(3)
    seen = 0
    for _ in range(400):
        docs = [random_document(rng) for _ in range(rng.randint(1, 6))]
        begins = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        flat = np.array([w for d in docs for w in d], np.int64)
        want = [(s + int(b), s + n + int(b), q) for d, b in zip(docs, begins) for s, n, q in slow_runs(d)]
        assert runs.group_runs(flat, begins) == want
        seen += len(want)
    assert seen > 500


def test_grammar_derives_the_text_and_repeats_no_pair():
    rng = random.Random(4)
    for _ in range(60):
        docs = [random_document(rng) for _ in range(rng.randint(1, 4))]
        words = np.array([w for d in docs for w in d], np.int64)
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        if not len(words):
            continue
        g = runs.repair(words, owner)

        def expand(symbol):
            if symbol < g.base:
                return [symbol]
            return expand(g.left[symbol - g.base]) + expand(g.right[symbol - g.base])

        assert [w for s in g.start for w in expand(s)] == words.tolist()
        for k in range(len(g.left)):
            part = expand(g.base + k)
            assert words[g.first[k]:g.first[k] + len(part)].tolist() == part
        # no pair is left that stands in two places apart
        places = {}
        for i in range(len(g.start) - 1):
            if owner[g.place[i]] == owner[g.place[i + 1]]:
                places.setdefault((g.start[i], g.start[i + 1]), []).append(i)
        assert all(p[-1] - p[0] < 2 for p in places.values())


def test_equal_hashes_are_only_proposals(monkeypatch):
    # every gram hashes alike: lengths are proposed too long, the words decide
    monkeypatch.setattr(runs.Grams, "of", lambda self, at, length: np.zeros(np.shape(at), np.uint64))
    rng = random.Random(5)
    for _ in range(30):
        words = random_document(rng)[:150]
        got = runs.group_runs(np.array(words, np.int64), np.array([0, len(words)]))
        assert [(s, e - s, q) for s, e, q in got] == slow_runs(words)


ROWS = [
    (1, "a b a b a b a b c", "x"),
    (2, None, "x"),
    (3, "", "x"),
    (4, " \n\t ", None),
    (5, "z z z z z", "five are too few"),
    (6, "z z z z z z", "x"),
    (6, "z z z z z z", "x"),
    (None, "q q q q q q q", "no key"),
    (7, "A a A a A a A a", "case counts"),
    (8, "n b n b n b n b n b n b", "no-break space belongs to a word"),
]


def test_odd_rows_and_clashing_names(spark):
    frame = spark.createDataFrame(ROWS, "doc_id bigint, text string, runs string")
    got = runs.document_runs(frame)
    assert got.columns == ["doc_id", "runs", "n_words", "_runs", "kept_text"]
    told = {(r["doc_id"], r["runs"]): r for r in got.collect()}
    assert got.count() == len(ROWS)
    plain = {k: ([tuple(x) for x in r["_runs"]], r["n_words"], r["kept_text"]) for k, r in told.items()}
    assert plain[1, "x"] == ([(0, 8, 2)], 9, "a b c")
    assert plain[2, "x"] == ([], 0, None) and plain[3, "x"] == ([], 0, "") and plain[4, None] == ([], 0, "")
    assert plain[5, "five are too few"] == ([], 5, "z z z z z")
    assert plain[6, "x"] == ([(0, 6, 1)], 6, "z") and plain[None, "no key"] == ([(0, 7, 1)], 7, "q")
    assert plain[7, "case counts"] == ([(0, 8, 2)], 8, "A a")
    assert plain[8, "no-break space belongs to a word"] == ([(0, 6, 1)], 6, "n b")
    assert runs.document_runs(frame.limit(0)).collect() == []


def test_a_very_long_document_among_short_ones(spark):
    rng = random.Random(6)
    block = [f"w{rng.randrange(9000)}" for _ in range(30_000)]
    long = block * 5 + ["end"] + ["x"] * 100_000
    rows = [(i, "k l m", None) for i in range(20)] + [(99, " ".join(long), None)]
    got = {r["doc_id"]: r for r in runs.document_runs(spark.createDataFrame(rows, "doc_id bigint, text string, e string")).collect()}
    assert [tuple(r) for r in got[99]["runs"]] == [(0, 150_000, 30_000), (150_001, 100_000, 1)]
    assert got[99]["kept_text"] == " ".join(block + ["end", "x"]) and got[5]["kept_text"] == "k l m"


def expected_row(doc_id, text):
    words = runs.WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = [(d, " ".join(f"t{w}" for w in random_document(rng))) for d in range(260)] + [(900, None), (901, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected_row(*r) for r in rows)
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10


def test_documents_of_a_group_do_not_touch_each_other():
    rng = random.Random(8)
    texts = [[f"t{w}" for w in random_document(rng)] for _ in range(40)]
    assert [r for t in texts for r in runs._told([t], 6)] == list(runs._told(texts, 6))
