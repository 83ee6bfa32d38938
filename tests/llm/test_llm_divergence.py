"""Source divergence against a plain count of every term in every group."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from graphloom.llm import divergence, queries
from tools.oracle_check import canon, duck

SCHEMA = "doc_id bigint, text string, lang string, source string, rank int"


def plain(rows, min_docs=10, top=10):
    docs = []
    for _, text, lang, source, _ in rows:
        words = re.findall(divergence.TERM_PATTERN, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        docs.append((lang or "", source or "", words))
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(w for d in own for w in set(d[2]))
        kept = {w for w, n in spread.items() if n >= min_docs}
        counts = {None: Counter(w for d in own for w in d[2] if w in kept)}
        for s in {d[1] for d in own}:
            counts[s] = Counter(w for d in own if d[1] == s for w in d[2] if w in kept)
        share = {g: {w: 1 + 10 ** 9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept)) for w in kept} for g, c in counts.items()}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in counts.keys() - {None}:
            pairs = [(sum(f(share[s][w], share[o][w]) for w in kept), o) for o in counts.keys() - {None, s}]
            terms = [(f(share[s][w], share[None][w]), w) for w in kept if counts[s][w] and share[s][w] > share[None][w]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(items, 1) if part == "pair" or r <= top]
    return sorted(out)


def corpus(seed, docs=220, sources=9):
    rng = random.Random(seed)
    rows = []
    for d in range(docs):
        lang = rng.choice(["en", "en", "fr", None, "tiny" if d < 8 else "en"])
        source = rng.choice(["hot", "hot", "hot", None, "", "Ünï", *[f"s{i}" for i in range(sources)]])
        words = [f"{rng.choice(['Tok', 'été', 'x', 'ZZ'])}{'abcdefghij'[min(9, int(rng.expovariate(0.4)))]}" for _ in range(rng.randint(0, 60))]
        rows.append((d, rng.choice([" ", "7", ", ", "\n"]).join(words) if rng.random() > 0.05 else None, lang, source, None))
    rows += [(900 + i, "12 34 !", "en", "wordless", 1) for i in range(2)] + [(950, "alone", "one", "single", 1)]
    return rows


def told(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def test_rows_equal_a_plain_count(spark):
    rows = corpus(1)
    got = divergence.divergence(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert told(got) == plain(rows)


@pytest.mark.parametrize("tile,block,slab,columns", [(1, 7, 3, 2), (2, 50, 16, 5), (4, 10 ** 6, 1, 1024)])
def test_tiles_blocks_and_slabs_of_any_size_give_the_same(spark, monkeypatch, tile, block, slab, columns):
    for name, value in (("TILE", tile), ("BLOCK_ROWS", block), ("SLAB_TERMS", slab), ("SLAB_COLUMNS", columns), ("HELD_TERMS", 20)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus(2, 120, 4)
    assert told(divergence.divergence(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_joint_tables_of_one_block():
    rng = np.random.default_rng(3)
    groups, terms = 5, 40
    shares = rng.integers(1, 9, (groups, terms))
    zero = np.arange(11, 11 + groups)
    has = rng.random((groups, terms)) < 0.5
    has[0] = True
    g, t = np.nonzero(has)
    value, seen = divergence.joint_sums(t, g, shares[g, t], zero, 0)
    full = np.where(has, shares, zero[:, None])
    want = [[sum((a - b) ** 2 // (a + b) for a, b in zip(full[i], full[j])) for j in range(groups)] for i in range(groups)]
    assert seen == terms and (value - np.diag(np.diag(value)) == np.array(want) - np.diag(np.diag(want))).all()


def test_counts_beyond_long_products(spark):
    row = spark.range(1).selectExpr("9000000000000000000 as n", "9100000000000000000 as total", "7L as kept")
    assert row.select(divergence._share("n")).first()[0] == 1 + 10 ** 9 * (9 * 10 ** 18 + 2) // (91 * 10 ** 17 + 14)


def test_empty_and_one_source(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert told(divergence.divergence(empty)) == []
    rows = [(i, "same words here", "en", "only", None) for i in range(12)]
    assert told(divergence.divergence(spark.createDataFrame(rows, SCHEMA))) == plain(rows) == []


def test_sql_on_odd_rows(spark, tmp_path):
    rows = corpus(4)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/d")
    [part] = (tmp_path / "d").glob("*.parquet")
    part.rename(tmp_path / "documents.parquet")
    frame = queries.op11_divergence(spark, str(tmp_path))
    relation = duck(str(tmp_path)).sql(queries.ORACLE_SQL["op11_divergence"])
    assert canon([tuple(r) for r in frame.collect()], frame.columns) == canon(relation.fetchall(), list(relation.columns))
