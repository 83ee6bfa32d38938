"""Source divergence audit by one-hot level products.

Documents are grouped by language and source. A term's count in a group is its level there; a level is one indicator
column of the group, with a 1 for every term that has it. The transpose of the indicators times the indicators counts, for any
two groups, the terms of each pair of levels: all joint tables of a language at once. The terms are cut into blocks, and sources
into tiles of at most ``TILE`` sources; each (block, tile, tile) is a task that multiplies its indicators, prices every
cell of its joint tables once, and hands on one sum per pair of groups. Nothing is paired term by term.

A group's share of a term is ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, ``N`` the group's counted terms and ``V`` the
language's kept terms; two groups diverge on it by ``floor((p - q)^2 / (p + q))``. All of it is integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch

# fixed values: a term is a run of ASCII letters and characters beyond ASCII; only A-Z are lower-cased
TERM_PATTERN = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
MIN_DOCS = 10
TOP_TERMS = 10
# counted (document, term) pairs a Python worker holds, and distinct groups and terms of them
HELD_TERMS = 200_000
# sources of a tile and (group, term) rows of a block: a task's matrices are bounded by both
TILE = 64
BLOCK_ROWS = 100_000
# terms and columns of one matrix product
SLAB_TERMS = 128
SLAB_COLUMNS = 1024


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term and documents with it, in parts that add up. Every
    group that occurs has a row with a null term that counts its documents. Null texts, languages and sources are ''."""
    blank = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang), blank).alias("lang"), F.coalesce(F.col(source), blank).alias("source"),
                       F.coalesce(F.col(text), blank).alias("text"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        terms = re.compile(TERM_PATTERN)
        held: dict[tuple[str, str], tuple[Counter, Counter, list[int]]] = {}
        room = HELD_TERMS
        for part in parts:
            langs, sources = part.column(0).to_pylist(), part.column(1).to_pylist()
            for i, group in enumerate(zip(langs, sources)):
                t = part.column(2)[i].as_py()
                found = Counter(terms.findall(t.encode("utf-8").lower().decode("utf-8")))  # bytes lower A-Z alone
                if group not in held:
                    held[group] = (Counter(), Counter(), [0])
                many, docs_with, seen = held[group]
                before = len(many)
                many.update(found)
                docs_with.update(found.keys())
                seen[0] += 1
                room -= len(many) - before
                if room < 0:
                    yield from _counted(held)
                    held, room = {}, HELD_TERMS
        yield from _counted(held)

    return rows.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")


def _counted(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (many, docs_with, seen) in held.items():
        terms = [None, *many]
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()),
            "term": pa.array(terms, pa.string()), "n": pa.array([0, *many.values()], pa.int64()),
            "docs": pa.array([seen[0], *[docs_with[t] for t in many]], pa.int64())})


def _share(count: Column | str, total: str = "total", kept: str = "kept") -> Column:
    """``p`` of a count: exact for counts of any size."""
    return F.expr(f"1 + cast({SCALE} as decimal(10, 0)) * (cast({count} as decimal(19, 0)) + 2) div (cast({total} as decimal(19, 0)) + 2 * {kept})")


def _price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def joint_sums(term: np.ndarray, group: np.ndarray, share: np.ndarray, zero: np.ndarray, split: int) -> tuple[np.ndarray, int]:
    """``value[i, j]``, the summed price over the terms here between groups ``i`` and ``j``, and the number of terms.

    ``share`` is a group's share of a term at its level, one row for every term that a group counts; ``zero[g]`` that
    of a term that group ``g`` lacks: such terms are the level 0 of their group, an indicator column like any other. With
    ``split`` > 0 only groups below ``split`` meet groups from ``split`` on.
    """
    groups = len(zero)
    out = np.zeros(groups * groups, np.int64)
    number, names = pd.factorize(term)
    # terms of like shares have levels in common: a slab of them has few columns
    weight = np.bincount(number, weights=share, minlength=len(names))
    place = np.empty(len(names), np.int64)
    place[np.argsort(weight, kind="stable")] = np.arange(len(names))
    t = place[number]
    order = np.argsort(t, kind="stable")
    t, g, p = t[order], group[order], share[order]
    for first in range(0, len(names), SLAB_TERMS):
        size = min(SLAB_TERMS, len(names) - first)
        a, b = np.searchsorted(t, [first, first + size])
        level = np.repeat(zero, size).reshape(groups, size)  # a share stands for its level
        level[g[a:b], t[a:b] - first] = p[a:b]
        owner, flat = np.repeat(np.arange(groups), size), level.ravel()
        order = np.lexsort((flat, owner))
        owners, prices = owner[order], flat[order]
        new = np.r_[True, (prices[1:] != prices[:-1]) | (owners[1:] != owners[:-1])]
        column = np.empty(len(flat), np.int64)
        column[order] = np.cumsum(new) - 1
        owners, prices = owners[new], prices[new]
        column = column.reshape(groups, size)
        middle = int(np.searchsorted(owners, split))  # columns of the left tile come first
        rows = [slice(i, min(i + SLAB_COLUMNS, middle or len(owners))) for i in range(0, middle or len(owners), SLAB_COLUMNS)]
        for one in rows:
            left = _indicators(column, one)
            for j in range(middle or one.start, len(owners), SLAB_COLUMNS):
                two = slice(j, min(j + SLAB_COLUMNS, len(owners)))
                joint = left.T @ _indicators(column, two)  # counts up to SLAB_TERMS: exact in any float
                x, y = np.nonzero(joint)
                cell = joint[x, y].astype(np.int64) * _price(prices[one][x], prices[two][y])
                gx, gy = owners[one][x], owners[two][y]
                # a slab's sum for two groups is below SLAB_TERMS * 10^9: exact in doubles
                sums = np.bincount(gx * groups + gy, weights=cell, minlength=groups * groups)
                if not middle and two.start != one.start:
                    sums += np.bincount(gy * groups + gx, weights=cell, minlength=groups * groups)
                out += sums.astype(np.int64)
    return out.reshape(groups, groups), len(names)


def _indicators(column: np.ndarray, wanted: slice) -> np.ndarray:
    """The indicator columns ``wanted``: rows are terms, 1 where a group has the term at that level."""
    hot = np.zeros((column.shape[1], wanted.stop - wanted.start), np.float32)
    group, term = np.nonzero((column >= wanted.start) & (column < wanted.stop))
    hot[term, column[group, term] - wanted.start] = 1
    return hot


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
               top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: how far each group of a language is from each other group, summed over all kept terms. Part ``term``:
    the ``top`` terms of a group, of those it uses more than its language does, by their price against the language.
    A language keeps the terms that stand in ``min_docs`` of its documents or more. Ranks count from 1 per group
    and part, value descending, then item by its UTF-8 bytes. Null texts, languages and sources are empty ones; a group
    without kept terms has count 0 of each; a language without kept terms has value 0 for every pair. Repeated rows count
    each. An empty table gives no rows, a language with one source no pairs.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    counts = scratch.table(term_counts(docs, text, lang, source).groupBy("lang", "source", "term")
                           .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_term = Window.partitionBy("lang", "term")  # one row a source
    known = (counts.where("term is not null").withColumn("lang_docs", F.sum("docs").over(of_term))
             .withColumn("lang_n", F.sum("n").over(of_term)).where(F.col("lang_docs") >= min_docs)
             .select("lang", "source", "term", "n", "lang_n"))
    known = scratch.table(known)
    per_lang = known.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    groups = (counts.where("term is null").select("lang", "source")
              .join(known.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("used")), ["lang", "source"], "left")
              .join(per_lang, "lang", "left").fillna(0, ["total", "used", "lang_total", "kept"]))
    groups = scratch.table(groups.withColumn("zero", F.when(F.col("kept") > 0, _share("0"))))
    scratch.drop(counts)

    shares = scratch.table(known.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _share("n").alias("p"), _share("lang_n", "lang_total").alias("q")))
    scratch.drop(known)
    pairs = scratch.table(_pairs(shares, groups, scratch))
    value = F.expr("(p - q) * (p - q) div (p + q)")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return (terms.withColumn("rank", rank).where(F.col("rank") <= top)
            .unionByName(pairs.withColumn("rank", rank)))


def _pairs(shares: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    """``lang, source, part, item, value`` of every two groups of a language."""
    # sources of a language, numbered and cut into tiles (a language's sources go through one window: the result, a
    # row for every two of them, exceeds it by far)
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    tiled = scratch.table(groups.select("lang", "source", "kept", "used", F.coalesce("zero", F.lit(1)).alias("zero"), number.alias("g"))
                          .withColumn("tile", F.expr(f"g div {TILE}").cast("int")))
    cuts = tiled.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"), F.sum("used").alias("rows"))
    cuts = scratch.table(cuts.withColumn("blocks", F.ceil(F.greatest("rows", F.lit(1)) / BLOCK_ROWS).cast("int")).drop("rows"))

    # a tile meets every tile, itself included: (low, high) names the product
    partners = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    product = [F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high")]
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    none = F.lit(None).cast("bigint")
    counted = (shares.join(tiled.select("lang", "source", "g", "tile"), ["lang", "source"]).join(cuts, "lang")
               .select("lang", block, "tile", partners, "g", "term", "p")
               .select("lang", "block", *product, "g", "term", "p", none.alias("zero"), none.alias("kept")))
    # every product needs each group of its tiles, also those that have none of its terms
    members = (tiled.join(cuts, "lang").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
               .select("lang", "block", "tile", partners, "g", "zero", "kept")
               .select("lang", "block", *product, "g", F.lit(None).cast("string").alias("term"), none.alias("p"), "zero", "kept"))

    def price(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["zero"].notna()].sort_values("g")
        rows = frame[frame["zero"].isna()]
        g, zero = own["g"].to_numpy(np.int64), own["zero"].to_numpy(np.int64)
        crossed = frame["low"].iloc[0] != frame["high"].iloc[0]
        split = int((g // TILE == frame["low"].iloc[0]).sum()) if crossed else 0
        value, seen = joint_sums(rows["term"].to_numpy(), np.searchsorted(g, rows["g"].to_numpy(np.int64)),
                                 rows["p"].to_numpy(np.int64), zero, split)
        i, j = np.nonzero((np.arange(len(g))[:, None] < split) & (np.arange(len(g)) >= split) if crossed else ~np.eye(len(g), dtype=bool))
        if crossed:
            i, j, v = np.r_[i, j], np.r_[j, i], np.r_[value[i, j], value[i, j]]
        else:
            v = value[i, j]
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "g": g[i], "h": g[j], "value": v, "seen": seen,
                             "lacked": _price(zero[i], zero[j]), "kept": int(own["kept"].iloc[0])})

    parts = counted.unionByName(members).groupBy("lang", "block", "low", "high").applyInPandas(
        price, "lang string, g int, h int, value bigint, seen bigint, lacked bigint, kept bigint")
    # terms that no group of either tile has are at level 0 in both
    sums = scratch.table(parts.groupBy("lang", "g", "h").agg(
        (F.sum("value") + (F.max("kept") - F.sum("seen")) * F.max("lacked")).alias("value")))
    names = tiled.select("lang", "g", "source")
    return (sums.join(names, ["lang", "g"]).join(names.select("lang", F.col("g").alias("h"), F.col("source").alias("item")), ["lang", "h"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


# the same rows by joins over all terms and groups
DOCUMENTS_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '{TERM_PATTERN}') AS terms
  FROM documents
),
words AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= {MIN_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (
  SELECT DISTINCT docs.lang, docs.source, coalesce(totals.total, 0) AS total, coalesce(langs.v, 0) AS v
  FROM docs LEFT JOIN totals USING (lang, source) LEFT JOIN langs ON langs.lang = docs.lang
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
         1 + ({SCALE}::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
ranked AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM ranked)
WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
