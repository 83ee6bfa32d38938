"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; bit k is 1 if more than half of the hashes of the text's word
shingles have bit k. Two fingerprints link when they differ in ``distance`` bits or fewer.
The fingerprint is cut into ``segments`` parts. By the pigeonhole rule linked
fingerprints differ in at most ``distance // segments`` bits of some part, so each looks up a
small Hamming ball around each of its parts in the table of parts. Whole distances are
verified in the join. Equal fingerprints are one class from the start, so copies are
never paired with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from graphloom.llm.common import Scratch, fresh_name, release_memory
from graphloom.llm.components import connected_components

# fixed values: word shingle length, bits that may differ, seed of the shingle hash
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
HASH_SEED = 42
BITS = 64
# shingles counted at once: bounds the memory of a very long text (64 bytes a shingle)
COUNT_BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit fingerprint; 0 for a null text or one without words."""
    if text is None:
        return 0
    # bytes: lower() changes A-Z only, split() cuts at ASCII white space only
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: 1 - width or None], ends[width - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), COUNT_BLOCK):
        spans = zip(starts[at:at + COUNT_BLOCK].tolist(), ends[at:at + COUNT_BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(major.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", width: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` without ``text``, with the fingerprint of each whole text as a long."""
    rest = [f for f in docs.schema.fields if f.name != text]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = part.drop(columns=[text])
            out[name] = np.fromiter((fingerprint(t, width) for t in part[text]), np.int64, len(part))
            yield out
        release_memory()

    return docs.select(*[f.name for f in rest], text).mapInPandas(
        run, StructType([*rest, StructField(name, LongType())]))


def flip_masks(bits: int, radius: int) -> list[tuple[int, int]]:
    """(mask, its highest bit) of all sets of 1 to ``radius`` bits."""
    return [(sum(1 << i for i in c), 1 << max(c)) for r in range(1, radius + 1) for c in combinations(range(bits), r)]


def linked_fingerprints(fps: DataFrame, distance: int = MAX_DISTANCE, segments: int = 2) -> DataFrame:
    """Edges ``(a, b)`` of the distinct fingerprints ``fps (fp)`` at most ``distance`` apart.

    Of two parts that differ in some bits, one has a 0 at the highest of them: only that one
    looks up the other, which halves the lookups. Equal parts meet once, in value order.
    """
    cuts = [BITS * i // segments for i in range(segments + 1)]
    entries, probes = [], []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        key = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        part = fps.select(F.lit(i).alias("seg"), key.alias("key"), "fp")
        entries.append(part)
        masks = flip_masks(hi - lo, distance // segments)
        flips = F.array(*[F.struct(F.lit(m).cast("bigint").alias("mask"), F.lit(top).cast("bigint").alias("top"))
                          for m, top in masks]) if masks else None
        probes.append(part.select("seg", "key", "fp", F.lit(False).alias("flipped")))
        if flips is not None:
            wanted = F.filter(flips, lambda f: F.col("key").bitwiseAND(f["top"]) == 0)
            balls = part.select("seg", "key", "fp", F.explode(wanted).alias("f"))
            probes.append(balls.select("seg", F.col("key").bitwiseXOR(F.col("f.mask")).alias("key"), "fp",
                                       F.lit(True).alias("flipped")))
    index = entries[0]
    for e in entries[1:]:
        index = index.unionByName(e)
    probe = probes[0]
    for p in probes[1:]:
        probe = probe.unionByName(p)
    index, probe = index.alias("i"), probe.alias("p")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("i.fp"))) <= distance
    once = F.col("p.flipped") | (F.col("p.fp") < F.col("i.fp"))
    same_part = (F.col("p.seg") == F.col("i.seg")) & (F.col("p.key") == F.col("i.key"))
    return probe.join(index, same_part & near & once).select(F.col("p.fp").alias("a"), F.col("i.fp").alias("b"))


def fingerprint_roots(prints: DataFrame, scratch: Scratch, distance: int, segments: int) -> DataFrame:
    """``(fp, root)`` of every distinct ``fp`` of ``prints``: equal roots are linked."""
    classes = scratch.table(prints.select("fp").distinct())
    edges = scratch.table(linked_fingerprints(classes, distance, segments))
    roots = connected_components(edges, scratch)
    out = scratch.table(classes.join(roots, classes["fp"] == roots["id"], "left")
                        .select("fp", F.coalesce("root", "fp").alias("root")))
    scratch.drop(classes, edges, roots)
    return out


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
                   distance: int = MAX_DISTANCE, segments: int = 2) -> DataFrame:
    """Each row of ``docs`` (all columns but ``text``) with ``fp`` and ``component_id``.

    ``component_id`` is the smallest ``key`` of all rows whose fingerprints can be reached
    by links. A null or empty text has fingerprint 0, which links like any other. Rows that
    repeat are rows of one class. A null ``key`` is never the smallest, unless the group has
    no other (then null). An empty table gives no rows. A column of the input that is called
    like a result column keeps its name; the result column gets a leading underscore.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    rest = [c for c in docs.columns if c != text]
    fp, comp = fresh_name(rest, "fp"), fresh_name(rest, "component_id")
    prints = scratch.table(with_fingerprints(docs, text, fp, width))
    least = prints.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("first_key"))
    roots = fingerprint_roots(prints.select(F.col(fp).alias("fp")), scratch, distance, segments)
    rooted = scratch.table(roots.join(least, "fp").select("fp", "root", "first_key"))
    heads = rooted.groupBy("root").agg(F.min("first_key").alias("least"))
    found = scratch.table(rooted.join(heads, "root").select("fp", "least"))
    scratch.drop(roots, rooted)
    out = prints.join(found, prints[fp] == found["fp"])
    return out.select(*[prints[c] for c in rest], prints[fp], found["least"].alias(comp))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS,
             distance: int = MAX_DISTANCE, segments: int = 2) -> DataFrame:
    """``docs`` with one row of each SimHash group: the one with the smallest ``key``.

    A null ``key`` comes last. Rows of one key are told apart by a hash of their text; of rows
    that agree in both, one stays. Texts travel once, to the join that keeps them.
    """
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    slim = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    prints = scratch.table(with_fingerprints(slim, "t", "fp", width))
    classes = prints.groupBy("fp").agg(F.min(F.struct(F.col("k").isNull().alias("last"), "k", "h")).alias("best"))
    roots = fingerprint_roots(prints.select("fp"), scratch, distance, segments)
    best = roots.join(classes, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.k", "best.h")
    rows = prints.groupBy("k", "h").agg(F.count(F.lit(1)).alias("rows"))
    heads = scratch.table(best.join(rows, best["k"].eqNullSafe(rows["k"]) & (best["h"] == rows["h"]))
                          .select(best["k"], best["h"], "rows"))
    scratch.drop(prints, roots)

    def picked(some: DataFrame) -> DataFrame:
        same = docs[key].eqNullSafe(some["k"]) & (F.xxhash64(docs[text]) == some["h"])
        return docs.join(some, same, "left_semi")

    hash_name = fresh_name(docs.columns, "_text_hash")
    repeated = (picked(heads.where("rows > 1")).withColumn(hash_name, F.xxhash64(text))
                .dropDuplicates([key, hash_name]).drop(hash_name))
    return picked(heads.where("rows = 1")).unionByName(repeated)
