"""Substring dedup by hashing the sentences of each line.

Texts are cut at line feeds and behind ``.``, ``!`` and ``?``, so that a passage pasted into a line shares its units with its
other places. A sentence of more than ``LONG_UNIT`` words is cut again behind words that a hash picks: the words alone decide,
so the parts inside a passage are the same wherever it stands, though its first and last sentences are joined to other words.
Units are normalised (lower case, white space runs to one blank, trimmed) and digested. Digests are
grouped globally; each keeps its earliest occurrence, by document key and offset. A unit whose digest
has an earlier occurrence is a repeat. Runs of consecutive repeats are told with their words; those of ``min_words`` or more
are removed, and the removed spans keep their offsets in the original text, with the place that was kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch, fresh_name

# words of the shortest run that is removed. A passage of over 50 words whose first and last units are joined to
# other words where it stands again shows at least about this many words of whole units
MIN_WORDS = 40
UNIT = re.compile(r"[^\n.!?]*[.!?]+|[^\n.!?]+")
WORD = re.compile(r"\S+")
# words of the longest sentence that stays whole; words of a longer one's parts: a part ends behind a word that one
# hash in PART_ENDS picks, not before LEAST_PART words and not after MOST_PART
LONG_UNIT, LEAST_PART, MOST_PART, PART_ENDS = 20, 4, 12, 4
# units of a task are numbered within so many bits
UNIT_BITS = 40


def _parts(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Units of a text that have words: start, end (exclusive), lower-case words."""
    for unit in UNIT.finditer(text):
        words = unit.group().lower().split()
        if len(words) <= LONG_UNIT:
            if words:
                yield unit.start(), unit.end(), words
            continue
        ends = [m.end() for m in WORD.finditer(text, unit.start(), unit.end())]
        if len(ends) != len(words):  # lower case has white space that the text has not
            yield unit.start(), unit.end(), words
            continue
        begin, start = 0, unit.start()
        for i, word in enumerate(words, 1):
            n = i - begin
            if i == len(words) or n >= MOST_PART or n >= LEAST_PART and not (zlib.crc32(word.encode("utf-8", "surrogatepass")) >> 9) % PART_ENDS:
                end = unit.end() if i == len(words) else ends[i - 1]
                yield start, end, words[begin:i]
                begin, start = i, end


def line_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, h`` (hash of the whole text), ``at`` (number of the unit in order of key, null last, hash and place), ``line`` (number
    of the unit in its document, from 0), ``start``, ``end`` (characters, end exclusive), ``words``,
    ``d1, d2`` (128-bit digest of the normalised unit). Units have words; null texts have no units. Units of one
    document follow each other in ``at``, those of two never do. Rows that agree in key and text give their units once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("key", "h", "at", "line", "start", "end", "words", "d1", "d2")
        out: dict[str, list] = {c: [] for c in names}
        at, before = TaskContext.get().partitionId() << UNIT_BITS, None
        for part in batches:
            for doc, h, t in zip(part["key"], part["h"], part["text"]):
                if before == (doc, h):
                    continue
                before = doc, h
                keys, hs, ats, numbers, starts, ends, counts, d1, d2 = out.values()
                for n, (start, end, words) in enumerate(_parts(t)):
                    digest = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
                    keys.append(doc), hs.append(h), ats.append(at), numbers.append(n), starts.append(start), ends.append(end)
                    counts.append(len(words)), d1.append(int.from_bytes(digest[:8], "big", signed=True))
                    d2.append(int.from_bytes(digest[8:], "big", signed=True))
                    at += 1
                    if len(hs) > 50_000:
                        yield pd.DataFrame(out)
                        out = {c: [] for c in names}
                        keys, hs, ats, numbers, starts, ends, counts, d1, d2 = out.values()
                at += 1
        if out["h"]:
            yield pd.DataFrame(out)

    kind = dict(docs.dtypes)[key]
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    # rows of one document lie side by side, and the numbers that tasks give are in order
    order = [F.col("key").asc_nulls_last(), F.col("h")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    if kind in ("tinyint", "smallint", "int", "bigint"):  # a null would turn such a column into doubles
        rows, kind = rows.withColumn("key", F.col("key").cast("string")), "string"
    return rows.mapInPandas(run, f"key {kind}, h bigint, at bigint, line int, start int, end int, words int, d1 bigint, d2 bigint")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of repeated units: ``key, text_hash, start, end, n_lines`` (units), ``n_words, kept_<key>, kept_start``.

    ``min_words`` leaves out shorter runs; 1 tells every repeat. Occurrences rank by key (null last), text hash, start.
    ``kept_*`` is the kept place of the run's first unit. White space and empty lines between units do not end a run.
    Rows that agree in key and text are one document, so they do not repeat each other. Null and empty texts have no spans,
    nor has an empty table.
    """
    scratch = Scratch(docs.sparkSession, "linehash")
    kind = docs.schema[key].dataType
    lines = scratch.table(line_units(docs, key, text))
    firsts = scratch.table(lines.groupBy("d1", "d2").agg(F.min("at").alias("first"), F.max("at").alias("latest"))
                           .where("first <> latest").select("d1", "d2", "first"))
    repeats = (lines.select("d1", "d2", "at", "line", "start", "end", "words").join(firsts, ["d1", "d2"]).where("at <> first")
               .select((F.col("at") - F.col("line")).alias("doc"), "line", "start", "end", "words", "first"))
    # runs of consecutive units: within a document the difference of number and rank is constant
    in_doc = Window.partitionBy("doc").orderBy("line")
    runs = repeats.withColumn("run", F.col("line") - F.row_number().over(in_doc))
    spans = runs.groupBy("doc", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_lines"),
        F.sum("words").alias("n_words"), F.min_by("first", "line").alias("first"))
    wanted = scratch.table(spans.where(F.col("n_words") >= min_words).drop("run"))
    scratch.drop(firsts)
    own = lines.where("line = 0").select(F.col("at").alias("doc"), F.col("key").cast(kind).alias("own_key"), "h")
    kept = (lines.join(wanted.select("first").distinct(), F.col("at") == F.col("first"))
            .select("first", F.col("key").cast(kind).alias("kept_key"), F.col("start").alias("kept_start")))
    return wanted.join(own, "doc").join(kept, "first").select(
        F.col("own_key").alias(key), F.col("h").alias("text_hash"), F.col("start").cast("bigint"), F.col("end").cast("bigint"), "n_lines",
        "n_words", F.col("kept_key").alias(f"kept_{key}"), F.col("kept_start").cast("bigint"))


def without_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text`` and a column ``kept_spans``: the parts that
    stay, each with its ``start`` and ``end`` in the original text. Null texts stay null."""
    scratch = Scratch(docs.sparkSession, "linehash-cut")
    k, h, gone, kept = (fresh_name(docs.columns, n) for n in ("_key", "_hash", "_gone", "kept_spans"))
    spans = repeated_spans(docs, key, text, min_words)
    cuts = scratch.table(spans.groupBy(F.col(key).alias(k), F.col("text_hash").alias(h))
                         .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(gone)))  # of one document
    rows = docs.withColumn(h, F.xxhash64(text))
    joined = rows.join(cuts, rows[key].eqNullSafe(cuts[k]) & (rows[h] == cuts[h]), "left")

    spans_out = F.coalesce(cuts[gone], F.array().cast("array<struct<start:bigint,end:bigint>>"))
    whole = F.char_length(rows[text]).cast("bigint")
    zero = F.array(F.lit(0).cast("bigint"))
    # a span of whole lines takes its last line feed along; a part ends before the next span
    at = lambda i: F.substring(rows[text], i.cast("int") + 1, F.lit(1))
    lines = lambda c: ((c["start"] == 0) | (at(c["start"] - 1) == "\n")) & (at(c["end"]) == "\n")
    begins = F.concat(zero, F.transform(spans_out, lambda c: c["end"] + F.when(lines(c), 1).otherwise(0)))
    ends = F.concat(F.transform(spans_out, lambda c: c["start"]), F.array(whole))
    parts_kept = F.filter(F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("start"), e.alias("end"))), lambda s: s["end"] > s["start"])
    stay = F.when(rows[text].isNotNull(), parts_kept)

    parts = joined.select(*[rows[c] for c in docs.columns], stay.alias(kept))
    pieces = F.transform(kept, lambda s: F.substring(F.col(text), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))
    return parts.withColumn(text, F.array_join(pieces, ""))
