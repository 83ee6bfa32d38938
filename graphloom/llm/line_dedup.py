"""Line dedup by an exact set-similarity join with prefix, positional and length filters.

A line is the set of its words (A-Z lower-cased). Lines with equal sets are one class, first met
at its earliest occurrence. Words are put in order of rarity, from counts over all lines in a
table of fixed size; the order is total, so the prefix filter loses no pair. Classes meet in the
groups of their prefix words. There the length filter, the positional filter and a parity bitmap (each
word flips one of 128 bits, so lines differ in at least as many words as their bitmaps do in bits) leave
few pairs, and these are verified on the words themselves. A line goes if an earlier line has
Jaccard similarity ``MIN_JACCARD`` or more.

One verified earlier partner settles a class. So each class names a few of its earliest and nearest
partners in a group, the nearest of all is verified first, and the others only where that one fails: all its
partners, if the class had more than it named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import Scratch, fresh_name, release_memory

MIN_JACCARD = 0.8
# cells of the word count table, and of a piece of it that tasks add up; most postings of one block of a prefix word's group; postings that
# go to a task together
COUNT_CELLS, COUNT_PIECE, GROUP_ROWS, TASK_ROWS = 1 << 18, 1 << 12, 1024, 100_000
# bytes of text handled at once in a Python worker: bounds its memory (one longer line is a block alone), and with it the
# lines with words of a block, two bytes each at least (a line's number takes LINE_BITS)
BATCH_BYTES, LINE_BITS = 390_000, 18
BATCH_LINES = BATCH_BYTES // 2 + 1
# candidate pairs compared at once
PAIRS = 500_000
# partners named by a class in one group at first, half of them earliest, half nearest
PARTNERS = 8
# longest word, in bytes, that is hashed with the others; classes already handed on that a Python worker remembers
LONGEST_HASHED, REMEMBERED_CLASSES = 64, 150_000
# marks by which a task knows the prefix words that it has handed on (a prime; words that share one are counted once more)
MARKS = 4_194_301
# stands for a null key, which comes last
NULL_KEY = (1 << 63) - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)
CELL_SHIFT = np.uint64(64 - COUNT_CELLS.bit_length() + 1)
# white space as ``bytes.split`` knows it, by byte; masks of a word's first bytes in a 64-bit number
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of ``text`` (A-Z lower-cased), its 64-bit hash, its first byte and the number of its line."""
    text = text.lower() + b"\n" * 8
    codes = np.frombuffer(text, np.uint8)
    space = _SPACE[codes]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    lengths = ends - starts
    # eight bytes from each place on, as one number
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=(1,)).copy()
    hashes = _mixed(eight[starts] & _FIRST[np.minimum(lengths, 8)] ^ lengths.astype(np.uint64) * _ODD)
    more = np.flatnonzero(lengths > 8)
    for at in range(8, LONGEST_HASHED, 8):
        if not len(more):
            break
        next_ = eight[starts[more] + at] & _FIRST[np.minimum(lengths[more] - at, 8)]
        hashes[more] = _mixed(hashes[more] * _ODD ^ next_)
        more = more[lengths[more] > at + 8]
    for i in more.tolist():
        hashes[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]])
    return hashes, starts, np.searchsorted(np.flatnonzero(codes == 10), starts)


# a line's word set: a sum over its words, the halves of its bitmap, its number of words
CLASS = ["c1", "sig", "sag", "size"]
EARLIER = [f"{c}2" for c in CLASS]


class _Block:
    """The lines with words of some parts of documents (``doc, h, number of the first line, text``), as columns: one entry
    per line, and the distinct words of all lines one after another as ``hashes``."""

    def __init__(self, parts: list[tuple]):
        hashes, _, row = _words(b"\n".join(p[3] for p in parts))
        fresh = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.empty(0, bool)
        rows, at = row[fresh], np.cumsum(fresh) - 1  # lines with words; each word's line among them
        # a line's words in order of their hashes, each once
        key = (at.astype(np.uint64) << np.uint64(64 - LINE_BITS)) | (hashes >> np.uint64(LINE_BITS))
        order = np.argsort(key)
        ordered, key = hashes[order], key[order]
        once = np.concatenate(([True], key[1:] != key[:-1]))[:len(key)]
        if (ordered[1:] != ordered[:-1])[~once[1:]].any():  # the key told two words of a line alike
            order = np.lexsort((hashes, at))
            ordered, at = hashes[order], at[order]
            once = np.concatenate(([True], (ordered[1:] != ordered[:-1]) | (at[1:] != at[:-1])))
        else:
            at = at[order]
        self.hashes = ordered[once]
        self.size = np.bincount(at[once], minlength=len(rows))
        self.starts = np.cumsum(self.size) - self.size
        # the part of each line, and its number in the document
        lines = np.array([p[3].count(b"\n") + 1 for p in parts], np.int64)
        begins = np.cumsum(lines) - lines
        part = np.searchsorted(begins, rows, side="right") - 1
        self.doc, self.h, first = (np.array([p[i] for p in parts], np.int64)[part] for i in range(3))
        self.line = first + rows - begins[part]
        self.cells = (self.hashes >> CELL_SHIFT).astype(np.int64)
        # what names a line's set: a sum over its words, and its parity bitmap
        mixed = (self.hashes ^ (self.hashes >> np.uint64(29))) * _ODD
        bits = np.uint64(1) << (self.hashes & np.uint64(63))
        half = (self.hashes & np.uint64(64)) > 0
        none = np.empty(0, np.int64)
        self.c1 = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), self.starts).view(np.int64) if len(rows) else none
        self.sig = np.bitwise_xor.reduceat(np.where(half, bits, 0), self.starts).view(np.int64) if len(rows) else none
        self.sag = np.bitwise_xor.reduceat(np.where(half, 0, bits), self.starts).view(np.int64) if len(rows) else none
        # a document's first line with words, where no part before had one
        self.head = np.concatenate(([True], part[1:] != part[:-1]))[:len(rows)] & ~np.array([p[4] for p in parts], bool)[part]


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Documents (``doc, h, text``) in lists of ``BATCH_BYTES`` at most: ``doc, h, number of the first line, text, whether
    an earlier part has words``. A long document is cut at line feeds; one longer line comes alone."""
    held, size = [], 0
    for batch in batches:
        for doc, h, text in zip(batch["doc"].tolist(), batch["h"].tolist(), batch["text"]):
            if text is None:
                continue
            text = text.encode("utf-8", "surrogatepass")
            at, line, begun = 0, 0, False
            while at <= len(text):
                end = len(text)
                if end - at > BATCH_BYTES:
                    end = text.rfind(b"\n", at, at + BATCH_BYTES)
                    if end < 0:  # no line ends before
                        end = text.find(b"\n", at)
                        end = len(text) if end < 0 else end
                piece = text[at:end]
                if held and size + len(piece) + 1 > BATCH_BYTES:
                    yield held
                    held, size = [], 0
                held.append((doc, h, line, piece, begun))
                size += len(piece) + 1
                if end < len(text):
                    line += piece.count(b"\n") + 1
                    begun = begun or bool(piece.strip())
                at = end + 1
    if held:
        yield held


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[_Block]:
    """Documents (``doc, h, text``) as blocks of ``BATCH_BYTES`` of text; a long document goes on in the next block."""
    for parts in _parts(batches):
        block = _Block(parts)
        if len(block.size):
            yield block
    release_memory()


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc`` (key, null as ``NULL_KEY``), ``h`` (hash of the text), ``text``: what names a document."""
    return docs.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)).alias("doc"), F.xxhash64(text).alias("h"),
                       F.col(text).alias("text"))


def _packed(counts: np.ndarray) -> bytes:
    """``counts`` in the narrowest type that holds the largest: a task's counts are mostly small, and one task adds up
    a row of every task."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(n: bytes, counts: int) -> np.ndarray:
    width = len(n) // counts
    return np.frombuffer(n, f"u{width}" if width < 8 else np.int64)


def _word_counts(docs: DataFrame) -> DataFrame:
    """Rows ``piece, n``: occurrences of the words of all texts by the count table's cells, ``COUNT_PIECE`` cells a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = np.zeros(COUNT_CELLS, np.int64)
        for parts in _parts(part.assign(doc=0, h=0) for part in batches):
            hashes, _, _ = _words(b"\n".join(p[3] for p in parts))
            cells += np.bincount((hashes >> CELL_SHIFT).astype(np.int64), minlength=COUNT_CELLS)
        release_memory()
        pieces = cells.reshape(-1, COUNT_PIECE)
        yield pd.DataFrame({"piece": np.arange(len(pieces)), "n": [_packed(p) for p in pieces]})

    def add(pieces: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(COUNT_PIECE, np.int64)
        for n in pieces["n"]:
            total += _unpacked(n, COUNT_PIECE)
        release_memory()
        return pd.DataFrame({"piece": pieces["piece"][:1], "n": [total.tobytes()]})

    schema = "piece bigint, n binary"
    return docs.select("text").mapInPandas(run, schema).groupBy("piece").applyInPandas(add, schema)


def _prefixes(docs: DataFrame, ranks, min_jaccard: float) -> DataFrame:
    """One row per line with words: its place, class, ``head`` (first of its document), prefix words, rarest first, their
    number ``posts`` and those of them, ``met``, that the task has handed on before: all but one posting a task and word.

    ``ranks`` is the broadcast order of the word count table's cells. Words of one cell are in order of their
    hashes; a word is told by 32 bits of this order (words that share them only meet in vain). The prefix is null
    where the worker has handed on the class before, for an earlier place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        marks = np.zeros(MARKS, bool)
        seen: dict[tuple, tuple] = {}
        for b in _blocks(part.to_pandas() for part in batches):
            assert len(b.size) < 1 << LINE_BITS, "a line's number would lose its highest bits"
            at = np.repeat(np.arange(len(b.size), dtype=np.uint64), b.size)
            low = b.hashes & np.uint64((1 << 28) - 1)
            order = np.sort((at << np.uint64(64 - LINE_BITS)) | (table[b.cells] << np.uint64(28)) | low)
            length = b.size - np.ceil(min_jaccard * b.size - 1e-9).astype(np.int64) + 1
            if len(seen) > REMEMBERED_CLASSES:
                seen.clear()
            fresh = np.zeros(len(b.size), bool)
            names = zip(b.c1.tolist(), b.sig.tolist(), b.sag.tolist(), b.size.tolist())
            for i, (name, place) in enumerate(zip(names, zip(b.doc.tolist(), b.line.tolist(), b.h.tolist()))):
                if name not in seen or place < seen[name]:
                    seen[name] = place
                    fresh[i] = True
            pos = np.arange(len(order)) - np.repeat(b.starts, b.size)
            length = np.where(fresh, length, 0)
            taken = order[pos < np.repeat(length, b.size)]
            words = taken.astype(np.uint32).view(np.int32)
            # the first posting of its mark in this block, where no block before had one
            mark = words.view(np.uint32) % np.uint32(len(marks))
            known = np.ones(len(mark), bool)
            known[np.unique(mark, return_index=True)[1]] = False
            known |= marks[mark]
            marks[mark] = True
            upto = np.concatenate(([0], np.cumsum(known)))
            offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            columns = [pa.array(getattr(b, c)) for c in names_out]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(words), mask=pa.array(~fresh)))
            columns.append(pa.array(length.astype(np.int32)))
            columns.append(pa.ListArray.from_arrays(pa.array(upto[offsets].astype(np.int32)), pa.array(words[known])))
            yield pa.RecordBatch.from_arrays(columns, names=[*names_out, "prefix", "posts", "met"])

    names_out = ["doc", "line", "h", *CLASS, "head"]
    return docs.mapInArrow(run, "doc bigint, line bigint, h bigint, c1 bigint, sig bigint, sag bigint, size bigint, "
                                "head boolean, prefix array<int>, posts int, met array<int>")


def _partners(min_jaccard: float, limit: int | None):
    """Within the block pairs of a group of prefix words: each class's earlier partners that pass the
    filters, for open classes; ``more`` where a class has others besides those named (``limit`` None: all)."""
    factor = min_jaccard / (1 + min_jaccard)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        col = {c: group[c].to_numpy() for c in group.columns}
        # one row per class and word: its first place (a word's cell: word and block pair)
        line = col["line"].astype(np.uint16) if col["line"].max(initial=0) < 1 << 16 else col["line"]
        place = (line, col["doc"], col["c1"])
        if col["hi"].any():
            order = np.lexsort((*place, col["size"], col["hi"], col["lo"], col["word"]))
        else:  # a line has less than 2^31 words
            order = np.lexsort((*place, (col["word"].astype(np.int64) << 31) | col["size"]))
        col = {c: v[order] for c, v in col.items()}
        change = lambda names: np.concatenate(([True], np.any([col[c][1:] != col[c][:-1] for c in names], axis=0)))
        fresh = change(["word", "lo", "hi", *CLASS])
        cell = np.cumsum(change(["word", "lo", "hi"]))[fresh]
        col = {c: v[fresh] for c, v in col.items()}  # in order of cell and size
        n = len(cell)
        size, pos, block = col["size"], col["pos"], col["block"]
        sig, sag = col["sig"].view(np.uint64), col["sag"].view(np.uint64)
        rank = np.empty(n, np.int64)
        rank[np.lexsort((col["c1"], line[order][fresh], col["doc"]))] = np.arange(n)
        # partners of row i: rows before it in its cell whose size is at least min_jaccard of its own
        wide = int(size.max(initial=0)) + 1
        low = np.searchsorted(cell * wide + size, cell * wide + np.ceil(min_jaccard * size - 1e-9).astype(np.int64))
        many = np.maximum(np.arange(n) - low, 0)
        open_ = col["open"].astype(bool)
        # whole cells at a time, of about PAIRS candidate pairs: a cell has 2 * GROUP_ROWS rows at most
        ends = np.append(np.nonzero(cell[1:] != cell[:-1])[0] + 1, n)
        upto, at, out = np.cumsum(many), 0, []
        while at < n:
            reach = np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")
            end = max(ends[np.searchsorted(ends, at, side="right")], ends[max(np.searchsorted(ends, reach, side="right") - 1, 0)])
            i = np.repeat(np.arange(at, end), many[at:end])
            j = np.arange(len(i)) - np.repeat(np.cumsum(many[at:end]) - many[at:end], many[at:end]) + low[i]
            at = end
            bits = np.bitwise_count(sig[i] ^ sig[j]).astype(np.int64) + np.bitwise_count(sag[i] ^ sag[j])
            both = size[i] + size[j]
            need = np.ceil(factor * both - 1e-9).astype(np.int64)
            ok = (bits <= both - 2 * need) & (np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need)
            # pairs inside one of two blocks meet elsewhere
            ok &= (col["lo"][i] == col["hi"][i]) | (block[i] != block[j])
            i, j, apart = i[ok], j[ok], bits[ok]
            # a class whose rows stand apart, between those of another with the same sum, is no pair
            other = np.any([col[c][i] != col[c][j] for c in CLASS], axis=0)
            i, j, apart = i[other], j[other], apart[other]
            flip = rank[i] < rank[j]
            l, e = np.where(flip, j, i), np.where(flip, i, j)
            l, e, apart = l[open_[l]], e[open_[l]], apart[open_[l]]
            if not len(l):
                continue
            order = np.lexsort((rank[e], l))
            l, e, apart = l[order], e[order], apart[order]
            more = np.zeros(len(l), bool)
            if limit is not None:
                first = np.arange(len(l)) - np.searchsorted(l, l)  # nth earliest of its class here
                close = np.empty(len(l), np.int64)
                close[np.lexsort((rank[e], apart, l))] = first
                more = np.bincount(l)[l] > limit
                take = ~more | (first < limit // 2) | (close < limit // 2)
                l, e, apart, more = l[take], e[take], apart[take], more[take]
            out.append((l, e, apart, more))
        l, e, apart, more = (np.concatenate(x) for x in zip(*out)) if out else [np.empty(0, np.int64)] * 3 + [np.empty(0, bool)]
        found = {c: col[c][l] for c in CLASS} | {f"{c}2": col[c][e] for c in CLASS}
        told = pd.DataFrame({**found, "apart": apart, "more": more}).drop_duplicates()
        del group, col, order, fresh, rank, out, found, line, place
        release_memory()
        return told

    return run


def _similar(min_jaccard: float):
    @F.pandas_udf("boolean")
    def similar(one: pd.Series, other: pd.Series) -> pd.Series:
        def words(line: bytes) -> set[bytes]:
            return set(line.lower().split())

        def enough(a: set, b: set) -> bool:
            shared = len(a & b)
            return shared >= min_jaccard * (len(a) + len(b) - shared) - 1e-9

        return pd.Series([enough(words(a), words(b)) for a, b in zip(one, other)], dtype=bool)

    return similar


def _picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents ``text`` with ``wants`` (line numbers and classes), each wanted line as ``t``; a text is cut once."""
    for batch in batches:
        wants = batch["wants"].flatten()
        line, at, found = wants.field("line").to_numpy(), 0, []
        for text, n in zip(batch["text"], batch["wants"].value_lengths().to_pylist()):
            parts = text.as_buffer().to_pybytes().split(b"\n")
            found.extend(parts[i] for i in line[at:at + n])
            at += n
        yield pa.RecordBatch.from_arrays([*[wants.field(c) for c in CLASS], pa.array(found, pa.binary())], names=[*CLASS, "t"])


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, scratch: Scratch, min_jaccard: float) -> DataFrame:
    """The later classes of those pairs whose word sets have Jaccard similarity ``min_jaccard`` or more."""
    wanted = pairs.select(*CLASS).unionByName(pairs.select(*[F.col(a).alias(c) for a, c in zip(EARLIER, CLASS)])).distinct()
    places = wanted.join(firsts, CLASS).select(*CLASS, "first.doc", "first.h", "first.line")
    # the lines wanted of one document, however many classes begin in it
    by_doc = places.groupBy("doc", "h").agg(F.collect_list(F.struct("line", *CLASS)).alias("wants"))
    told = docs.join(by_doc, ["doc", "h"]).select("text", "wants")
    # rows that agree in key and text are one document: its lines are read from one of them
    sets = scratch.table(told.mapInArrow(_picked, ", ".join(f"{c} bigint" for c in CLASS) + ", t binary").dropDuplicates(CLASS))
    other = sets.select(*[F.col(c).alias(a) for a, c in zip(EARLIER, CLASS)], F.col("t").alias("t2"))
    both = pairs.select(*CLASS, *EARLIER).join(sets, CLASS).join(other, EARLIER)
    out = scratch.table(both.where(_similar(min_jaccard)("t", "t2")).select(*CLASS).distinct())
    scratch.drop(sets)
    return out


def _repeated_classes(docs: DataFrame, lines: DataFrame, scratch: Scratch, min_jaccard: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """Each class with its first place, and the classes that have an earlier similar class."""
    lines = lines.where("prefix is not null").drop("head").withColumn("open", F.lit(True))
    pairs = _named_partners(lines, None, scratch, min_jaccard, limit)
    # a worker hands on the earliest place of a class that it meets, so the first of all is among these rows
    firsts = scratch.table(lines.groupBy(*CLASS).agg(F.min(F.struct("doc", "line", "h")).alias("first")))
    nearest = scratch.table(pairs.groupBy(*CLASS).agg(F.min(F.struct("apart", *EARLIER)).alias("n"))
                            .select(*CLASS, *[f"n.{c}" for c in EARLIER]))
    hits = _verified(nearest, docs, firsts, scratch, min_jaccard)
    # classes still open: the others they named, or all partners where they had more than they named
    left = scratch.table(pairs.join(hits, CLASS, "left_anti").join(nearest, [*CLASS, *EARLIER], "left_anti"))
    scratch.drop(pairs, nearest)
    still = scratch.table(left.where("more").select(*CLASS).distinct())
    rest = left.select(*CLASS, *EARLIER)
    if not still.isEmpty():
        # only groups of the words of these classes are met again
        again = lines.drop("open").join(still.withColumn("open", F.lit(True)), CLASS, "left").withColumn("open", F.coalesce("open", F.lit(False)))
        words = scratch.table(again.where("open").select(F.explode("prefix").alias("word")).distinct())
        every = _named_partners(again, words, scratch, min_jaccard, None)
        rest = rest.unionByName(every.select(*CLASS, *EARLIER)).distinct()
        scratch.drop(words)
    if not left.isEmpty():
        hits = scratch.table(hits.unionByName(_verified(rest, docs, firsts, scratch, min_jaccard)))
    return firsts, hits


def _dealt(posts: DataFrame, rows: int, scratch: Scratch, frequent: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``posts`` (``rows`` at most), each once for each block pair it meets, with the group ``g`` of that pair; and the written
    table of the words over the bound. ``frequent``: words of the postings to count for it (None: of all)."""
    heavy = scratch.table((posts if frequent is None else frequent).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_ROWS)
                          .select("word", "n", F.ceil(F.col("n") / GROUP_ROWS).cast("int").alias("cuts")))
    cut = posts.join(heavy.drop("n"), "word", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.hash("c1", "sig"), "cuts"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    paired = paired.select("word", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                           "doc", "line", "pos", "open", *CLASS)
    # whole block pairs, dealt to tasks' groups of about TASK_ROWS rows: as many as the rows of all pairs need
    more = heavy.agg(F.sum(F.col("n") * (F.col("cuts") - 1))).first()[0] or 0
    return paired.withColumn("g", F.pmod(F.hash("word", "lo", "hi"), F.lit((rows + more) // TASK_ROWS + 1))), heavy


def _named_partners(lines: DataFrame, words: DataFrame | None, scratch: Scratch, min_jaccard: float, limit: int | None) -> DataFrame:
    """Distinct pairs of classes that pass the filters in the groups of prefix words (of ``words`` only, if given)."""
    posts = lines.select("doc", "line", "open", *CLASS, F.posexplode("prefix").alias("pos", "word"))
    # a word's postings but for one a task: most words are met once in a task, and these are not counted
    frequent = lines.select(F.explode("met").alias("word"))
    if words is not None:
        posts, frequent = (p.join(words, "word", "left_semi") for p in (posts, frequent))
    dealt, heavy = _dealt(posts, int(lines.agg(F.sum("posts")).first()[0] or 0), scratch, frequent)
    schema = ", ".join(f"{c} bigint" for c in [*CLASS, *EARLIER, "apart"]) + ", more boolean"
    found = dealt.groupBy("g").applyInPandas(_partners(min_jaccard, limit), schema)
    pairs = scratch.table(found.groupBy(*CLASS, *EARLIER).agg(F.min("apart").alias("apart"), F.max("more").alias("more")))
    scratch.drop(heavy)
    return pairs


def line_decisions(docs: DataFrame, key: str = "doc_id", text: str = "text", min_jaccard: float = MIN_JACCARD,
                   partners: int = PARTNERS, scratch: Scratch | None = None) -> DataFrame:
    """One row per line with words: ``doc, h`` (the document's key and text hash), ``line`` (from 0),
    ``class_doc, class_line`` (first line with the same word set) and ``kept``.

    Lines are cut at line feeds and ordered by key (null last), then line number; the key is an integer. A line goes
    if an earlier line is similar, whether that one stays or not. Lines without words, null and empty texts have
    no rows and always stay. Where documents share a key, their lines of one number come in order of a hash.
    Rows that agree in key and text are one document and decided alike, each line of it standing for itself once.
    An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    named = _keyed(docs, key, text)
    counts = np.zeros(COUNT_CELLS, np.int64)
    # COUNT_CELLS numbers, whatever the data
    for r in _word_counts(named).collect():
        counts[r["piece"] * COUNT_PIECE:(r["piece"] + 1) * COUNT_PIECE] = np.frombuffer(r["n"], np.int64)
    ranks = np.empty(COUNT_CELLS, np.uint64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(COUNT_CELLS, dtype=np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    ordered = scratch.table(_prefixes(named, shared, min_jaccard))
    firsts, gone = _repeated_classes(named, ordered, scratch, min_jaccard, partners)
    judged = firsts.join(gone.withColumn("gone", F.lit(True)), CLASS, "left")
    # only documents that stand in several rows give a line twice
    lines = ordered.select("doc", "h", "line", *CLASS)
    again = scratch.table(ordered.where("head").groupBy("doc", "h").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"))
    once = lines
    if not again.isEmpty():
        once = lines.join(again, ["doc", "h"], "left_anti").unionByName(lines.join(again, ["doc", "h"], "left_semi").distinct())
    own = F.col("gone").isNull() & (F.struct("doc", "line", "h") == F.col("first"))
    return (once.join(judged, CLASS)
            .select("doc", "h", "line", F.col("first.doc").alias("class_doc"), F.col("first.line").alias("class_line"), own.alias("kept")))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = None, **settings) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``; all documents and other columns stay.

    ``length`` names a column that is set to the new text's number of characters. A document whose lines
    all go has an empty text; a null text stays null.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    told = line_decisions(docs, key, text, scratch=scratch, **settings)
    names = [fresh_name(docs.columns, n) for n in ("_doc", "_h", "_gone")]
    gone = scratch.table(told.where(~F.col("kept")).groupBy(F.col("doc").alias(names[0]), F.col("h").alias(names[1]))
                         .agg(F.collect_list("line").alias(names[2])))  # lines of one document
    rows = docs.withColumns({names[0]: F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY)), names[1]: F.xxhash64(text)})
    joined = rows.join(gone, names[:2], "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        def one(t, drop):
            if t is None or drop is None or not len(drop):
                return t
            drop = set(drop)
            return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)

        return pd.Series([one(t, g) for t, g in zip(texts, lists)], dtype=object)

    out = joined.withColumn(text, cut(F.col(text), F.col(names[2])))
    if length:
        kind = docs.schema[length].dataType
        out = out.withColumn(length, F.when(F.col(names[2]).isNull(), F.col(length))
                             .otherwise(F.char_length(text).cast(kind)))
    return out.select(*docs.columns)
