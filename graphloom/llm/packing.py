"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: whole sequences
first, then the binary digits of the rest, longest first. Each piece fills a sequence of its
own length, so nothing is padded and no sequence crosses documents. Sequences of one
length are numbered one after another, which makes batches of equal length contiguous.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from graphloom.llm.common import Scratch, fresh_name, numbered, release_memory, small_frame

MAX_TOKENS = 1024
END_ID = 0
# bytes of the words and ids that a Python worker remembers, from task to task, the objects around them counted in. They
# are kept in two halves: when the younger is full it takes the older one's place, so that words still in use stay. A
# longer word is never kept
REMEMBERED_BYTES, LONGEST_KEPT = 96 << 20, 32
# the pre-tokenizer never joins a word, with the blank before it, to its neighbours, nor letters to
# the full stop or comma that ends their word; white space follows the pre-tokenizer's own rule. The first case is the
# second's most frequent one, told by plain character ranges
UNITS = re.compile(r" ?[A-Za-z]++(?=[ \n]|[.,](?:[ \n]|\Z)|\Z)| ?[^\W\d_]++(?=[.,]?(?:\s|\Z))|[.,](?=\s|\Z)| ?\S+|\s+(?!\S)|\s+")
# packs of that many ids
PACKS = [struct.Struct(f"<{n}I").pack for n in range(33)]
# characters that Python counts as white space and the pre-tokenizer does not
ODD_SPACE = re.compile("[\x1c-\x1f]")
# bytes of text that are cut at once in arrays: bounds a worker's memory, and with it the ids of a batch
BLOCK_BYTES = 2 << 20
# pieces that are handed on at once
BATCH_PIECES = 1 << 13
# bytes by kind: part of a word, blank, other white space, A-Z and a-z, other ASCII characters
_REST, _BLANK, _SPACE, _LETTER, _MARK = range(5)
_KIND = np.array([_LETTER if chr(b).isalpha() else _MARK for b in range(128)] + [_REST] * 128, np.uint8)
_KIND[[9, 10, 11, 12, 13]], _KIND[32] = _SPACE, _BLANK
# the pre-tokenizer always cuts between these kinds: before white space that ends a word, behind white space other than a blank,
# and behind a letter that no letter or byte of a longer character follows
_CUT = np.zeros((8, 8), bool)
_CUT[np.ix_([_REST, _LETTER, _MARK], [_BLANK, _SPACE])] = True
_CUT[_SPACE, [_REST, _LETTER, _MARK]] = True
_CUT[_LETTER, _MARK] = True
_CUT = _CUT.ravel()
_WORD_END = re.compile(rb"[^\x09-\x0d ](?=[\x09-\x0d ])")
# white space, or taken for it by Python or by older tables, outside the kinds above
_ODD_BYTES = re.compile(b"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


class WordCachedTokenizer:
    """Whole texts to little-endian unsigned 32-bit ids, exactly as ``tokenizers`` gives
    them, with the ids of words kept between texts.

    Only byte-level pre-tokenizers without a normaliser cut every text at the units of
    ``UNITS``; a text with an added token's string or an odd control character is encoded whole.
    ``encode_block`` cuts many texts at once in arrays, at such places that bytes alone tell, and looks each
    distinct unit of the block up once; texts with other white space than ASCII's go through ``encode``.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_BYTES):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held, self.remembered = 0, remembered
        self.model = self.tokenizer.model
        # byte-level models name the bytes that print by their own character, the others by characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.names = {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(others)}}
        self.blank = chr(self.names[32])

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> bytes:
        if ODD_SPACE.search(text) or any(t in text for t in self.added):
            return self._ids([text])[0]
        return b"".join(self._ids_of(UNITS.findall(text)))

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of each unit; those of new units are remembered."""
        out = list(map(self.known.get, units))
        fresh = dict.fromkeys(u for u, ids in zip(units, out) if ids is None)
        if not fresh:
            return out
        found = {u: self.older[u] for u in fresh if u in self.older}
        if len(found) < len(fresh):
            found.update(self._unit_ids([u for u in fresh if u not in found]))
        for unit, ids in found.items():
            if len(unit) <= LONGEST_KEPT:
                self.known[unit] = ids
                self.held += 250 + len(unit) + len(ids)
        if self.held > self.remembered // 2:
            self.older, self.known, self.held = self.known, {}, 0
        return [found[u] if ids is None else ids for u, ids in zip(units, out)]

    def encode_block(self, block: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts (UTF-8) that stand in ``block`` one after another up to ``ends``, and the number of each text's."""
        starts = np.concatenate(([0], ends[:-1]))
        odd = {int(np.searchsorted(ends, m.start(), side="right")) for m in _ODD_BYTES.finditer(block)}
        for token in self.added:
            token, at = token.encode(), -1
            while (at := block.find(token, at + 1)) >= 0:
                odd.add(int(np.searchsorted(ends, at, side="right")))
        flat, counts, at = [], [], 0
        for i in [*sorted(odd), len(ends)]:
            if at < i:
                ids, n = self._encode_plain(block[starts[at]:ends[i - 1]], ends[at:i] - starts[at])
                flat.append(ids)
                counts.append(n)
            if i < len(ends):
                flat.append(np.frombuffer(self.encode(block[starts[i]:ends[i]].decode()), "<u4"))
                counts.append([len(flat[-1])])
            at = i + 1
        return np.concatenate(flat), np.concatenate(counts).astype(np.int64)

    def _encode_plain(self, block: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not block:
            return np.empty(0, "<u4"), np.zeros(len(ends), np.int64)
        kind = _KIND[np.frombuffer(block, np.uint8)]
        cut = np.empty(len(kind) + 1, bool)
        cut[1:-1] = _CUT[kind[:-1] * np.uint8(8) + kind[1:]]
        # of several white spaces before a word, the last one stands apart from the others
        space = (kind == _BLANK) | (kind == _SPACE)
        cut[1:-2] |= space[:-2] & space[1:-1] & ~space[2:]
        # but not where the text ends
        starts = np.concatenate(([0], ends[:-1]))
        last = ends[ends - starts > 1] - 1
        cut[last[space[last] & space[last - 1]]] = False
        cut[starts], cut[-1] = True, True
        edges = np.flatnonzero(cut).astype(np.int32)
        # empty texts have no unit: those of a text stand between the edges of its start and its end
        units = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(block)).dictionary_encode()
        distinct = units.dictionary.to_pylist()
        ids = self._ids_of(distinct)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        unit = units.indices.to_numpy()
        many = size[unit]
        upto = np.concatenate(([0], np.cumsum(many)))
        place = np.arange(upto[-1]) + np.repeat((np.cumsum(size) - size)[unit] - upto[:-1], many)
        return np.frombuffer(b"".join(ids), "<u4")[place], np.diff(upto[np.searchsorted(edges, np.concatenate(([0], ends)))])

    def _unit_ids(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units. Letters alone, with or without the blank before them, are one piece to the pre-tokenizer: the
        model gets them as they are. All else goes through the whole tokenizer."""
        found, rest, tokenize = {}, [], self.model.tokenize
        for u in units:
            if u.removeprefix(" ").isalpha():
                if u.isascii():
                    piece = self.blank + u[1:] if u[0] == " " else u
                else:
                    piece = u.encode("utf-8").decode("latin-1").translate(self.names)
                ids = [t.id for t in tokenize(piece)]
                found[u] = PACKS[len(ids)](*ids) if len(ids) < len(PACKS) else struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(u)
        found.update(zip(rest, self._ids(rest)))
        return found

    def whole(self, text: bytes) -> bool:
        """Whether ``text`` is not to be cut at bytes."""
        return bool(_ODD_BYTES.search(text)) or any(t.encode() in text for t in self.added)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordCachedTokenizer:
    return WordCachedTokenizer(path)


def binary_pieces(n: int, longest: int = MAX_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; ``longest`` is a power of two."""
    out = [(at, longest) for at in range(0, n - longest + 1, longest)]
    at = n - n % longest
    size = longest // 2
    while size:
        if (n - at) & size:
            out.append((at, size))
            at += size
        size //= 2
    return out


def cut_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
               max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: the columns of ``docs`` but ``text``, and ``start``, ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``.

    A null text is an empty one: it has only the end id. Rows that repeat are cut alike. An
    empty table gives no rows. Result columns whose name the input has get underscores.
    """
    if max_tokens & (max_tokens - 1) or max_tokens < 1:
        raise ValueError(f"max_tokens must be a power of two, not {max_tokens}")
    rest = [f for f in docs.schema.fields if f.name != text]
    names = [fresh_name([f.name for f in rest], n) for n in ("start", "length", "ids", "doc_tokens")]
    kinds = (LongType(), LongType(), BinaryType(), LongType())
    schema = StructType([*rest, *[StructField(n, k) for n, k in zip(names, kinds)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokenizer(tokenizer)
        for batch in batches:
            base = batch.select([f.name for f in rest])
            held = []
            for at, flat, counts, done in _encoded(known, batch.column(len(rest))):
                if done:
                    # each text's ids, and the end id behind them
                    flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
                if held or not done:  # a long text comes in parts
                    held.append(flat)
                    if not done:
                        continue
                    flat, held = np.concatenate(held), []
                    counts = np.array([len(flat)])
                row, begin, size = _cut(counts, max_tokens)
                upto = np.concatenate(([0], np.cumsum(size)))
                for i in range(0, len(size), BATCH_PIECES):
                    some = slice(i, i + BATCH_PIECES)
                    cuts = upto[i:i + BATCH_PIECES + 1]
                    ids = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((4 * (cuts - cuts[0])).astype(np.int32)),
                                                                             pa.py_buffer(flat[cuts[0]:cuts[-1]].astype("<u4"))])
                    told = base.take(pa.array(at + row[some]))
                    yield pa.RecordBatch.from_arrays([*told.columns, pa.array(begin[some]), pa.array(size[some]), ids,
                                                      pa.array(counts[row[some]])], names=[f.name for f in schema])
        release_memory()

    return docs.select(*[f.name for f in rest], text).mapInArrow(run, schema)


def _encoded(known: WordCachedTokenizer, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """The ids of ``texts`` in order, by blocks of ``BLOCK_BYTES`` at most: number of the block's first text, ids, how many
    each text has, whether the last text ends. A longer text comes alone and in parts, each begun by white space behind a word."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        upto = max(int(np.searchsorted(places, places[at] + BLOCK_BYTES, side="right")) - 1, at + 1)
        start, end = int(places[at]), int(places[upto])
        block = data.slice(start, end - start).to_pybytes() if data is not None else b""
        ends = places[at + 1:upto + 1] - start
        parts = [(0, len(block))]
        if len(block) > BLOCK_BYTES and not known.whole(block):
            parts = _text_parts(block)
        for i, (a, b) in enumerate(parts):
            part = block if len(parts) == 1 else block[a:b]
            ids, counts = known.encode_block(part, ends if len(parts) == 1 else np.array([len(part)]))
            yield at, ids, counts, i == len(parts) - 1
        at = upto


def _text_parts(text: bytes) -> list[tuple[int, int]]:
    """Parts of about ``BLOCK_BYTES`` of a long text, each but the first begun by white space behind a word."""
    parts, at = [], 0
    for found in _WORD_END.finditer(text):
        if found.end() - at >= BLOCK_BYTES:
            parts.append((at, found.end()))
            at = found.end()
    return [*parts, (at, len(text))]


def _cut(counts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``binary_pieces`` of many texts with ``counts`` tokens: the text's number, start and length of each piece."""
    full = counts // longest
    rows, lengths = [np.repeat(np.arange(len(counts)), full)], [np.full(full.sum(), longest)]
    starts = [longest * (np.arange(len(rows[0])) - np.repeat(np.cumsum(full) - full, full))]
    size = longest // 2
    while size:
        row = np.flatnonzero(counts & size)
        rows.append(row)
        starts.append(counts[row] & ~(2 * size - 1))
        lengths.append(np.full(len(row), size))
        size //= 2
    row, start, length = (np.concatenate(x).astype(np.int64) for x in (rows, starts, lengths))
    order = np.lexsort((start, row))
    return row[order], start[order], length[order]


def number_sequences(pieces: DataFrame, scratch: Scratch, key: str = "doc_id", start: str = "start",
                     length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, longest sequences first, then by document and
    start) and ``offset`` (0: each piece is a sequence)."""
    order = [F.col(length).desc(), F.col(key).asc_nulls_last(), F.col(start)]
    seq, off = fresh_name(pieces.columns, "sequence_id"), fresh_name(pieces.columns, "offset")
    return numbered(scratch, pieces, *order, name=seq).withColumn(off, F.lit(0).cast("bigint"))


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Packed sequences with their ids: ``cut_pieces``, numbered as ``number_sequences`` does it; documents that share a key
    are parted by their texts where they are too many for one task.

    Texts are dealt in order of documents before they are cut. So tasks hold the pieces of documents that follow each other,
    sort them by length and write them once; the counts of each task and length give the numbers. No piece is shuffled.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    dealt = docs.repartitionByRange(F.col(key).asc_nulls_last(), F.xxhash64(text))
    pieces = cut_pieces(dealt, tokenizer, key, text, max_tokens, end_id)
    start, length = (fresh_name([c for c in docs.columns if c != text], n) for n in ("start", "length"))
    part, mid = (fresh_name(pieces.columns, n) for n in ("_part", "_mid"))
    seq, off = (fresh_name(pieces.columns, n) for n in ("sequence_id", "offset"))
    rows = scratch.table(pieces.sortWithinPartitions(F.col(length).desc(), F.col(key).asc_nulls_last(), F.col(start))
                         .withColumn(part, F.spark_partition_id()).withColumn(mid, F.monotonically_increasing_id()))
    # a row for each task and power of two
    told = rows.groupBy(part, length).agg(F.min(mid).alias("first"), F.count(F.lit(1)).alias("c")).collect()
    shifts, total = [], 0
    for r in sorted(told, key=lambda r: (-r[length], r[part])):
        shifts.append((r[part], r[length], total - r["first"]))
        total += r["c"]
    shift = fresh_name(rows.columns, "_shift")
    frame = small_frame(docs.sparkSession, shifts, StructType().add(part, "integer").add(length, "long").add(shift, "long"))
    return rows.join(F.broadcast(frame), [part, length]).select(
        *pieces.columns, (F.col(mid) + F.col(shift)).alias(seq), F.lit(0).cast("bigint").alias(off))
