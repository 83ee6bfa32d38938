"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical), at least
``max(min_words, 4 * q)`` words long, that no neighbouring word extends. Texts are taken in groups of whole
documents. The word ids of a group are compressed by Re-Pair: in every round each occurrence of the most
frequent pair becomes a new symbol, and so does, at once, every pair that is more frequent than the pairs it
overlaps. Rules never span two documents, and copies share rules.

The runs that cross the boundary between the two halves of a rule are computed once, in the rule's first
occurrence; the boundaries of the symbols that remain belong to the start rule and are computed in their whole
document. A run of four periods has two whole periods on one side of the boundary, so its period is a distance
at which the words beside the boundary recur. Runs of rules are moved to every place of the derivation; pieces of one
run, cut off where a rule ends, merge with the run that the rule above it found.
Hashes propose periods and lengths; every run is compared word by word before it counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from graphloom.llm.common import WORD_PATTERN, fresh_name

MIN_WORDS = 6
EXPONENT = 4
# words of a group of documents that share a grammar; a longer document is a group of its own
GROUP_WORDS = 120_000
# distances below it are compared word by word, longer ones are proposed by recurring grams of this many words
GRAM = 16
# proposed (boundary, period) pairs held at a time
HELD = 2_000_000

WORDS = re.compile(WORD_PATTERN)
# white space to str.split that belongs to a word here
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text) if ODD_SPACE.search(text) else text.split()


@dataclass
class Grammar:
    """Symbols below ``base`` are words, rule ``k`` is symbol ``base + k`` of two earlier symbols."""

    base: int
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray     # where a rule's first occurrence starts, in words of the group
    length: np.ndarray    # words of every symbol
    rounds: list[slice]   # the rules that each round made
    start: np.ndarray     # symbols that remain
    place: np.ndarray     # where each of them starts


def repair(words: np.ndarray, owner: np.ndarray) -> Grammar:
    """Re-Pair of the word ids ``words``; ``owner`` is the document of each word."""
    base = int(words.max()) + 1 if len(words) else 0
    symbols, place, own = words.astype(np.int64), np.arange(len(words)), owner
    live = np.ones(len(words), bool)  # pairs, named by their left symbol, that may repeat
    lefts, rights, firsts, rounds = [], [], [], []
    length = np.ones(base, np.int64)
    top = base
    while len(symbols) > 1:
        inside = own[:-1] == own[1:]
        equal = np.flatnonzero((symbols[:-1] == symbols[1:]) & inside)
        live[-1] = False
        wanted = live[:-1] & inside
        if len(equal):  # of a stretch of one symbol, every other pair: they do not overlap
            begins = np.r_[True, np.diff(equal) > 1]
            offset = equal - np.maximum.accumulate(np.where(begins, equal, 0))
            wanted[equal[offset % 2 == 1]] = False
        at = np.flatnonzero(wanted)
        if not len(at):
            break
        pairs, which, often = np.unique(symbols[at] * top + symbols[at + 1], return_inverse=True, return_counts=True)
        live[at[often[which] == 1]] = False  # it never repeats again
        # more frequent first; equal counts in an order that has nothing to do with the text's
        mixed = (np.arange(len(pairs), dtype=np.uint64) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
        rank = np.where(often > 1, (often.astype(np.uint64) << np.uint64(32)) | mixed, np.uint64(0))
        ranks = np.zeros(len(symbols) + 1, np.uint64)
        ranks[at + 1] = rank[which]
        here = ranks[at + 1]
        chosen = (here > 0) & (here > ranks[at]) & (here > np.r_[ranks, np.uint64(0)][at + 2])
        taken = np.bincount(which[chosen], minlength=len(pairs))
        chosen &= taken[which] > 1
        if not chosen.any():
            break
        spots, names = at[chosen], which[chosen]
        made = np.flatnonzero(np.bincount(names, minlength=len(pairs)))
        number = np.zeros(len(pairs), np.int64)
        number[made] = np.arange(len(made))
        first = np.zeros(len(made), np.int64)
        first[number[names[::-1]]] = place[spots[::-1]]
        lefts.append(pairs[made] // top)
        rights.append(pairs[made] % top)
        firsts.append(first)
        rounds.append(slice(top - base, top - base + len(made)))
        length = np.r_[length, length[lefts[-1]] + length[rights[-1]]]
        symbols[spots] = top + number[names]
        stay = np.ones(len(symbols), bool)
        stay[spots + 1] = False
        live[spots] = True
        live[spots[spots > 0] - 1] = True
        symbols, place, own, live = symbols[stay], place[stay], own[stay], live[stay]
        top += len(made)
    none = np.zeros(0, np.int64)
    return Grammar(base, np.concatenate([none, *lefts]), np.concatenate([none, *rights]), np.concatenate([none, *firsts]),
                   length, rounds, symbols, place)


class Grams:
    """Hashes of any stretch of the group's words, and where its ``GRAM``-word stretches recur."""

    FACTOR = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64

    def __init__(self, words: np.ndarray):
        n = len(words)
        values = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        values ^= values >> np.uint64(32)
        power = np.full(n + 1, np.uint64(self.FACTOR))
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        inverse = np.full(n + 1, np.uint64(pow(self.FACTOR, -1, 1 << 64)))
        inverse[0] = 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * power[:n], out=self.sums[1:])
        self.n = n
        grams = self.of(np.arange(max(0, n - GRAM + 1)), GRAM)
        order = np.argsort(grams, kind="stable")
        ordered = grams[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        sizes = np.bincount(group) if len(order) else np.zeros(0, np.int64)
        again = sizes[group] > 1
        # sorted by (gram, place): the places of one gram within any bounds are one slice
        self.sorted = group[again] * np.int64(n + 1) + order[again]
        self.places = order[again]
        self.group = np.full(n + 1, -1, np.int64)
        self.group[self.places] = group[again]

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.inverse[at]

    def recurrences(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into ``at``, place) for every place in [low, high] of the gram at ``at``, some at a time."""
        usable = np.flatnonzero((at >= 0) & (high >= low))
        usable = usable[self.group[at[usable]] >= 0]
        key = self.group[at[usable]] * np.int64(self.n + 1)
        begin = np.searchsorted(self.sorted, key + np.maximum(low[usable], 0))
        end = np.searchsorted(self.sorted, key + high[usable], side="right")
        some = end > begin
        usable, begin, count = usable[some], begin[some], (end - begin)[some]
        done = 0
        total = np.cumsum(count)
        while done < len(usable):
            until = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + HELD)))
            c = count[done:until]
            within = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
            yield np.repeat(usable[done:until], c), self.places[np.repeat(begin[done:until], c) + within]
            done = until


def _agreement(grams: Grams, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """Words that agree from ``x`` and ``y`` on (``step`` 1) or before them (``step`` -1), at most ``most``."""
    low, high = np.zeros_like(most), most.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        back = 0 if step > 0 else middle
        same = grams.of(x - back, middle) == grams.of(y - back, middle)
        low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)


def crossing_runs(words: np.ndarray, grams: Grams, cut: np.ndarray, low: np.ndarray, high: np.ndarray,
                  min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(index, start, end, period)`` of the runs inside [low, high) that touch both sides of ``cut``.

    Periods that are multiples of a run's smallest one are left out.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # index, anchor, period: a square begins at the anchor
    for q in range(1, GRAM):
        if q >= len(words):
            break
        same = np.r_[words[:-q] == words[q:], np.zeros(q, bool)]
        for side in (0, 2 * q):
            index = np.flatnonzero((cut - side >= low) & (cut - side + 2 * q <= high))
            for i in range(q):
                index = index[same[cut[index] - side + i]]
            found.append((index, cut[index] - side, np.full(len(index), q)))
    room = (high - cut) // 2
    for index, there in grams.recurrences(cut, cut + GRAM, cut + room):
        q = there - cut[index]
        ok = grams.of(cut[index], q) == grams.of(cut[index] + q, q)
        found.append((index[ok], cut[index[ok]], q[ok]))
    back = cut - GRAM
    for index, there in grams.recurrences(np.where(back >= low, back, -1), back - (cut - low) // 2, back - GRAM):
        q = back[index] - there
        ok = grams.of(cut[index] - 2 * q, q) == grams.of(cut[index] - q, q)
        found.append((index[ok], cut[index[ok]] - 2 * q[ok], q[ok]))
    index, x, q = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    after = _agreement(grams, x, x + q, high[index] - x - q, 1)
    before = _agreement(grams, x, x + q, x - low[index], -1)
    start, end = x - before, x + q + after
    long_ = end - start >= np.maximum(min_words, EXPONENT * q)
    rows = np.unique(np.stack([index, start, end, q, x], 1)[long_], axis=0)
    # equal hashes are only a proposal
    checked: dict[tuple[int, int, int], bool] = {}
    keep = np.ones(len(rows), bool)
    for i, (k, s, e, p, a) in enumerate(rows.tolist()):
        good = checked.get((s, e, p))
        if good is None:
            good = checked[s, e, p] = np.array_equal(words[s:e - p], words[s + p:e])
        if not good:
            s, e = _exact(words, a, p, int(low[k]), int(high[k]))
            rows[i, 1:3] = s, e
            keep[i] = e - s >= max(min_words, EXPONENT * p)
    rows = rows[keep]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch, several periods: only the smallest is a run's
    fresh = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)] if len(rows) else np.zeros(0, bool)
    rows = rows[fresh]
    return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _exact(words: np.ndarray, x: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch of period ``q`` around ``x`` by the words themselves."""
    differ = low + np.flatnonzero(words[low:high - q] != words[low + q:high])
    after = differ[differ >= x]
    before = differ[differ < x]
    return int(before[-1]) + 1 if len(before) else low, (int(after[0]) if len(after) else high - q) + q


def group_runs(words: np.ndarray, begins: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """All runs ``(start, end, period)`` of a group, in places of the group, by start and period.

    ``words`` are the ids of all documents one after another, ``begins`` where each document starts, ending with
    the number of words.
    """
    if not len(words):
        return []
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    g = repair(words, owner)
    grams = Grams(words)
    # rules first, then the cuts of the start rule
    rule = np.flatnonzero(g.length[g.base:] >= min_words)
    inner = np.flatnonzero(owner[g.place[1:]] == owner[g.place[:-1]]) + 1
    whole = owner[g.place[inner]]
    cut = np.r_[g.first[rule] + g.length[g.left[rule]], g.place[inner]]
    low = np.r_[g.first[rule], begins[whole]]
    high = np.r_[g.first[rule] + g.length[g.base + rule], begins[whole + 1]]
    index, start, end, period = crossing_runs(words, grams, cut, low, high, min_words)
    top = index >= len(rule)
    spans = [np.stack([start[top], end[top], period[top]], 1)]
    if not top.all():
        spans += _derived(g, rule[index[~top]], start[~top], end[~top], period[~top])
    return _merged(np.unique(np.concatenate(spans), axis=0))


def _derived(g: Grammar, rule: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> list[np.ndarray]:
    """The runs of rules at all places of the derivation."""
    order = np.argsort(rule, kind="stable")
    rule, start, end, period = rule[order], start[order] - g.first[rule[order]], end[order] - g.first[rule[order]], period[order]
    many = np.bincount(rule, minlength=len(g.left))
    begin = np.cumsum(many) - many
    holds = np.r_[np.zeros(g.base, bool), many > 0]
    for made in g.rounds:  # a rule's parts are older than the rule
        holds[g.base + made.start:g.base + made.stop] |= holds[g.left[made]] | holds[g.right[made]]
    symbol, place = g.start[holds[g.start]], g.place[holds[g.start]]
    out = []
    while len(symbol):
        k = symbol - g.base
        c = many[k]
        nth = np.repeat(begin[k], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        shift = np.repeat(place, c)
        out.append(np.stack([start[nth] + shift, end[nth] + shift, period[nth]], 1))
        symbol, place = np.r_[g.left[k], g.right[k]], np.r_[place, place + g.length[g.left[k]]]
        going = holds[symbol]
        symbol, place = symbol[going], place[going]
    return out


def _merged(spans: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal intervals: those of one period that share a period's words are one, and a stretch keeps its
    smallest period."""
    joined: dict[tuple[int, int], int] = {}
    held: list[int] | None = None
    for s, e, q in spans[np.lexsort((-spans[:, 1], spans[:, 0], spans[:, 2]))].tolist():
        if held and held[2] == q and s + q <= held[1]:
            held[1] = max(held[1], e)
            continue
        if held:
            joined.setdefault((held[0], held[1]), held[2])  # periods ascend
        held = [s, e, q]
    if held:
        joined.setdefault((held[0], held[1]), held[2])
    return sorted((s, e, q) for (s, e), q in joined.items())


def _told(texts: list[list[str]], min_words: int) -> Iterator[tuple[list[dict], list[str]]]:
    """Runs and kept words of every document of a group."""
    flat = pd.factorize(np.array([w for words in texts for w in words], object))[0].astype(np.int64)
    begins = np.r_[0, np.cumsum([len(words) for words in texts])]
    per_doc: dict[int, list[tuple[int, int, int]]] = {}
    runs = group_runs(flat, begins, min_words)
    for (s, e, q), d in zip(runs, np.searchsorted(begins, [r[0] for r in runs], side="right") - 1 if runs else []):
        at = int(begins[d])
        per_doc.setdefault(int(d), []).append((s - at, e - at, q))
    for d, words in enumerate(texts):
        own = per_doc.get(d)
        if not own:
            yield [], words
            continue
        edges = np.zeros(len(words) + 1, np.int64)
        for s, e, q in own:
            edges[s + q] += 1
            edges[e] -= 1
        kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
        yield [{"start": s, "length": e - s, "period": q} for s, e, q in own], [words[i] for i in kept]


def document_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                  order: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """One row per row of ``docs``: its columns but ``text``, and ``n_words``, ``runs`` (array of ``start, length,
    period`` in words, by start, then period) and ``kept_text``.

    ``kept_text`` holds the words, joined by one blank, that no run repeats: of each run the first ``period`` words
    stay. ``order(key, n)`` may give, for a document of ``n`` words, the numbers of the words that are read in place of
    0 .. n-1 (None: as they are). Null texts have no words, no runs and a null ``kept_text``; empty ones an empty one.
    Repeated rows are told alike, an empty table gives no rows. Result columns whose name the input has get underscores.
    """
    rest = [f for f in docs.schema.fields if f.name != text]
    names = [fresh_name([f.name for f in rest], n) for n in ("n_words", "runs", "kept_text")]
    run = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])
    schema = StructType([*rest, *[StructField(n, k) for n, k in zip(names, (LongType(), ArrayType(run), StringType()))]])
    run_kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    keys = [f.name for f in rest].index(key)

    def batch_of(part: pa.RecordBatch, begin: int, texts: list[list[str]], null: list[bool]) -> pa.RecordBatch:
        runs, kept = [], []
        for (r, k), gone in zip(_told(texts, min_words), null):
            runs.append(r)
            kept.append(None if gone else " ".join(k))
        columns = [part.column(i).slice(begin, len(texts)) for i in range(len(rest))]
        told = (pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, run_kind), pa.array(kept, pa.string()))
        return pa.RecordBatch.from_arrays([*columns, *told], names=[f.name for f in schema.fields])

    def tell(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            begin, held, texts, null = 0, 0, [], []
            for i in range(part.num_rows):
                t = part.column(len(rest))[i].as_py()
                words = words_of(t) if t else []
                if order is not None and words:
                    numbers = order(part.column(keys)[i].as_py(), len(words))
                    if numbers is not None:
                        words = [words[k] for k in numbers.tolist()]
                if texts and held + len(words) > GROUP_WORDS:
                    yield batch_of(part, begin, texts, null)
                    begin, held, texts, null = i, 0, [], []
                texts.append(words)
                null.append(t is None)
                held += len(words)
            if texts:
                yield batch_of(part, begin, texts, null)

    return docs.select(*[F.col(f"`{f.name}`") for f in rest], F.col(text)).mapInArrow(tell, schema)
