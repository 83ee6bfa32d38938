"""Line dedup (set-similarity join) and line hashing against brute force."""

import random
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from graphloom.llm import line_dedup, line_hash
from graphloom.llm.common import Scratch

SCHEMA = "doc_id bigint, text string, extra string"


def slow_decisions(rows):
    """{(doc, line): (class doc, class line, kept)} for distinct keys."""
    lines = []
    for doc, text, _ in sorted(rows):
        for i, line in enumerate((text or "").encode().lower().split(b"\n")):
            if line.split():
                lines.append((doc, i, frozenset(line.split())))
    first, out = {}, {}
    for doc, i, s in lines:
        first.setdefault(s, (doc, i))
    order = list(first)
    gone = {s for n, s in enumerate(order) if any(len(s & t) >= 0.8 * len(s | t) - 1e-9 for t in order[:n])}
    for doc, i, s in lines:
        out[doc, i] = (*first[s], first[s] == (doc, i) and s not in gone)
    return out


def told(frame, **kw):
    return {(r["doc"], r["line"]): (r["class_doc"], r["class_line"], r["kept"])
            for r in line_dedup.line_decisions(frame, **kw).collect()}


def random_rows(seed, docs=40, words=30):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 14))] for _ in range(25)]
    rows = []
    for d in range(docs):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(pool))
            for _ in range(rng.randint(0, 2)):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            rng.shuffle(line)
            lines.append(" ".join(line) if rng.random() > 0.1 else "")
        rows.append((d, "\n".join(lines), None))
    return rows


def test_decisions_equal_brute_force(spark):
    for seed in range(4):
        rows = random_rows(seed)
        assert told(spark.createDataFrame(rows, SCHEMA)) == slow_decisions(rows)


def test_small_blocks_and_few_partners_lose_nothing(spark, monkeypatch):
    # hot words cut into block pairs; one partner named at a time, so classes are taken up again
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 5)
    monkeypatch.setattr(line_dedup, "TASK_ROWS", 50)
    rows = random_rows(9, docs=60, words=8)
    assert told(spark.createDataFrame(rows, SCHEMA), partners=2) == slow_decisions(rows)


def test_given_lines_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"], None) for r in docs.select("doc_id", "text").collect()]
    assert told(docs) == slow_decisions(rows)


def test_a_document_of_very_many_lines(spark):
    # more lines than a block's line numbers can tell; similar lines, not equal sets, all over it and in a later document
    n, step = 300_000, 5_000
    texts = [f"a{i} b{i}" for i in range(n)]
    later = []
    for i in range(0, n, step):
        texts[i] = " ".join(f"p{i}x{k}" for k in range(9))
        later.append(" ".join([f"p{i}x{k}" for k in range(8)] + [f"new{i}"]))  # 8 words shared of 10
    for i, line in zip(range(step // 2, n, step), later):
        texts[i] = line
    rows = [(0, "short before it\nand another", None), (1, "\n".join(texts), None), (2, "\n".join(later), None)]
    blocks = list(line_dedup._blocks([pd.DataFrame([(d, 0, t) for d, t, _ in rows], columns=["doc", "h", "text"])]))
    assert all(len(b.size) <= line_dedup.BATCH_LINES for b in blocks) and sum(len(b.size) for b in blocks) == n + 2 + len(later)
    assert sum(b.head.sum() for b in blocks) == len(rows)
    got = told(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    gone = {(1, i) for i in range(step // 2, n, step)} | {(2, i) for i in range(len(later))}
    assert len(got) == n + 2 + len(later) and {place for place, (_, _, kept) in got.items() if not kept} == gone


def test_a_hot_word_goes_to_groups_of_a_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 10)
    monkeypatch.setattr(line_dedup, "TASK_ROWS", 100)
    posts = spark.range(400).selectExpr("id doc", "0L line", "true open", "id * 7919 c1", "id sig", "id sag", "5L size", "0 pos", "3 word")
    dealt, _ = line_dedup._dealt(posts, 400, Scratch(spark, "dealt"))
    sizes = [r["count"] for r in dealt.groupBy("g").count().collect()]
    assert sum(sizes) == 400 * 40 and max(sizes) <= 6 * 100


def test_words_of_odd_texts_by_plain_python(monkeypatch):
    rng = random.Random(1)
    some = [" ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\xa0", "é", "A", "b", "B", "\x00", "中", "w" * 7, "w" * 8, "w" * 9, "y" * 17, "z" * 64, "z" * 65, "q" * 200]
    docs = [(i, 0, "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    docs += [(400, 0, None), (401, 0, ""), (402, 0, "a b\n" * 300), (403, 0, "\n\n  \n" * 50 + "end")]
    want = {(d, i): frozenset(line.split()) for d, _, t in docs for i, line in enumerate((t or "").encode().lower().split(b"\n")) if line.split()}
    for size in (390_000, 100, 7):
        monkeypatch.setattr(line_dedup, "BATCH_BYTES", size)
        names, sets, heads = {}, {}, []
        for b in line_dedup._blocks(iter([pd.DataFrame(docs, columns=["doc", "h", "text"])])):
            for i, place in enumerate(zip(b.doc.tolist(), b.line.tolist())):
                words = want.pop(place) if size == 7 else want[place]
                own = b.hashes[b.starts[i]:b.starts[i] + b.size[i]].tolist()
                assert len(set(own)) == len(own) == len(words)
                # lines with equal sets have one name, others another
                name = (int(b.c1[i]), int(b.sig[i]), int(b.sag[i]), len(own))
                assert names.setdefault(words, name) == name and sets.setdefault(name, words) == words
                heads += [place[0]] if b.head[i] else []
        assert len(heads) == len(set(heads))
    assert not want


def test_a_worker_holds_little_at_once():
    # 300,000 different words: neither they nor their hashes stay in the worker
    text = "\n".join(" ".join(f"word{i}{k}" for k in "abcdefghij") for i in range(30_000))
    tracemalloc.start()
    lines = sum(len(b.size) for b in line_dedup._blocks(iter([pd.DataFrame([(1, 0, text)], columns=["doc", "h", "text"])])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lines == 30_000 and peak < 32_000_000


def test_texts_are_read_for_two_verifications_at_most(spark, monkeypatch):
    calls = []
    verified = line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda *a: calls.append(1) or verified(*a))
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 5)
    # a crowd of lines, each with 7 of 10 words in common with the others, so that partners pass the filters and fail
    rng = random.Random(2)
    rows = [(d, " ".join(rng.sample([f"v{i}" for i in range(14)], 9)), None) for d in range(80)]
    assert told(spark.createDataFrame(rows, SCHEMA), partners=2) == slow_decisions(rows)
    assert len(calls) <= 2


def test_words_met_once_in_a_task_are_not_counted_for_the_bound(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP_ROWS", 20)
    met, dealt = [], line_dedup._dealt

    def spy(posts, rows, scratch, frequent=None):
        met.append({r["word"]: r["n"] for r in frequent.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()})
        counts = {r["word"]: r["n"] for r in posts.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert all(n >= met[-1].get(w, 0) >= n - tasks for w, n in counts.items()) and len(met[-1]) < len(counts) // 5
        return dealt(posts, rows, scratch, frequent)

    monkeypatch.setattr(line_dedup, "_dealt", spy)
    # two of five words are prefix words: the own one and the hot one, as the others are still more frequent
    rows = [(d, f"hot own{d} a b c", None) for d in range(90)] + [(90 + d, f"a b c only{d} that{d}", None) for d in range(30)]
    tasks = 3
    assert told(spark.createDataFrame(rows, SCHEMA).coalesce(tasks)) == slow_decisions(rows)
    assert met and max(met[0].values()) >= 90 - tasks


ODD = [
    (3, "a b c d e\n\nf g h i j", "x"), (3, "a b c d e\n\nf g h i j", "x"),  # a repeated row
    (5, "f g h i j\nnew line here", "y"), (6, None, "z"), (7, "", "z"), (8, "\n \n", "z"),
    (None, "a b c d e\nlast of all", "n"), (9, "long " * 3000 + "\n" + " ".join(f"u{i}" for i in range(5000)), "l"),
]


def test_odd_rows_and_cut_texts(spark):
    frame = spark.createDataFrame(ODD, "doc_id bigint, text string, line string")
    out = {(r["doc_id"], r["line"]): r["text"] for r in line_dedup.without_repeats(frame).collect()}
    assert out[3, "x"] == "a b c d e\n\nf g h i j"  # the first stays, and its repeated row with it
    assert out[5, "y"] == "new line here"
    assert out[6, "z"] is None and out[7, "z"] == "" and out[8, "z"] == "\n \n"
    assert out[None, "n"] == "last of all"  # a null key comes last
    assert out[9, "l"].startswith("long ")
    assert line_dedup.without_repeats(frame).count() == len(ODD)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.without_repeats(empty).collect() == []


# ------------------------------------------------------------------------------------------ line hashing

LONG = " ".join(f"word{i}" for i in range(60))
HALVES = [" ".join(f"left{i}" for i in range(30)), " ".join(f"right{i}" for i in range(30))]


def test_spans_of_repeated_passages(spark):
    rows = [
        (1, f"intro one\n{LONG}\noutro"), (2, f"other\n{LONG.upper()}  \nend two"),  # case and blanks are normalised
        (3, "\n".join(["start", *HALVES, "tail"])), (4, "\n".join(["begin", HALVES[0], "", HALVES[1]])),
        (5, HALVES[0]),  # repeated, but short alone
        (6, None), (7, ""), (8, "short\nshort\nshort"), (None, LONG),
    ]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, start string")
    spans = {r["doc_id"]: r for r in line_hash.repeated_spans(frame).collect()}
    assert set(spans) == {2, 4, None}
    text = rows[1][1]
    assert text[spans[2]["start"]:spans[2]["end"]] == LONG.upper() + "  "
    assert (spans[2]["kept_doc_id"], spans[2]["kept_start"]) == (1, len("intro one\n"))
    assert spans[4]["n_words"] == 60 and spans[4]["n_lines"] >= 2
    cut = {r["doc_id"]: r for r in line_hash.without_spans(frame).collect()}
    assert cut[2]["text"] == "other\nend two" and cut[1]["text"] == rows[0][1] and cut[6]["text"] is None
    assert "".join(text[s["start"]:s["end"]] for s in cut[2]["kept_spans"]) == "other\nend two"
    assert cut[None]["text"] == ""


def test_repeated_rows_are_one_document(spark):
    frame = spark.createDataFrame([(1, LONG)] * 3 + [(2, LONG)] * 2, "doc_id bigint, text string")
    assert [r["doc_id"] for r in line_hash.repeated_spans(frame).collect()] == [2]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_hash.repeated_spans(empty).collect() == [] and line_hash.without_spans(empty).collect() == []


def slow_spans(rows, min_words):
    """(doc, start, end, words) of runs of sentences that stand earlier, by plain loops over (doc, offset)."""
    units = []
    for doc, text in sorted(rows):
        own, at = [], 0
        for line in text.split("\n"):
            begin = 0
            for i, c in enumerate(line):
                ends = c in ".!?" and (i + 1 == len(line) or line[i + 1] not in ".!?")
                if ends or i + 1 == len(line):
                    words = line[begin:i + 1].lower().split()
                    if words:
                        own.append((at + begin, at + i + 1, tuple(words)))
                    begin = i + 1
            at += len(line) + 1
        units.append((doc, own))
    met, out = set(), []
    for doc, own in units:
        run = []
        for unit in [*own, None]:
            if unit and unit[2] in met:
                run.append(unit)
                continue
            if run and sum(len(u[2]) for u in run) >= min_words:
                out.append((doc, run[0][0], run[-1][1], sum(len(u[2]) for u in run)))
            run = []
            if unit:
                met.add(unit[2])
    return sorted(out)


def test_sentences_inside_lines_equal_brute_force(spark):
    rng = random.Random(11)
    pool = [" ".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(rng.randint(1, 9))) for _ in range(30)]
    rows = []
    for d in range(60):
        parts = [rng.choice(pool) + rng.choice([". ", "! ", "?\n", "... ", "\n", "\n\n  \n", " "]) for _ in range(rng.randint(0, 12))]
        rows.append((d, "".join(parts)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for least in (1, 20):
        got = line_hash.repeated_spans(frame, min_words=least).collect()
        assert sorted((r["doc_id"], r["start"], r["end"], r["n_words"]) for r in got) == slow_spans(rows, least)


def test_a_passage_pasted_into_a_line_goes(spark):
    passage = " ".join(f"Sentence {i} has its own six words." for i in range(9))
    rows = [(1, f"Here. {passage} And on."), (2, f"Other words! {passage} The rest.\nLast line")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("kept_spans", line_hash.F.lit("taken"))
    [span] = line_hash.repeated_spans(frame).collect()
    assert (span["doc_id"], rows[1][1][span["start"]:span["end"]]) == (2, " " + passage)
    cut = {r["doc_id"]: r for r in line_hash.without_spans(frame).collect()}
    assert cut[2]["text"] == "Other words! The rest.\nLast line" and cut[1]["text"] == rows[0][1]
    assert cut[2]["kept_spans"] == "taken" and len(cut[2]["_kept_spans"]) == 2


def test_passages_joined_to_other_words_are_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    some = lambda n: " ".join(word() for _ in range(n))
    rows = []
    for i in range(40):  # one long sentence: no end of it is inside the passage
        passage = some(60)
        rows += [(2 * i, f"{some(30)} {passage} {some(30)}."), (2 * i + 1, f"{some(25)}. {some(9)} {passage} {some(33)}")]
    rows += [(1000 + i, some(120)) for i in range(40)]
    texts = dict(rows)
    spans = line_hash.repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = {r["doc_id"] for r in spans}
    assert found <= {2 * i + 1 for i in range(40)} and len(found) >= 36
    for r in spans:
        assert r["kept_doc_id"] == r["doc_id"] - 1
        assert texts[r["doc_id"]][r["start"]:r["end"]].strip() in texts[r["kept_doc_id"]]
        assert texts[r["kept_doc_id"]][r["kept_start"]:].startswith(texts[r["doc_id"]][r["start"]:r["end"]])


def test_tasks_hand_over_their_word_counts_in_narrow_types():
    # a task that adds up the counts gets a row of every task: eight bytes a cell made its worker the largest of the pipeline
    for top, width in ((0, 1), (255, 1), (256, 2), (70_000, 4), (1 << 33, 8)):
        counts = np.zeros(line_dedup.COUNT_PIECE, np.int64)
        counts[3] = top
        packed = line_dedup._packed(counts)
        assert len(packed) == width * line_dedup.COUNT_PIECE
        total = np.ones(line_dedup.COUNT_PIECE, np.int64)
        total += line_dedup._unpacked(packed, line_dedup.COUNT_PIECE)
        assert total.dtype == np.int64 and (total == counts + 1).all()


def test_word_counts_add_up_over_tasks(spark):
    words = ["common " * 300, "common rare", None, "", "Rare other"]
    docs = spark.createDataFrame([(t,) for t in words], "text string").repartition(3)
    got = np.zeros(line_dedup.COUNT_CELLS, np.int64)
    for r in line_dedup._word_counts(docs).collect():
        got[r["piece"] * line_dedup.COUNT_PIECE:(r["piece"] + 1) * line_dedup.COUNT_PIECE] = np.frombuffer(r["n"], np.int64)
    assert sorted(got[got > 0].tolist()) == [1, 2, 301]
