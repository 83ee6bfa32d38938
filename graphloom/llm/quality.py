"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words. A passage is encoded from its bytes:
shares of each byte and of hashed byte pairs, and a few word statistics. The model maps a passage to a
hidden vector, gives it a gated attention weight, and scores the weighted mean of the document's
passages; encoder, attention and scorer are learned together from document labels alone. It is
fitted in the driver on a bounded sample of labelled documents, whose passages the executors
encode; every whole document is then scored where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from graphloom.llm.common import fresh_name, release_memory, small_frame

PASSAGE_WORDS = 64
# hashed byte pairs; further statistics of a passage
PAIR_BINS, EXTRAS = 256, 6
FEATURES = 256 + PAIR_BINS + EXTRAS
HIDDEN, GATE = 24, 16
# the sample's bounds: whole documents, and passages of all of them together (training only)
SAMPLE_DOCS, SAMPLE_PASSAGES = 2500, 40_000
EPOCHS, RATE, DECAY, BATCH = 30, 0.01, 1e-4, 64
FOLDS = 5
THRESHOLD = 0.3
SEED = 4
# white space of bytes.split, as a pattern
WORD_BREAK = r"[ \t\n\r\x0b\f]+"
# words encoded at once: bounds the memory of a very long text
ENCODE_WORDS = 64 * 256


def encode(text: str | None) -> np.ndarray:
    """(passages, FEATURES) float32; a text without words is one passage of zeros."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    return np.concatenate([_encode(words[at:at + ENCODE_WORDS]) for at in range(0, len(words), ENCODE_WORDS)])


def _encode(words: list[bytes]) -> np.ndarray:
    n = len(words)
    passages = -(-n // PASSAGE_WORDS)
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    home = np.arange(n) // PASSAGE_WORDS
    at = np.repeat(home, lengths + 1)
    size = np.bincount(at, minlength=passages).astype(np.float32)[:, None]
    single = np.bincount(at * 256 + chars, minlength=passages * 256).reshape(passages, 256)
    pair = (chars[:-1] * 31 + chars[1:] * 7) % PAIR_BINS
    pairs = np.bincount(at[:-1] * PAIR_BINS + pair, minlength=passages * PAIR_BINS).reshape(passages, PAIR_BINS)
    count = np.bincount(home, minlength=passages).astype(np.float32)
    mean = np.bincount(home, lengths, passages) / count
    spread = np.sqrt(np.maximum(np.bincount(home, lengths.astype(float) ** 2, passages) / count - mean ** 2, 0))
    again = np.fromiter((a == b for a, b in zip(words, words[1:])), np.int64, n - 1)
    inside = home[1:] == home[:-1]
    repeats = np.bincount(home[1:][inside], again[inside], passages) / count
    distinct = np.array([len(set(words[i:i + PASSAGE_WORDS])) for i in range(0, n, PASSAGE_WORDS)]) / count
    extra = np.stack([mean / 10, spread / 10, repeats, distinct, count / PASSAGE_WORDS, np.log1p(count) / 5], axis=1)
    return np.concatenate([np.sqrt(single / size), np.sqrt(pairs / size), extra], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """``weights`` None: nothing to learn from; every score is ``prior``."""

    prior: float
    weights: dict[str, np.ndarray] | None = None

    def parts(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Forward pass over the passages ``x`` of bags that begin at rows ``starts``."""
        w = self.weights
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        x = (x - w["mean"]) / w["scale"]
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * g) @ w["a"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        att = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(att[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "g": g, "att": att, "z": z, "bag": bag, "p": _sigmoid(z @ w["c"] + w["d"][0])}

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(starts), self.prior)
        return self.parts(x, starts)["p"].astype(np.float64)


def fit(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Adam on the log loss; the bags' order and a fixed seed decide the result."""
    if not len(bags):
        return Model(0.5)
    prior = float(labels.mean())
    if prior in (0.0, 1.0):
        return Model(prior)
    rng = np.random.default_rng(SEED)
    allx = np.concatenate(bags)
    norm = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"W": norm(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": norm(HIDDEN, GATE), "U": norm(HIDDEN, GATE),
         "a": norm(GATE), "c": norm(HIDDEN), "d": np.array([np.log(prior / (1 - prior))], np.float32)}
    model = Model(prior, {**w, "mean": allx.mean(axis=0), "scale": allx.std(axis=0) + 0.01})
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), BATCH):
            some = order[at:at + BATCH]
            sizes = np.array([len(bags[i]) for i in some])
            f = model.parts(np.concatenate([bags[i] for i in some]), np.cumsum(sizes) - sizes)
            grad = _gradient(model.weights, f, labels[some])
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in grad.items():
                g = g + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                model.weights[k] = w[k]
    return model


def _gradient(w: dict, f: dict, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss through scorer, attention, gates and encoder."""
    dp = (f["p"] - y) / len(y)
    dz = dp[:, None] * w["c"]
    dzi = dz[f["bag"]]
    de = f["att"] * ((dzi * f["h"]).sum(axis=1) - (dz * f["z"]).sum(axis=1)[f["bag"]])
    dgate = de[:, None] * w["a"]
    dt, dg = dgate * f["g"] * (1 - f["t"] ** 2), dgate * f["t"] * f["g"] * (1 - f["g"])
    dh = (dzi * f["att"][:, None] + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
    return {"c": f["z"].T @ dp, "d": np.array([dp.sum()]), "a": (f["t"] * f["g"]).T @ de, "V": f["h"].T @ dt,
            "U": f["h"].T @ dg, "W": f["x"].T @ dh, "b": dh.sum(axis=0)}


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo ``FOLDS``; a null key counts as empty text. 0: held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_docs: int = SAMPLE_DOCS, sample_passages: int = SAMPLE_PASSAGES) -> Model:
    """Fit on at most ``sample_docs`` labelled documents outside the held-out fold.

    The sample is whole documents, in order of the MD5 of their key, at most ``sample_docs`` of at most
    ``sample_passages`` passages together (the sample is bounded by these parameters); one that is longer than
    what is left of the passages is passed over. Several labels of one key count with their mean; null labels and keys
    are left out; of several documents with one key each text counts once. Only the sample's encoded passages come to
    the driver. No label at all gives scores of 0.5.
    """
    spark = docs.sparkSession
    digest = F.md5(F.col("k").cast("string").cast("binary"))
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("double").alias("y")).where("k is not null and y is not null")
             .groupBy("k").agg(F.avg("y").alias("y")).where(fold(F.col("k")) != 0)
             .orderBy(digest, "k").limit(sample_docs))
    # at most sample_docs rows: a proven bound for the broadcast
    body = F.coalesce(F.col("t"), F.lit(""))
    rows = (docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(known), "k")
            .select(F.col("k").cast("string").alias("k"), "y", body.alias("t"), F.sha2(body, 256).alias("h")))
    words = F.size(F.filter(F.split("t", WORD_BREAK), lambda w: w != ""))
    passages = F.greatest(F.ceil(words / PASSAGE_WORDS), F.lit(1)).alias("passages")
    first = F.md5(F.col("k").cast("binary"))
    chosen, left = [], sample_passages
    for r in rows.select("k", "h", passages).distinct().orderBy(first, "k", "h").limit(sample_docs).collect():
        if r["passages"] <= left:
            chosen.append((r["k"], r["h"]))
            left -= r["passages"]
    if not chosen:
        return fit([], np.zeros(0, np.float32))
    # at most sample_docs rows again
    sample = F.broadcast(small_frame(spark, chosen, StructType().add("k", "string").add("h", "string")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            bags = [encode(t).astype("<f2").tobytes() for t in part["t"]]
            yield pd.DataFrame({"k": part["k"], "h": part["h"], "y": part["y"], "bag": bags})

    once = rows.join(sample, ["k", "h"]).groupBy("k", "h").agg(F.first("y").alias("y"), F.first("t").alias("t"))
    found = once.mapInPandas(run, "k string, h string, y double, bag binary").orderBy(first, "k", "h").collect()
    bags = [np.frombuffer(r["bag"], "<f2").reshape(-1, FEATURES).astype(np.float32) for r in found]
    return fit(bags, np.array([r["y"] for r in found], np.float32))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
          keep_text: bool = False) -> DataFrame:
    """Columns of ``docs`` (``text`` only if ``keep_text``) with ``held_out``, ``score``, ``predicted``.

    Each row is scored by its whole text alone. A null or empty text is a bag of one empty passage. Rows that
    repeat get equal scores; an empty table gives no rows. Result columns whose name the input has get underscores.
    """
    rest = [f for f in docs.schema.fields if keep_text or f.name != text]
    held, value, predicted = (fresh_name(docs.columns, n) for n in ("held_out", "score", "predicted"))
    fields = [StructField(held, BooleanType()), StructField(value, DoubleType()), StructField(predicted, IntegerType())]
    # the model is a few tens of kilobytes whatever the data
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = fresh_name([*docs.columns, held], "_text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for part in batches:
            out = part.drop(columns=[body])
            scores = np.empty(len(part))
            held_rows, bags, size = [], [], 0
            for i, t in enumerate(part[body]):
                bags.append(encode(t))
                held_rows.append(i)
                size += len(bags[-1])
                if size > 4096 or i == len(part) - 1:
                    sizes = np.array([len(b) for b in bags])
                    scores[held_rows] = model.score(np.concatenate(bags), np.cumsum(sizes) - sizes)
                    held_rows, bags, size = [], [], 0
            out[value] = scores
            out[predicted] = (scores >= threshold).astype(np.int32)
            yield out
        release_memory()

    rows = docs.select(*[f.name for f in rest], (fold(F.col(key)) == 0).alias(held), F.col(text).alias(body))
    return rows.mapInPandas(run, StructType([*rest, *fields]))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              threshold: float = THRESHOLD, **sample) -> DataFrame:
    """``docs`` that the classifier, trained on the labelled ones among them, predicts as good."""
    scored = score(docs, train(docs, labels, key, text, **sample), key, text, threshold, keep_text=True)
    predicted = scored.columns[-1]
    return scored.where(F.col(predicted) == 1).select(*docs.columns)
