"""Toxicity by subword-bag embeddings averaged into a linear softmax.

Every word, between marks of its ends, is the bag of its character 3- to 5-grams. A text is the
average of all its n-gram vectors, and a softmax over two classes reads that average. Vectors
and softmax are trained jointly. A word that was never seen shares the vectors of the n-grams
it has in common with known words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import ship
from tradewind.llm.labelled import labelled_sample, remainder

BUCKETS = 1 << 16
SIZE = 8
GRAMS = (3, 4, 5)
# The bound of the training sample: labelled documents of each class.
PER_CLASS = 1_500
EPOCHS = 10
FOLD, HELD_OUT = 5, 0

ship(__name__)


def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def subwords(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every text, and the text's number, texts in order."""
    flat = "\n".join(t.lower() for t in texts)
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(codes)]
    inside = letters[np.minimum(codes, (1 << 16) - 1)] | (codes >= 1 << 16)
    # Everything between words is one mark; the first and last word get one as well.
    codes = np.concatenate([[0], np.where(inside, codes, 0), [0]]).astype(np.uint64)
    owner = np.concatenate([owner[:1], owner, owner[-1:]]) if len(owner) else np.zeros(2, np.int64)
    inner = codes != 0
    gap = np.cumsum(~inner)
    found, whose = [], []
    for n in GRAMS:
        last = len(codes) - n + 1
        if last <= 0:
            continue
        value = np.full(last, n, np.uint64)
        for k in range(n):
            value = (value ^ codes[k: k + last]) * np.uint64(0x100000001B3)
            value ^= value >> np.uint64(29)
        # No mark inside, and at least two letters.
        whole = gap[n - 2: n - 2 + last] == gap[:last]
        if n > 2:
            whole &= inner[1: 1 + last]
        found.append((value[whole] % np.uint64(BUCKETS)).astype(np.int64))
        # The word's own text: that of its second character, which is a letter.
        whose.append(owner[1: 1 + last][whole])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(whose)


def bags(texts: list[str], letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different buckets and their shares, text by text."""
    out = []
    for text in texts:
        bucket, _ = subwords([text], letters)
        value, count = np.unique(bucket, return_counts=True)
        out.append((value.astype(np.int32), (count / max(1, len(bucket))).astype(np.float32)))
    return out


@dataclass
class Model:
    """Log-odds of class 1: bias plus the mean weight of a text's n-grams."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str], letters: np.ndarray) -> np.ndarray:
        bucket, whose = subwords(texts, letters)
        total = np.bincount(whose, self.weights[bucket], len(texts))
        count = np.bincount(whose, minlength=len(texts))
        odds = self.bias + total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def train(
    examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, epochs: int = EPOCHS, rate: float = 0.05,
    batch: int = 64, seed: int = 7,
) -> Model:
    """Vectors and softmax by Adam on the cross entropy. Without both classes: the prior."""
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (SIZE, BUCKETS)).astype(np.float32) / SIZE
    soft = rng.normal(0, 1, (2, SIZE)).astype(np.float32)
    offset = np.zeros(2, np.float32)
    params = [vectors, soft, offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        speed = rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            take = order[at: at + batch]
            index = np.concatenate([examples[i][0] for i in take])
            share = np.concatenate([examples[i][1] for i in take])
            row = np.repeat(np.arange(len(take)), [len(examples[i][0]) for i in take])
            mean = np.stack([np.bincount(row, v[index] * share, len(take)) for v in vectors], 1)
            logits = mean @ soft.T + offset
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(take)), labels[take]] -= 1
            p /= len(take)
            back = p @ soft
            grads = [
                np.stack([np.bincount(index, share * back[row, d], BUCKETS) for d in range(SIZE)]).astype(np.float32),
                (p.T @ mean).astype(np.float32), p.sum(0).astype(np.float32)]
            step += 1
            for value, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(((soft[1] - soft[0]) @ vectors).astype(np.float32), float(offset[1] - offset[0]))


def _bag_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    for batch in batches:
        found = bags([t or "" for t in batch.column(0).to_pylist()], letters)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array([b for b, _ in found], pa.list_(pa.int32())),
             pa.array([s for _, s in found], pa.list_(pa.float32()))], ["label", "buckets", "shares"])


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS) -> Model:
    """Trains on at most 2 * per_class labelled documents outside the held-out fold, whole texts.

    Their bags are made on the executors; the driver gets numbers only.
    """
    sample = labelled_sample(docs, labels, "toxic", F.coalesce(remainder(FOLD) == HELD_OUT, F.lit(True)), per_class)
    rows = sample.select("doc_id", "text", "label").orderBy("doc_id").select("text", "label").mapInArrow(
        _bag_rows, "label int, buckets array<int>, shares array<float>").toArrow()
    examples = [
        (np.asarray(b.values.to_numpy(zero_copy_only=False)), np.asarray(s.values.to_numpy(zero_copy_only=False)))
        for b, s in zip(rows["buckets"], rows["shares"])]
    return train(examples, rows["label"].to_numpy())


def _scorer(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                scores = model.scores([t or "" for t in part.column(1).to_pylist()], letters)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted per row of (doc_id, text).

    Row by row. A text without letters gets the score of an empty bag, from the bias alone.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scorer(model), "doc_id long, score double")
    return found.select(
        "doc_id", F.coalesce(remainder(FOLD) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_documents(docs, fit(docs, labels, **options))
