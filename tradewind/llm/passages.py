"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded; a gated attention network gives each
a weight, the weights of a document sum to one, and a logistic layer scores the weighted mean
of the encodings. Only documents have labels; which passages matter is learned from them.
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

PASSAGE_WORDS = 100
# Character classes: lower, upper, digit, space, line end, sentence mark, other mark, other letter.
CLASSES = 8
FEATURES = CLASSES * CLASSES + 6
HIDDEN, ATTENTION = 16, 8
# The bound of the training sample: labelled documents of each class.
PER_CLASS = 1_500
EPOCHS = 30
FOLD, HELD_OUT = 3, 1
PARAMETERS = ("We", "be", "V", "U", "w", "wo", "bo")

ship(__name__)


def class_table() -> np.ndarray:
    out = np.full(1 << 16, 6, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha():
            out[i] = 0 if c.islower() else 1 if c.isupper() else 7
        elif c.isdigit():
            out[i] = 2
    out[[9, 11, 12, 13, 32]] = 3
    out[10] = 4
    out[[ord(c) for c in ".,;:!?\"'()-"]] = 5
    return out


def passages(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the passages per text (at least one).

    Passages are stretches of 100 words. Features: shares of pairs of neighbouring character
    classes, mean word length, number of words, share of words that equal the one before, share
    of words seen earlier in the passage, share of words whose three-word window was seen
    earlier in the document, share of characters that are no ASCII.
    """
    flat = "\n".join(texts) + "\n"
    codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = classes[np.minimum(codes, (1 << 16) - 1)].astype(np.int64)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    doc = np.searchsorted(ends, start, "right")
    n_words = np.bincount(doc, minlength=len(texts))
    first_word = np.cumsum(n_words) - n_words
    rank = np.arange(len(start)) - first_word[doc]
    per_doc = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.cumsum(per_doc) - per_doc
    total = int(per_doc.sum())
    of_word = first[doc] + rank // PASSAGE_WORDS
    # Hash of each word: multiplicative sums between its ends.
    power = np.full(len(codes) + 1, np.uint64(0x9E3779B97F4A7C15))
    power[0] = 1
    power = np.cumprod(power)
    weighted = np.concatenate([[np.uint64(0)], np.cumsum(codes.astype(np.uint64) * power[:-1])])
    inverse = np.full(len(codes) + 1, np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64)))
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    word = (weighted[stop] - weighted[start]) * inverse[start]
    word ^= word >> np.uint64(31)
    words = np.bincount(of_word, minlength=total).astype(float)

    def share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, flag, total) / np.maximum(words, 1)

    same = np.concatenate([[False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])]) if len(word) else np.zeros(0)

    def again(key: np.ndarray) -> np.ndarray:
        """True where a key occurred earlier."""
        out = np.ones(len(key), bool)
        out[np.unique(key, return_index=True)[1]] = False
        return out

    mult = np.uint64(0xC2B2AE3D27D4EB4F)
    in_passage = again(word * mult + of_word.astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    window = np.zeros(len(word), bool)
    if len(word) > 2:
        three = (word[:-2] * mult ^ word[1:-1]) * mult ^ word[2:]
        inside = doc[:-2] == doc[2:]
        window[:-2] = again(three * mult + doc[:-2].astype(np.uint64) * np.uint64(0x165667B19E3779F9)) & inside
    length = np.bincount(of_word, (stop - start), total) / np.maximum(words, 1)
    # A character belongs to the passage of the last word that started; before any, to the first.
    last = np.maximum(np.searchsorted(start, np.arange(len(codes)), "right") - 1, 0)
    char_doc = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([[0], ends])))
    of_char = np.where(n_words[char_doc] > 0, of_word[last] if len(of_word) else 0, first[char_doc])
    of_char = np.maximum(of_char, first[char_doc])
    pair = kind[:-1] * CLASSES + kind[1:]
    grams = np.bincount(of_char[:-1] * CLASSES**2 + pair, minlength=total * CLASSES**2).reshape(total, -1).astype(float)
    grams /= np.maximum(grams.sum(1, keepdims=True), 1)
    foreign = np.bincount(of_char, codes > 127, total) / np.maximum(np.bincount(of_char, minlength=total), 1)
    extra = np.stack([length / 10, words / PASSAGE_WORDS, share(same), share(in_passage), share(window), foreign], 1)
    return np.concatenate([np.sqrt(grams), np.minimum(extra, 10)], 1).astype(np.float32), per_doc


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, per_doc: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        at = np.cumsum(per_doc) - per_doc
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ p["We"] + p["be"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        raw = (t * g) @ p["w"]
        top = np.maximum.reduceat(raw, at)
        e = np.exp(raw - np.repeat(top, per_doc))
        a = e / np.repeat(np.add.reduceat(e, at), per_doc)
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        odds = z @ p["wo"] + p["bo"][0]
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "odds": odds}

    def scores(self, x: np.ndarray, per_doc: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, per_doc)["odds"], -50, 50)))


def gradients(model: Model, x: np.ndarray, per_doc: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
    """Of the mean cross entropy plus decay, by hand."""
    p, f = model.params, model.forward(x, per_doc)
    at = np.cumsum(per_doc) - per_doc
    d_odds = (1 / (1 + np.exp(-np.clip(f["odds"], -50, 50))) - y) / len(y)
    d_z = np.repeat(d_odds[:, None] * p["wo"], per_doc, axis=0)
    d_a = (d_z * f["h"]).sum(1)
    inner = np.repeat(np.add.reduceat(f["a"] * d_a, at), per_doc)
    d_raw = f["a"] * (d_a - inner)
    d_tg = d_raw[:, None] * p["w"]
    d_t = d_tg * f["g"] * (1 - f["t"] ** 2)
    d_g = d_tg * f["t"] * f["g"] * (1 - f["g"])
    d_h = f["a"][:, None] * d_z + d_t @ p["V"].T + d_g @ p["U"].T
    d_e = d_h * (1 - f["h"] ** 2)
    out = {
        "We": f["x"].T @ d_e, "be": d_e.sum(0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g,
        "w": (f["t"] * f["g"]).T @ d_raw, "wo": f["z"].T @ d_odds, "bo": np.array([d_odds.sum()])}
    return {k: v + decay * p[k] * (k not in ("be", "bo")) for k, v in out.items()}


def train(
    x: np.ndarray, per_doc: np.ndarray, y: np.ndarray, *, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 64,
    decay: float = 1e-4, seed: int = 7,
) -> Model:
    """Adam over shuffled documents. Without both classes: the prior alone."""
    rng = np.random.default_rng(seed)
    mean = x.mean(0) if len(x) else np.zeros(FEATURES, np.float32)
    spread = (x.std(0) if len(x) else np.ones(FEATURES, np.float32)) + 1e-2
    shapes = {"We": (FEATURES, HIDDEN), "be": (HIDDEN,), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION),
              "w": (ATTENTION,), "wo": (HIDDEN,), "bo": (1,)}
    params = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) * (k not in ("be", "bo")) for k, s in shapes.items()}
    model = Model(mean, spread, params)
    if len(set(np.asarray(y).tolist())) < 2:
        share = float(np.mean(y)) if len(y) else 0.0
        params["wo"][:] = 0
        params["bo"][0] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return model
    first = {k: np.zeros(s) for k, s in shapes.items()}
    second = {k: np.zeros(s) for k, s in shapes.items()}
    at, step = np.cumsum(per_doc) - per_doc, 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            take = order[i: i + batch]
            rows = np.concatenate([np.arange(at[d], at[d] + per_doc[d]) for d in take])
            found = gradients(model, x[rows], per_doc[take], y[take], decay)
            step += 1
            for k, g in found.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] -= rate * (1 - epoch / epochs) * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _feature_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes = class_table()
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            part = batch.slice(at, 100)
            x, per_doc = passages([t or "" for t in part.column(0).to_pylist()], classes)
            cut = np.concatenate([[0], np.cumsum(per_doc)]) * FEATURES
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.ravel()))],
                ["label", "features"])


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS) -> Model:
    """Trains on at most 2 * per_class labelled documents outside the held-out fold, whole texts."""
    held_out = F.coalesce(remainder(FOLD) == HELD_OUT, F.lit(True))
    sample = labelled_sample(docs, labels, "quality", held_out, per_class)
    rows = sample.orderBy("doc_id").select("text", "label").mapInArrow(
        _feature_rows, "label int, features array<float>").toArrow()
    bags = [b.values.to_numpy(zero_copy_only=False).reshape(-1, FEATURES) for b in rows["features"]]
    x = np.concatenate(bags) if bags else np.empty((0, FEATURES), np.float32)
    return train(x, np.array([len(b) for b in bags], np.int64), rows["label"].to_numpy().astype(float))


def _scorer(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = class_table()
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                x, per_doc = passages([t or "" for t in part.column(1).to_pylist()], classes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.scores(x, per_doc), pa.float64())], ["doc_id", "score"])

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted per row of (doc_id, text).

    Row by row. A null or empty text is one passage without words.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scorer(model), "doc_id long, score double")
    return found.select(
        "doc_id", F.coalesce(remainder(FOLD) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_documents(docs, fit(docs, labels, **options))
