"""Personal data: base patterns, and a trained character tagger for other ways of writing it.

The tagger learns from spans that the base patterns label in a bounded sample, and from the
same spans rewritten (a telephone number without its country sign, other separators). It reads
the surroundings of every digit, at-sign and "(at)" of every text, out to the ends of the runs of
address characters there, in overlapping windows; their scores are averaged where windows overlap and each stretch is decoded as a whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tradewind.llm import tagger
from tradewind.llm.common import ship, stored
from tradewind.llm.spans import Span, find_spans

ship(__name__)

# The base kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
# Digits are taken as a whole and from their first: a later start in the same run fails alike.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
METHOD_KINDS = tuple(f"{k}_tagged" for k in KINDS)

AROUND, WINDOW, STRIDE = 16, 48, 24
TRIGGER = re.compile(r"[0-9@]|\(at\)")
RUN = re.compile(r"[A-Za-z0-9._%+-]*+")
# The bound of the training sample: different stretches of text, chosen by hash, half of them with base spans.
TRAIN_STRETCHES = 1_000
TAGS = 1 + 2 * len(KINDS)
CONFIDENCE = 0.8


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, leftmost and not overlapping, in linear time.

    A match must reach an at-sign through the whole run of local characters before it.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in emails(text)]
    if not re.search(r"[0-9]", text):
        return spans
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], order[s[0]]))


def stretches(text: str) -> list[tuple[int, int]]:
    """Surroundings of digits, at-signs and "(at)", with whole runs of address characters, joined where they meet.

    All kinds, and all ways of writing that `rewritten` makes, need one of these.
    """
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        done = out[-1][1] if out else 0
        if b <= done:
            continue
        b = RUN.match(text, b).end() if text[b - 1] in LOCAL else b
        # No run goes on beyond the last end, so each character is looked at once.
        while a > done and text[a - 1] in LOCAL and text[a] in LOCAL:
            a -= 1
        if out and a <= done:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def rewritten(text: str, spans: list[tuple[str, int, int]], turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The stretch with its spans written in another way."""
    out, moved, at = [], [], 0
    for kind, a, b in spans:
        if a < at:
            continue
        value = text[a:b]
        if kind == "phone":
            value = (re.sub(r"^\+[0-9]{1,3}[\x20-]?", "", value), "00" + value[1:])[turn % 2]
        elif kind == "card":
            value = (".", "/")[turn % 2].join(re.findall(r"[0-9]{1,4}", digits_of(value)))
        elif kind == "email":
            value = value.replace("@", (" @ ", "(at)")[turn % 2])
        out += [text[at:a], value]
        begin = sum(map(len, out)) - len(value)
        moved.append((kind, begin, begin + len(value)))
        at = b
    return "".join(out) + text[at:], moved


def tag_row(text: str, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(len(text), np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        if not out[a:b].any():
            out[a:b] = 2 + 2 * k
            out[a] = 1 + 2 * k
    return out


def windows_of(length: int) -> list[int]:
    """Starts of overlapping windows that cover a stretch."""
    if length <= WINDOW:
        return [0]
    return [*range(0, length - WINDOW, STRIDE), length - WINDOW]


def _labelled(most: int):
    """Different stretches with labels, and those without: of each the `most` least by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[set, set] = (set(), set())
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text or not TRIGGER.search(text):
                    continue
                spans = base_spans(text)
                for a, b in stretches(text):
                    inside = [(k, s - a, e - a) for k, s, e in spans if s < b and e > a]
                    cut = [(k, max(0, s), min(b - a, e)) for k, s, e in inside]
                    b = min(b, a + 8 * WINDOW)
                    labels = tuple(f"{k}:{s}:{e}" for k, s, e in cut if e <= b - a)
                    mine = held[bool(labels)]
                    mine.add((xxhash.xxh3_64_intdigest(text[a:b]) >> 1, text[a:b], labels))
                    if len(mine) > 4 * most:
                        least = heapq.nsmallest(most, mine)
                        mine.clear()
                        mine.update(least)
        rows = [r for mine in held for r in heapq.nsmallest(most, mine)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([list(r[2]) for r in rows], pa.list_(pa.string()))], ["hash", "stretch", "labels"])

    return run


def training_rows(docs: DataFrame, most: int = TRAIN_STRETCHES) -> list[Row]:
    """At most `most` different (stretch, labels), half of them with labels and half without, by hash.

    A stretch that many texts repeat counts once. Tasks hand on the least hashes only, which hold
    the least of all.
    """
    half = -(-most // 2)
    found = stored(docs.select("text").mapInArrow(
        _labelled(half), "hash long, stretch string, labels array<string>").groupBy("stretch", "labels").agg(
            F.min("hash").alias("hash")), "stretches")
    order = ("hash", "stretch", "labels")
    return [row for bound, kind in ((half, F.size("labels") > 0), (most - half, F.size("labels") == 0))
            for row in found.where(kind).orderBy(*order).limit(bound).collect()]


def fit(docs: DataFrame, *, most: int = TRAIN_STRETCHES, seed: int = 7) -> tagger.Tagger | None:
    """Trains on at most `most` different stretches; None if no text has any labelled span."""
    rows = training_rows(docs, most)
    codes, gold = [], []
    for i, row in enumerate(rows):
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in row["labels"])]
        variants = [(row["stretch"], spans)] + ([rewritten(row["stretch"], spans, i)] if spans else [])
        for text, marked in variants:
            c, g = tagger.encode(text), tag_row(text, marked)
            for s in windows_of(len(text)):
                pad = max(0, WINDOW - len(text))
                codes.append(np.pad(c[s: s + WINDOW], (0, pad), constant_values=98))
                gold.append(np.pad(g[s: s + WINDOW], (0, pad)))
    if not gold or not np.any(gold):
        return None
    return tagger.train(np.array(codes), np.array(gold), TAGS, seed=seed)


def plausible(kind: str, value: str) -> bool:
    digits = digits_of(value)
    if kind == "email":
        return "@" in value or "(at)" in value
    if kind == "ip":
        parts = re.findall(r"[0-9]+", value)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15 and len(value) <= 2 * len(digits) + 6


def tagged(model: tagger.Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans the tagger finds in stretches: windows scored together, averaged, decoded per stretch."""
    windows, where = [], []
    for i, text in enumerate(texts):
        c = tagger.encode(text)
        for s in windows_of(len(text)):
            windows.append(np.pad(c[s: s + WINDOW], (0, max(0, WINDOW - len(text))), constant_values=98))
            where.append((i, s))
    sums = [np.zeros((len(t), TAGS)) for t in texts]
    for at in range(0, len(windows), 512):
        scores = model.emissions(np.array(windows[at: at + 512]))
        for (i, s), found in zip(where[at: at + 512], scores):
            n = min(WINDOW, len(texts[i]) - s)
            # The middle of a window has seen more on both sides.
            weight = 1 + np.minimum(np.arange(n), n - 1 - np.arange(n))[:, None]
            sums[i][s: s + n] += weight * found[:n]
    out = []
    for i, text in enumerate(texts):
        weights = np.zeros(len(text))
        for s in windows_of(len(text)):
            n = min(WINDOW, len(text) - s)
            weights[s: s + n] += 1 + np.minimum(np.arange(n), n - 1 - np.arange(n))
        scores = sums[i] / np.maximum(weights, 1)[:, None]
        tags = model.decode(scores)
        chance = np.exp(scores - scores.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        spans, start = [], 0
        while start < len(text):
            if tags[start] == 0:
                start += 1
                continue
            k, end = (tags[start] - 1) // 2, start + 1
            while end < len(text) and tags[end] == 2 + 2 * k:
                end += 1
            kind = KINDS[k]
            sure = float((chance[start:end, 1 + 2 * k] + chance[start:end, 2 + 2 * k]).mean())
            if sure >= CONFIDENCE and plausible(kind, text[start:end]):
                spans.append((f"{kind}_tagged", start, end, kind, sure))
            start = end
        out.append(spans)
    return out


def scan(texts: list[str], model: tagger.Tagger | None) -> list[list[Span]]:
    """Base spans of every text and tagger spans that overlap none of them, by start, then kind."""
    base = [[(k, a, b, k, 1.0) for k, a, b in base_spans(t)] for t in texts]
    if model is None:
        return base
    pieces, origin = [], []
    for i, text in enumerate(texts):
        for a, b in stretches(text):
            pieces.append(text[a:b])
            origin.append((i, a))
    order = {k: n for n, k in enumerate((*KINDS, *METHOD_KINDS))}
    for (i, a), spans in zip(origin, tagged(model, pieces)):
        for kind, s, e, target, score in spans:
            if not any(s + a < y and x < e + a for _, x, y, _, _ in base[i]):
                base[i].append((kind, s + a, e + a, target, score))
    return [sorted(found, key=lambda s: (s[1], order[s[0]])) for found in base]


def find_private(docs: DataFrame, *, model: tagger.Tagger | None = None, most: int = TRAIN_STRETCHES) -> DataFrame:
    """(doc_id, spans) per row of (doc_id, text), each span with kind, place and confidence.

    The tagger is trained on the documents themselves unless given. Whole texts, row by row.
    A null or empty text has no spans; repeated rows and null ids are passed on.
    """
    fitted = model or fit(docs, most=most)
    return find_spans(docs, lambda: lambda texts: scan(texts, fitted))
