"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's features are itself and its character n-grams with edge marks, hashed into a table of
embeddings; a window of `window` words is the mean of its words' features, a linear softmax gives its
chance of being toxic, and a text is as toxic as its most toxic window: a slur in a long text isn't
averaged away. Embeddings and softmax are trained together by Adam on all windows' texts; unseen
misspellings share n-grams with the words they come from.

Training takes a bounded sample of labelled rows (`max_rows` of each class, the least hashes of the id;
`max_chars` of a text, spread over it in windows, is read for training only). Scores are of whole texts.

Defined cases: null and empty texts have no window and get the model's prior for an empty bag; no labels
or labels of one class give the share of toxic labels (0 without labels) for every text; several labels
of an id count as toxic if one is; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that end a word: ASCII other than letters, digits and the signs that stand in for letters.
_KEEP = b"abcdefghijklmnopqrstuvwxyz0123456789@$" + bytes(range(128, 256))
_TABLE = bytes(b if b in _KEEP else 32 for b in range(256))
SIZES = (4, 5, 6, 7)
#: The mean of a bag goes to the softmax times this, so that few features of many can decide.
SCALE = 40.0


def grams(texts: list[str | None], buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """The texts' n-grams of bytes, all at once, a word's edges being a space each.

    Returns the texts' starts in one byte string, per size (positions, buckets) of the n-grams with a space at
    their ends only, the positions where words begin, and each word's text.
    """
    raw = [b" " + (t or "").lower().encode().translate(_TABLE) + b" " for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64)
    b = np.frombuffer(b"".join(raw), np.uint8)
    space = b == 32
    # where the next space after each position is, up to the longest n-gram
    out, h = [], b.astype(np.uint32)
    inner = np.zeros(len(b), bool)
    for n in range(2, max(SIZES) + 1):
        if len(b) < n:
            break
        h = h[:-1] * np.uint32(16777619) + b[n - 1 :]
        if n > 2:
            inner = inner[: len(h)] | space[n - 2 : n - 2 + len(h)]
        else:
            inner = inner[: len(h)]
        if n in SIZES:
            at = np.flatnonzero(~inner).astype(np.int32)
            x = h[at]
            x = (x ^ (x >> np.uint32(15)) ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            out.append((at, (x >> np.uint32(32 - (buckets - 1).bit_length())).astype(np.int32)))
    begin = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    return starts, out, begin, np.searchsorted(starts, begin, "right") - 1


def windows(starts: np.ndarray, begin: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges [lo, hi) of `window` words, overlapping by half, and the text each is of. Texts without words have none."""
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.searchsorted(owner, owner, "left")
    rank = np.arange(len(begin)) - first
    left = np.searchsorted(owner, owner, "right") - np.arange(len(begin))
    head = np.flatnonzero((rank % (window // 2) == 0) & ((rank == 0) | (left > window // 2)))
    last = np.minimum(head + window, np.searchsorted(owner, owner[head], "right"))
    more = last < np.searchsorted(owner, owner[head], "right")
    hi = np.where(more, begin[np.minimum(last, len(begin) - 1)] - 1, starts[owner[head] + 1])
    return begin[head] - 1, hi, owner[head]


@dataclass
class Model:
    """What scoring needs: each bucket's embedding already taken through the softmax's two rows."""

    weight: np.ndarray
    bias: float
    window: int
    least: int
    share: float = 0.0
    prior: float | None = None

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        starts, sizes, begin, owner = grams(texts, len(self.weight))
        total, count = np.zeros(starts[-1] + 1), np.zeros(starts[-1] + 1, np.int32)
        for at, bucket in sizes:
            total[at + 1] += self.weight[bucket]
            count[at + 1] += 1
        np.cumsum(total, out=total)
        np.cumsum(count, out=count)
        lo, hi, of = windows(starts, begin, owner, self.window)
        z = np.full(len(texts), np.log(max(self.share, 1e-6) / max(1 - self.share, 1e-6)))
        if len(lo):
            mean = SCALE * (total[hi] - total[lo]) / np.maximum(count[hi] - count[lo], self.least)
            head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            z[of[head]] = self.bias + np.maximum.reduceat(mean, head)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _parts(texts: list[str], most: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about `most` characters, each with the number of its first."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > most or i == len(texts) - 1:
            yield lo, texts[lo : i + 1]
            lo, size = i + 1, 0


def fit(texts: list[str], labels: np.ndarray, share: float | None = None, buckets: int = 1 << 17, dim: int = 4, window: int = 40, epochs: int = 60, rate: float = 5.0, decay: float = 0.005, seen: int = 8, seed: int = 7) -> Model:
    """share: of toxic texts where scores are used, if the sample's differs; scores are shifted to it.

    Trains by each text's most toxic window (many windows, one label). Buckets in fewer than `seen` texts stay 0."""
    y = np.asarray(labels, np.float32)
    least = window * 12
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(2, np.float32), 0.0, window, least, prior=float(y.mean()) if len(y) else 0.0)
    # two passes over parts of the texts: only what counts is kept, so memory follows the kept n-grams
    often, size, of = np.zeros(buckets, np.int32), [], []
    for at_text, part in _parts(texts):
        starts, sizes, begin, owner = grams(part, buckets)
        lo, hi, own = windows(starts, begin, owner, window)
        of.append(own + at_text)
        n = np.zeros(len(lo))
        for at, bucket in sizes:
            n += np.searchsorted(at, hi) - np.searchsorted(at, lo)
            edge = np.searchsorted(at, starts)
            for i in range(len(part)):
                often[np.unique(bucket[edge[i] : edge[i + 1]])] += 1
        size.append(n)
    size, of = np.maximum(np.concatenate(size), least).astype(np.float32) / SCALE, np.concatenate(of)
    if not len(of):
        return Model(np.zeros(2, np.float32), 0.0, window, least, prior=float(y.mean()))
    used = np.flatnonzero(often >= seen)
    index = np.full(buckets, -1, np.int32)
    index[used] = np.arange(len(used))
    bags = []  # by part and size of n-gram: embeddings in text order, each window's range, and the part's windows
    done = 0
    for _, part in _parts(texts):
        starts, sizes, begin, owner = grams(part, buckets)
        lo, hi, _ = windows(starts, begin, owner, window)
        for at, bucket in sizes:
            e = index[bucket]
            at, e = at[e >= 0], e[e >= 0]
            bags.append((e, np.searchsorted(at, lo).astype(np.int32), np.searchsorted(at, hi).astype(np.int32), done, done + len(lo)))
        done += len(lo)
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.01, (len(used), dim)).astype(np.float32)
    soft = rng.normal(0, 1.0, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    params = (emb, soft, bias)
    state = [np.zeros_like(p) for p in params]
    head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    span = np.diff(np.append(head, len(of)))
    for step in range(1, epochs + 1):
        # the gap of logits is linear in the window's mean: running sums find each text's leading window
        line, gap = emb @ (soft[:, 1] - soft[:, 0]), np.zeros(len(of))
        for e, first, last, lo, hi in bags:
            run = np.concatenate(([0.0], np.cumsum(line[e], dtype=np.float64)))
            gap[lo:hi] += run[last] - run[first]
        gap = gap / size + bias[1] - bias[0]
        top = np.repeat(np.maximum.reduceat(gap, head), span)
        led = np.flatnonzero(gap >= top)
        led = led[np.unique(of[led], return_index=True)[1]]
        g = (1 / (1 + np.exp(-np.clip(gap[led], -30, 30))) - y[of[led]]) / len(led)
        dz = np.stack((-g, g), axis=1).astype(np.float32)
        row, feat = [], []
        for e, first, last, lo, hi in bags:
            own = np.arange(*np.searchsorted(led, [lo, hi]))
            f = first[led[own] - lo]
            n = last[led[own] - lo] - f
            feat.append(e[np.repeat(f - (np.cumsum(n) - n), n) + np.arange(n.sum())])
            row.append(np.repeat(own, n))
        row, feat = np.concatenate(row), np.concatenate(feat)
        mean = np.stack([np.bincount(row, emb[feat, k], len(led)) for k in range(dim)], axis=1).astype(np.float32) / size[led][:, None]
        dmean = (dz @ soft.T) / size[led][:, None]
        demb = np.stack([np.bincount(feat, dmean[row, k], len(used)) for k in range(dim)], axis=1).astype(np.float32)
        for par, grad, m in zip(params, (demb, mean.T @ dz, dz.sum(0)), state):
            m *= 0.9
            m += grad
            par -= (rate if par is emb else 0.01 * min(rate, 1.0)) * m
        emb *= 1 - decay
    weight = np.zeros(buckets, np.float32)
    weight[used] = emb @ (soft[:, 1] - soft[:, 0])
    share = float(y.mean()) if share is None else min(max(share, 1e-4), 1 - 1e-4)
    shift = np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    return Model(weight, float(bias[1] - bias[0] + shift), window, least, share=share)


def is_held_out(id_col) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(F.encode(id_col.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 1000) -> Model:
    """A model from at most max_rows toxic and 2 * max_rows other labelled texts, the ones with the least hashes of
    their ids; ids that are held out are never read. Only those ids are broadcast and only their texts collected."""
    own = labels.select(labels[id_col].alias("i"), labels[label_col].alias("y")).where("i IS NOT NULL AND y IS NOT NULL")
    own = own.where(~is_held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y"))
    count = {r["y"]: r["n"] for r in own.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    by = F.crc32(F.encode(F.concat(F.lit("train:"), F.col("i").cast("string")), "UTF-8"))
    some = own.where("y > 0").orderBy(by, "i").limit(max_rows).unionByName(own.where("y <= 0").orderBy(by, "i").limit(2 * max_rows))
    texts = docs.select(docs[id_col].alias("i"), F.coalesce(docs[text_col], F.lit("")).alias("t"))
    rows = texts.join(F.broadcast(some), "i").groupBy("i").agg(F.min("t").alias("t"), F.max("y").alias("y")).orderBy("i").collect()
    return fit([r["t"] for r in rows], np.array([r["y"] > 0 for r in rows]), share=count.get(True, 0) / max(sum(count.values()), 1))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", part: int = 1 << 21) -> DataFrame:
    """docs and each whole text's score between 0 and 1, computed in parts of about `part` characters."""
    if out in docs.columns:
        raise ValueError(f"there is a column {out} already")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one float a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            scores, lo, size = [], 0, 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size > part or i == len(texts) - 1:
                    scores.append(model.score(texts[lo : i + 1]))
                    lo, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
