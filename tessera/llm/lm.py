"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

P(word | before) = P(class | before) * P(word | class, before). The `vocab` most frequent training words
are dealt to `heads` classes of near even mass; all other words fall by their last two bytes into `tails`
classes, in which a word has its smoothed share of counts. Both factors of a frequent word, and the class
of a rare one, are log-linear in hashed features of the three words before: the last word, the last but
one (a skip), both together, and the last but two. Before a word, the `contexts` most frequent words stand
for themselves and others for their last three bytes.

Training runs on the counts of all words with the three before. Weights start from sums over all trainers:
a feature's weight for a class is START times the log of how much likelier the class is where the feature
holds. Then come rounds of distributed gradient updates: every trainer goes through its share in
minibatches, and the changes are averaged by how often each feature row was met. Counts, gradients and
scores cover all documents. Contexts and feature tables grow with the square root of the number of
distinct words, the vocabulary with its fourth root, up to MOST_GROWTH; `known`, the hashed words that
are broadcast, is fixed.

Base model: sum over tokens of log10((c + 0.1) / (N + 0.1 (V + 1))). Words outside the broadcast table get
their counts by a join, so both scores are exact in the counts whatever the vocabulary's size.

Defined cases: null and empty texts have one token, the end; with nothing to train on N is 0 and all
words are unknown; repeated rows are scored alike; an empty table gives no rows. Words are told apart by
64-bit hashes. How many trainers share the work follows from the number of counts, not from the cluster;
which counts a trainer gets, and so the last digits of `score`, follows from how the input is split into tasks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import discard, stored

END = b"\n"  # no word holds white space
SMOOTH = 0.1
#: Distinct words for which Shape's own sizes are meant, and how far they grow.
GROWS_FROM = 400_000
MOST_GROWTH = 8
#: Each trainer sends its tables' sums once and their changes once a round, some 40 MB whatever its share of the counts: so their
#: number follows the counts, above a few that small inputs need to use more than one core.
MOST_TRAINERS = 64
LEAST_TRAINERS = 4
TRAINER_ROWS = 13_000_000
#: Share of the log ratio of counts that a weight starts with (features overlap), and the pseudo-count of what is expected.
START = 0.4
PRIOR = 4.0
#: How much each earlier meeting of a feature row in a round calms its next step.
SETTLE = 0.1


def word_hash(w: bytes) -> int:
    h = xxhash.xxh64_intdigest(w)
    return h - (1 << 64) if h >= 1 << 63 else h


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word of a large_binary array begins, its length, and all bytes."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return at[:-1], np.diff(at), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def _xxh64_short(at: np.ndarray, n: np.ndarray, data: np.ndarray) -> np.ndarray:
    """xxh64 of words of less than 32 bytes, all at once: calls for single words took most of the time to read a text."""
    one, two, three, four, five = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, k: x << np.uint64(k) | x >> np.uint64(64 - k)
    h = n.astype(np.uint64) + five

    def stir(own: np.ndarray, where: np.ndarray, size: int, mix: Callable, k: int, by: np.uint64, plus: np.uint64) -> None:
        """For the words own: takes in the size bytes at where."""
        if len(own):
            lanes = np.ndarray(len(data) - size + 1, f"<u{size}", data, strides=(1,))
            h[own] = turn(h[own] ^ mix(lanes[where].astype(np.uint64)), k) * by + plus

    for lane in range(0, 24, 8):
        own = np.flatnonzero(n >= lane + 8)
        stir(own, at[own] + lane, 8, lambda x: turn(x * two, 31) * one, 27, one, four)
    own = np.flatnonzero(n & 4)
    stir(own, at[own] + (n[own] & ~7), 4, lambda x: x * one, 23, two, three)
    for j in range(3):
        own = np.flatnonzero((n & 3) > j)
        stir(own, at[own] + (n[own] & ~3) + j, 1, lambda x: x * five, 11, one, np.uint64(0))
    h = (h ^ h >> np.uint64(33)) * two
    h = (h ^ h >> np.uint64(29)) * three
    return h ^ h >> np.uint64(32)


def word_hashes(words: list[bytes] | pa.Array) -> np.ndarray:
    """word_hash of each."""
    if not isinstance(words, pa.Array):
        words = pa.array(words, pa.large_binary())
    at, n, data = _bytes(words)
    h, long = np.empty(len(n), np.uint64), n >= 32
    if long.any():
        own = np.flatnonzero(long)
        h[own] = [xxhash.xxh64_intdigest(data[i : i + k]) for i, k in zip(at[own].tolist(), n[own].tolist())]
        own = np.flatnonzero(~long)
        h[own] = _xxh64_short(at[own], n[own], data)
    else:
        h = _xxh64_short(at, n, data)
    return h.view(np.int64)


#: Of crc32: what a byte adds.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = CRC >> np.uint32(1) ^ (CRC & np.uint32(1)) * np.uint32(0xEDB88320)


def suffix_codes(words: pa.Array, size: int, most: int) -> np.ndarray:
    """crc32 of each word's last bytes, below most."""
    at, n, data = _bytes(words)
    crc = np.full(len(n), 0xFFFFFFFF, np.uint32)
    for back in range(size, 0, -1):
        own = np.flatnonzero(n >= back)
        crc[own] = CRC[crc[own] & np.uint32(255) ^ data[at[own] + n[own] - back]] ^ crc[own] >> np.uint32(8)
    return (~crc).astype(np.int64) % most


def chunks(batch: pa.RecordBatch, col: int, most: int = 1 << 21) -> Iterator[tuple[list[int], list[bytes | None]]]:
    """Row numbers and lower-cased UTF-8 texts of a batch, about `most` bytes at a time."""
    rows, texts, size = [], [], 0
    for i, v in enumerate(batch.column(col).cast(pa.binary())):
        t = (v.as_py() or b"").lower()  # bytes.lower() knows A-Z only
        rows.append(i)
        texts.append(t)
        size += len(t)
        if size > most:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


@dataclass
class Shape:
    """Sizes of the model. A code holds the symbols of the three words before and of the word itself."""

    vocab: int = 1000
    heads: int = 24
    tails: int = 56
    contexts: int = 8000
    suffixes: int = 2048
    known: int = 1 << 19
    rows: int = 1 << 16
    width: int = 64

    @classmethod
    def of(cls, distinct: int) -> Shape:
        """The sizes for so many distinct words; rows stay a power of two, and a code within 63 bits."""
        by = min(max(1.0, math.sqrt(distinct / GROWS_FROM)), MOST_GROWTH)
        slow = math.sqrt(by)
        return cls(
            vocab=round(cls.vocab * slow),
            heads=round(cls.heads * math.sqrt(slow)),
            width=round(cls.width * math.sqrt(slow)),
            contexts=round(cls.contexts * by),
            suffixes=round(cls.suffixes * by),
            rows=cls.rows << int(math.log2(by)) // 2,
        )

    @property
    def word_bits(self) -> int:
        return max(10, (self.vocab + self.tails).bit_length())

    @property
    def context_bits(self) -> int:
        return (self.contexts + self.suffixes + 2).bit_length()

    @property
    def row_type(self) -> type:
        return np.uint16 if self.rows <= 1 << 16 else np.uint32

    @property
    def classes(self) -> int:
        return self.heads + self.tails


@dataclass
class Params:
    shape: Shape
    hashes: np.ndarray  # sorted hashes of the known words
    counts: np.ndarray
    word: np.ndarray  # by known word: its rank, or -1 from shape.contexts on
    cls: np.ndarray  # by vocabulary word: class, and place in the class
    place: np.ndarray
    class_bias: np.ndarray
    word_bias: np.ndarray  # (heads, width), -inf where a class has no such word
    tail_mass: np.ndarray  # log10 of each tail class's denominator
    class_rows: np.ndarray
    word_rows: np.ndarray
    total: int
    distinct: int
    power: bool = False  # rows and biases hold exponentials


def split_words(texts: list[bytes]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many pieces each text falls into at the white space of bytes.split(), and the pieces; those at the ends may be empty."""
    parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
    return np.diff(parts.offsets.to_numpy()), parts.flatten().view(pa.large_binary()).dictionary_encode()


def read_chunk(texts: list[bytes], p: Params) -> dict[str, np.ndarray]:
    """Tokens of texts as local ids, by local id its hash, count and symbol, and by token the code of the symbols before and its own."""
    s = p.shape
    pieces, words = split_words(texts)
    ids, text = words.indices.to_numpy(), np.repeat(np.arange(len(texts)), pieces)
    blank = words.dictionary.index(b"").as_py()
    if blank >= 0:
        keep = np.flatnonzero(ids != blank)
        ids, text = ids[keep], text[keep]
    words = pa.concat_arrays([pa.array([END], pa.large_binary()), words.dictionary])
    n = np.bincount(text, minlength=len(texts)) + 1
    ends = np.cumsum(n)
    inner = np.ones(len(ids) + len(texts), bool)
    inner[ends - 1] = False
    flat = np.zeros(len(inner), np.int32)
    flat[inner] = ids + 1
    h = word_hashes(words)
    if len(p.hashes):
        order, at = np.argsort(h), np.empty(len(h), np.intp)
        at[order] = np.minimum(np.searchsorted(p.hashes, h[order]), len(p.hashes) - 1)  # in order, for the cache
        found = p.hashes[at] == h
        count, voc = np.where(found, p.counts[at], -1), np.where(found, p.word[at], -1)
    else:
        count = voc = np.full(len(h), -1)
    sym = np.where((voc < 0) | (voc >= s.vocab), s.vocab + suffix_codes(words, 2, s.tails), voc)
    context = np.where(voc < 0, s.contexts + suffix_codes(words, 3, s.suffixes), voc)
    y, around = sym[flat], context[flat]
    pos = np.arange(len(flat)) - np.repeat(ends - n, n)
    none = s.contexts + s.suffixes  # start symbols: none right before the text, none + 1 further before
    code = np.zeros(len(flat), np.int64)
    for k in (3, 1, 2):
        lead, before = np.flatnonzero(pos < k), np.roll(around, k)
        before[lead] = none + np.minimum(k - pos[lead] - 1, 1)
        code <<= s.context_bits
        code |= before
    return {"n": n, "ends": ends, "h": h, "flat": flat, "count": count, "y": y, "code": code << s.word_bits | y}


def decode(code: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of codes: feature rows (n, 4), class, place in the class or -1."""
    s = p.shape
    low, rest = (1 << s.context_bits) - 1, code >> s.word_bits
    y, b, a, c = code & ((1 << s.word_bits) - 1), rest & low, rest >> s.context_bits & low, rest >> 2 * s.context_bits
    mix = lambda x, k: ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xC2B2AE3D27D4EB4F % (1 << 64))) >> np.uint64(64 - (s.rows - 1).bit_length())).astype(s.row_type)
    cls, place = s.heads + y - s.vocab, np.full(len(y), -1, np.int32)
    own = np.flatnonzero(y < s.vocab)
    cls[own], place[own] = p.cls[y[own]], p.place[y[own]]
    return np.stack((mix(a, 1), mix(b, 2), mix(a << s.context_bits | b, 3), mix(c, 4)), axis=1), cls, place


def word_features(f: np.ndarray, cls: np.ndarray, rows: int) -> np.ndarray:
    """(n, 2) rows of the table of words in a class: the last word and the skip, each with the class."""
    return ((f[:, :2].astype(np.int64) * 31 + cls[:, None].astype(np.int64) * 7919) % rows).astype(f.dtype)


def _exp_rows(z: np.ndarray) -> np.ndarray:
    """exp of z in place, scaled by row so that nothing overflows; its row sums."""
    if len(z) and z.max() > 60:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    return z @ np.ones(z.shape[1], z.dtype)


def _room(name: str, n: int, width: int, held: dict[str, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    """Space for n rows, used again by the next call of that name: new pages for every batch cost more than the sums in them."""
    if name not in held or held[name].size < n * width:
        held[name] = np.empty(n * width + n * width // 8, np.float32)
    return held[name][: n * width].reshape(n, width)


def _sum_rows(table: np.ndarray, f: np.ndarray, bias: np.ndarray, join: np.ufunc = np.add) -> np.ndarray:
    """Sums (or products) of the rows f (k, n) of table, and the bias; good until the next call."""
    z, part = _room("z", f.shape[1], table.shape[1]), _room("part", f.shape[1], table.shape[1])
    np.take(table, f[0], 0, out=z, mode="clip")
    for own in f[1:]:
        join(z, np.take(table, own, 0, out=part, mode="clip"), out=z)
    return join(z, bias, out=z)


#: Members of a run that are summed one at a time, over all runs at once; the others are summed run by run.
RUN = 32


def _runs(f: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of feature rows (n, k): the examples ordered by feature row, the distinct rows by falling number of examples, where each one's
    run begins, how long it is, and the weight of its examples. A run of more than 65,535 counts as one of these."""
    flat = f.T.ravel()
    order = np.argsort(flat, kind="stable")
    rows = flat[order]
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    n = np.diff(np.append(start, len(rows)))
    order %= len(f)
    seen = np.add.reduceat(w[order], start)
    lead = np.argsort((65535 - np.minimum(n, 65535)).astype(np.uint16), kind="stable")
    start = start[lead]
    return order, rows[start].astype(np.intp), start, n[lead], seen[lead]


def _sum_runs(x: np.ndarray, order: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of the rows of x that each run names, runs by falling length."""
    longer = np.searchsorted(-n, -np.arange(RUN + 1), "left")
    out, part = _room("runs", len(n), x.shape[1]), _room("part", max(len(n), len(order)), x.shape[1])
    np.take(x, order[start], 0, out=out, mode="clip")
    for j in range(1, RUN):
        m = longer[j]
        if not m:
            break
        out[:m] += np.take(x, order[start[:m] + j], 0, out=part[:m], mode="clip")
    for i in range(longer[RUN]):
        out[i] += np.take(x, order[start[i] + RUN : start[i] + n[i]], 0, out=part[: n[i] - RUN], mode="clip").sum(axis=0)
    return out


def _step(table: np.ndarray, met: np.ndarray, f: np.ndarray, bias: np.ndarray, own: np.ndarray, w: np.ndarray, rate: float, calm: float, block: int = 512) -> None:
    """Moves the rows f of table against the gradients of examples of weights w whose columns own are right, by their mean in the
    batch, less where a row is rarely met there and the more it was met before. A row is written once."""
    order, at, start, n, seen = _runs(f, w)
    g = _sum_rows(table, np.ascontiguousarray(f.T), bias)
    g *= (w / _exp_rows(g))[:, None]
    g[np.arange(len(own)), own] -= w
    total = _sum_runs(g, order, start, n)
    met[at] += seen
    pace = (-rate / (seen + calm + SETTLE * met[at]))[:, None]
    whole = np.dtype((np.void, table.shape[1] * table.itemsize))  # a row as one value: moved at once
    rows = table.view(whole).ravel()
    for lo in range(0, len(at), block):
        x = at[lo : lo + block]
        part = total[lo : lo + block]
        part *= pace[lo : lo + block]
        part += np.take(table, x, 0, out=_room("old", len(x), table.shape[1]), mode="clip")
        np.put(rows, x, part.view(whole))


def train_codes(p: Params, met: tuple[np.ndarray, np.ndarray], code: np.ndarray, count: np.ndarray, rate: float, calm: float = 4.0, batch: int = 4096) -> None:
    f, cls, place = decode(code, p)
    wf, w = word_features(f, cls, p.shape.rows), count.astype(np.float32)
    for lo in range(0, len(code), batch):
        x = slice(lo, lo + batch)
        own = np.flatnonzero(place[x] >= 0) + lo
        if len(own):
            _step(p.word_rows, met[1], wf[own], p.word_bias.take(cls[own], 0), place[own], w[own], rate, calm)
        _step(p.class_rows, met[0], f[x], p.class_bias, cls[x], w[x], rate, calm)


#: Largest sum of weights whose exponentials are multiplied: all products stay well within float32.
LARGEST = 60.0


def powers(p: Params) -> Params:
    """p for log_probs, with the exponentials of rows and biases, so that none are taken for each example; p itself if weights are too large."""
    most = lambda rows, bias, k: k * np.abs(rows).max(initial=0) + np.abs(bias[np.isfinite(bias)]).max(initial=0)
    if not max(most(p.class_rows, p.class_bias, 4), most(p.word_rows, p.word_bias, 2)) <= LARGEST:
        return p
    return Params(**(vars(p) | {k: np.exp(getattr(p, k)) for k in ("class_rows", "class_bias", "word_rows", "word_bias")} | {"power": True}))


def log_probs(p: Params, code: np.ndarray, most: int = 1 << 16, batch: int = 512) -> np.ndarray:
    """Natural log of the chance of class and place of each code's own symbol. A batch's sums stay in a core's cache."""
    join = np.multiply if p.power else np.add

    def chance(table: np.ndarray, f: np.ndarray, bias: np.ndarray, by: np.ndarray | None, own: np.ndarray) -> np.ndarray:
        """by: each example's row of bias."""
        right, total = np.empty((2, len(own)), np.float32)
        f, ones = np.ascontiguousarray(f.T), np.ones(table.shape[1], np.float32)
        for lo in range(0, len(own), batch):
            x = slice(lo, lo + batch)
            z = _sum_rows(table, f[:, x], bias if by is None else bias.take(by[x], 0), join)
            total[x] = z @ ones if p.power else _exp_rows(z)
            right[x] = z[np.arange(len(z)), own[x]]
        return np.log(np.maximum(right, np.finfo(np.float32).tiny)).astype(np.float64) - np.log(total)

    out = np.empty(len(code))
    for lo in range(0, len(code), most):
        f, cls, place = decode(code[lo : lo + most], p)
        part = chance(p.class_rows, f, p.class_bias, None, cls)
        own = np.flatnonzero(place >= 0)
        if len(own):
            c = cls[own]
            part[own] += chance(p.word_rows, word_features(f[own], c, p.shape.rows), p.word_bias, c, place[own])
        out[lo : lo + most] = part
    return out


def token_counts(docs: DataFrame, text_col: str, tails: int = Shape.tails) -> DataFrame:
    """h, c, tail: each distinct token's hash, count and tail class; combined within tasks first."""
    schema = "h long, tail int, c long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, size = [], [], 0  # of each chunk

        def out() -> pa.RecordBatch:
            found, n = pa.concat_arrays(words).dictionary_encode(), np.concatenate(counts)
            words.clear()
            counts.clear()
            n, found = np.bincount(found.indices.to_numpy(), n).astype(np.int64), found.dictionary
            own = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(word_hashes(found)[own]), pa.array(suffix_codes(found, 2, tails)[own], pa.int32()), pa.array(n[own])], names=["h", "tail", "c"])

        for batch in batches:
            for _, texts in chunks(batch, 0, 1 << 22):
                found = split_words(texts)[1]
                n = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
                n[np.flatnonzero(_bytes(found.dictionary)[1] == 0)] = 0  # no word
                words += [pa.array([END], pa.large_binary()), found.dictionary]
                counts += [[len(texts)], n]
                size += len(n)
                if size > 1_000_000:
                    size = 0
                    yield out()
        if words:
            yield out()

    return docs.select(text_col).mapInArrow(run, schema).groupBy("h").agg(F.max("tail").alias("tail"), F.sum("c").alias("c"))


def start(counts: DataFrame, shape: Shape) -> Params:
    """Tables and biases from the stored counts; what is collected is bounded by shape.known. Words of one count are all in or all out."""
    tails = {r["tail"]: r for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = sum(r["n"] for r in tails.values()), sum(r["v"] for r in tails.values())
    # a histogram over few buckets of counts tells from which count on words fit: no sort, no task that sees all tops
    bucket = F.when(F.col("c") < 1024, F.col("c")).otherwise(1024 + F.floor((F.log2(F.col("c").cast("double")) - 10) * 64))
    least, room = None, shape.known
    for r in sorted(counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["b"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["b"]
    top = counts.where(bucket >= least if least is not None else F.lit(False)).toArrow()
    h, c, tail = (np.asarray(top.column(k)) for k in ("h", "c", "tail"))
    lead = np.lexsort((h, -c))
    h, c, tail = h[lead], c[lead], tail[lead]
    k = min(shape.vocab, len(h))
    # classes of near even mass, none wider than the table
    cls, place = np.zeros(k, np.int32), np.zeros(k, np.int32)
    mass, at, width, goal = 0.0, 0, 0, max(c[:k].sum(), 1) / shape.heads
    for i in range(k):
        left = (shape.heads - 1 - at) * shape.width
        if width and (width >= shape.width or (mass >= goal * (at + 1) and k - i <= left)) and at < shape.heads - 1:
            at, width = at + 1, 0
        cls[i], place[i] = at, width
        width += 1
        mass += c[i]
    word_bias = np.full((shape.heads, shape.width), -np.inf, np.float32)
    word_bias[cls, place] = np.log(c[:k] + SMOOTH)
    word_bias[np.isinf(word_bias).all(axis=1), 0] = 0
    head_mass = np.bincount(cls, c[:k] + SMOOTH, shape.heads) if k else np.zeros(shape.heads)
    n = np.array([tails[i]["n"] if i in tails else 0 for i in range(shape.tails)], np.float64)
    v = np.array([tails[i]["v"] if i in tails else 0 for i in range(shape.tails)], np.float64)
    n -= np.bincount(tail[:k], c[:k], shape.tails)
    v -= np.bincount(tail[:k], minlength=shape.tails)
    tail_mass = n + SMOOTH * (v + 1)
    bias = np.log(np.concatenate((head_mass + SMOOTH, tail_mass)))
    order = np.argsort(h)
    word = np.full(len(h), -1, np.int32)
    word[: shape.contexts] = np.arange(len(h))[: shape.contexts]
    return Params(shape, h[order], c[order], word[order], cls, place, (bias - bias.max()).astype(np.float32), word_bias, np.log10(tail_mass), np.zeros((shape.rows, shape.classes), np.float32), np.zeros((shape.rows, shape.width), np.float32), int(total), int(distinct))


def _packed(x: np.ndarray) -> pa.Array:
    """A binary a row of x; of its numbers the lowest bytes first, then the next: high ones are mostly 0 and compress away."""
    n, k = x.shape
    data = np.ascontiguousarray(x.view(np.uint8).reshape(n, k, -1).transpose(0, 2, 1))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * (k * x.itemsize)).astype(np.int32)), pa.py_buffer(data)])


def _read_packed(column: pa.Array, kind: type) -> np.ndarray:
    column = column.cast(pa.binary())
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]]
    return np.ascontiguousarray(data.reshape(len(column), np.dtype(kind).itemsize, -1).transpose(0, 2, 1)).view(kind)[:, :, 0]


#: Codes of a stored row; a batch of 10,000 rows is 30 MB.
PACK = 256


def trigrams(docs: DataFrame, text_col: str, p: Params, most: int = 4_000_000) -> DataFrame:
    """n, codes, counts: how often each word's symbol occurs after those of the three before, PACK codes a row. Counts are
    combined within a task only: most codes are met once, and a second row of a code trains as well as a larger count.
    A row has the differences of sorted codes; rows come mixed, and the last may end with codes of count 0."""
    none = np.zeros((0, 0), np.float32)
    sent = docs.sparkSession.sparkContext.broadcast(Params(**(vars(p) | {"class_rows": none, "word_rows": none})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, held, size = sent.value, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            code = np.concatenate(held)
            held.clear()
            code.sort()
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            more = -len(first) % PACK
            c = np.append(np.diff(first, append=len(code)).astype(np.int32), np.zeros(more, np.int32)).reshape(-1, PACK)
            code = np.append(code[first], np.full(more, code[-1])).reshape(-1, PACK)
            del first
            mixed = np.random.default_rng(len(code)).permutation(len(code))
            for own in np.split(mixed, range(2048, len(mixed), 2048)):  # little is copied at once
                step, n = code[own], c[own]
                step[:, 1:] -= code[own, :-1]
                yield pa.RecordBatch.from_arrays([pa.array((n > 0).sum(axis=1)), _packed(step), _packed(n)], names=["n", "codes", "counts"])

        for batch in batches:
            for _, texts in chunks(batch, 0):
                held.append(read_chunk(texts, p)["code"])
                size += len(held[-1])
                if size > most:
                    size = 0
                    yield from out()
        if held:
            yield from out()
        pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.select(text_col).mapInArrow(run, "n long, codes binary, counts binary")


def unpacked(batches: Iterator[pa.RecordBatch], mix: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes and counts of each batch, mixed for training: batches of one context would train badly. Sums are faster in order."""
    for x in batches:
        if x.num_rows:
            code, c = np.cumsum(_read_packed(x.column(1), np.int64), axis=1).ravel(), _read_packed(x.column(2), np.int32).ravel()
            if not mix:
                yield code, c  # a count of 0 adds nothing
                continue
            mixed = np.random.default_rng(len(code)).permutation(np.flatnonzero(c).astype(np.int32))
            for lo in range(0, len(mixed), 1 << 18):
                own = mixed[lo : lo + (1 << 18)]
                yield code[own], c[own]


def start_weights(p: Params, met: np.ndarray, cls: np.ndarray, word: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of feature rows from sums of counts: by class, by place in a class, and by the class of the places."""
    prior = np.exp(p.class_bias.astype(np.float64))
    prior /= prior.sum()
    n = met[:, None].astype(np.float64)
    by_class = START * np.log((cls + PRIOR * prior) / (n + PRIOR) / prior)
    share = np.exp(p.word_bias.astype(np.float64))
    share /= share.sum(axis=1, keepdims=True)
    wanted, n = heads.astype(np.float64) @ share, np.maximum(heads.sum(axis=1, keepdims=True), 1)
    tiny = 1e-6
    by_word = START * np.log((word + PRIOR * wanted / n + tiny) / (wanted * (1 + PRIOR / n) + tiny))
    return by_class, by_word


def start_counts(p: Params, batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Sums of counts by feature row: in all, and start_weights' three."""
    s = p.shape
    met, cls_n, word_n, head_n = (np.zeros(s.rows * k, np.float32) for k in (1, s.classes, s.width, s.heads))
    for code, c in ((code[i : i + 65536], c[i : i + 65536]) for code, c in batches for i in range(0, len(code), 65536)):
        f, cls, place = decode(code, p)
        w = c.astype(np.float32)
        own = np.flatnonzero(place >= 0)
        wf = word_features(f[own], cls[own], s.rows).astype(np.int64)
        for k in range(f.shape[1]):
            np.add.at(met, f[:, k], w)
            np.add.at(cls_n, f[:, k].astype(np.int64) * s.classes + cls, w)
        for k in range(wf.shape[1]):
            np.add.at(word_n, wf[:, k] * s.width + place[own], w[own])
            np.add.at(head_n, wf[:, k] * s.heads + cls[own], w[own])
    return met, cls_n.reshape(s.rows, -1), word_n.reshape(s.rows, -1), head_n.reshape(s.rows, -1)


def _pack(at: np.ndarray, *arrays: np.ndarray) -> list[bytes]:
    """Row numbers, and the arrays' rows of these numbers."""
    return [at.astype(np.int32).tobytes(), *[a[at].tobytes() for a in arrays]]


def trainers_for(counts: int) -> int:
    return min(max(LEAST_TRAINERS, counts // TRAINER_ROWS), MOST_TRAINERS)


def train(grams: DataFrame, p: Params, rounds: int = 1, trainers: int | None = None, blocks: int = 16, batch: int = 4096, rate: float = 1.0) -> Params:
    """Starts the weights from the stored codes' counts, then rounds of gradient updates over them; trainers: shares of the codes."""
    spark = grams.sparkSession
    trainers = trainers or trainers_for(grams.agg(F.sum("n")).first()[0] or 0)
    shared, s = grams.coalesce(trainers), p.shape
    per = s.rows // blocks
    sizes = {"c": s.classes, "w": s.width}
    change = "b int, t int, " + ", ".join(f"{x}_{t} binary" for t in "cw" for x in ("at", "n", "d"))
    names = [x.split()[0] for x in change.split(", ")]
    tables = (p.class_rows, p.word_rows)
    row = lambda b, data, names: pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([TaskContext.get().partitionId()], pa.int32()), *[pa.array([d], pa.binary()) for d in data]], names=names)

    def take(frame: DataFrame) -> None:
        for g in frame.collect():
            for table, t in zip(tables, "cw"):
                at = np.frombuffer(g[f"at_{t}"], np.int32)
                table[at] += np.frombuffer(g[f"d_{t}"], np.float16).reshape(len(at), table.shape[1])

    # the tables are zero here; they are left out of what is sent
    none = np.zeros((0, 0), np.float32)
    sent = spark.sparkContext.broadcast(Params(**(vars(p) | {"class_rows": none, "word_rows": none, "hashes": none, "counts": none, "word": none})))
    sums = ("at", "met", "cls", "word", "heads")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = start_counts(sent.value, unpacked(batches, mix=False))
        used = (found[0] > 0) | (found[3].sum(axis=1) > 0)
        for b in range(blocks):
            yield row(b, _pack(np.flatnonzero(used[b * per : (b + 1) * per]) + b * per, *found), ["b", "t", *sums])

    def begin(pdf: pd.DataFrame) -> pd.DataFrame:
        """A block's weights, from all trainers' sums."""
        widths = (1, s.classes, s.width, s.heads)
        total = [np.zeros((per, k), np.float64) for k in widths]
        for r in pdf.sort_values("t").itertuples():
            at = np.frombuffer(r.at, np.int32) % per
            for x, k, data in zip(total, widths, (r.met, r.cls, r.word, r.heads)):
                x[at] += np.frombuffer(data, np.float32).reshape(-1, k)
        lead, out = int(pdf["b"].iloc[0]) * per, []
        for use, w in zip((total[0][:, 0] > 0, total[3].sum(axis=1) > 0), start_weights(sent.value, total[0][:, 0], *total[1:])):
            own = np.flatnonzero(use)
            out += [(own + lead).astype(np.int32).tobytes(), b"", w[own].astype(np.float16).tobytes()]
        return pd.DataFrame([[pdf["b"].iloc[0], 0, *out]], columns=names)

    take(shared.mapInArrow(count, "b int, t int, " + ", ".join(f"{x} binary" for x in sums)).groupBy("b").applyInPandas(begin, change))
    sent.destroy()
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(Params(**(vars(p) | {"hashes": none, "counts": none, "word": none})))
        pace = rate / (1 + r)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            old = sent.value  # noqa: B023
            new = Params(**(vars(old) | {"class_rows": old.class_rows.copy(), "word_rows": old.word_rows.copy()}))
            met = (np.zeros(s.rows, np.float32), np.zeros(s.rows, np.float32))
            for code, c in unpacked(batches):
                train_codes(new, met, code, c, pace, batch=batch)  # noqa: B023
            for b in range(blocks):
                data = []
                for after, before, n in ((new.class_rows, old.class_rows, met[0]), (new.word_rows, old.word_rows, met[1])):
                    own = np.flatnonzero(n[b * per : (b + 1) * per]) + b * per  # rows never met don't travel
                    data += [own.astype(np.int32).tobytes(), n[own].tobytes(), (after[own] - before[own]).astype(np.float16).tobytes()]
                yield row(b, data, names)

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            """Of a block: the rows met by any trainer, and their mean changes weighed by how often each met them."""
            out, lead, pdf = [], int(pdf["b"].iloc[0]) * per, pdf.sort_values("t")
            for t, width in sizes.items():
                total, n = np.zeros((per, width), np.float32), np.zeros(per, np.float64)
                for at, k, d in zip(pdf[f"at_{t}"], pdf[f"n_{t}"], pdf[f"d_{t}"]):
                    at, k = np.frombuffer(at, np.int32) % per, np.frombuffer(k, np.float32)
                    total[at] += np.frombuffer(d, np.float16).reshape(-1, width).astype(np.float32) * k[:, None]
                    n[at] += k
                own = np.flatnonzero(n)
                out += [(own + lead).astype(np.int32).tobytes(), b"", (total[own] / n[own, None]).astype(np.float16).tobytes()]
            return pd.DataFrame([[pdf["b"].iloc[0], 0, *out]], columns=names)

        take(shared.mapInArrow(run, change).groupBy("b").applyInPandas(add, change))
        sent.destroy()
    return p


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", shape: Shape | None = None, rounds: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; rows where held_out is true don't train."""
    spark = docs.sparkSession
    learn = docs.where(~held_out).select(docs[text_col].alias("t"))
    counts = stored(token_counts(learn, "t", (shape or Shape).tails))
    shape = shape or Shape.of(counts.count())
    p = start(counts, shape)
    grams = stored(trigrams(learn, "t", p))
    p = train(grams, p, rounds)
    discard(grams)
    sent = spark.sparkContext.broadcast(powers(p))
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("held_out", T.BooleanType())] + T.StructType.fromDDL("key long, n_tokens long, n_known long, base double, model double, hs array<long>, ms array<int>").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, row = sent.value, 0
        task = TaskContext.get().partitionId() << 32
        unit = math.log10(p.total + SMOOTH * (p.distinct + 1))
        for batch in batches:
            for rows, texts in chunks(batch, 2):
                x = read_chunk(texts, p)
                count = x["count"][x["flat"]]
                known = count > 0
                gain = np.where(x["count"] > 0, np.log10(np.maximum(x["count"], 0) + SMOOTH), 0.0)[x["flat"]]
                code, place = np.unique(x["code"], return_inverse=True)
                rare = x["y"] >= p.shape.vocab
                model = (log_probs(p, code) / math.log(10))[place] + np.where(rare, gain - p.tail_mass[np.maximum(x["y"] - p.shape.vocab, 0)], 0.0)
                at = x["ends"] - x["n"]
                open_ = count < 0
                # (text, word) pairs whose counts only the join knows
                where = np.flatnonzero(open_)
                pair, m = np.unique(np.searchsorted(x["ends"], where, "right").astype(np.int64) << 32 | x["flat"][where], return_counts=True)
                first = np.searchsorted(pair >> 32, np.arange(len(rows) + 1)).astype(np.int32)
                hs = pa.ListArray.from_arrays(pa.array(first), pa.array(x["h"][pair & 0xFFFFFFFF]))
                ms = pa.ListArray.from_arrays(pa.array(first), pa.array(m.astype(np.int32)))
                keys = pa.array(task + row + np.arange(len(rows)), pa.int64())
                row += len(rows)
                lead = [batch.column(k).take(pa.array(rows)) for k in range(2)]
                yield pa.RecordBatch.from_arrays([*lead, keys, pa.array(x["n"], pa.int64()), pa.array(np.add.reduceat(known, at, dtype=np.int64)), pa.array(np.add.reduceat(gain, at) - x["n"] * unit), pa.array(np.add.reduceat(model, at)), hs, ms], names=schema.names)

    parts = stored(docs.select(docs[id_col].alias("doc_id"), held_out.alias("held_out"), docs[text_col].alias("t")).mapInArrow(run, schema))
    sent.destroy()
    rare = parts.where(F.size("hs") > 0).select("key", F.explode(F.arrays_zip("hs", "ms")).alias("x")).select("key", F.col("x.hs").alias("h"), F.col("x.ms").alias("m"))
    # a null word stands for those that training never met: each counts as 0
    joined = rare.join(counts.select("h", "c"), "h", "left")
    more = joined.groupBy("key").agg(F.sum(F.col("m") * F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("g"), F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("k"))
    out = parts.drop("hs", "ms").join(more, "key", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("k", F.lit(0))).cast("long").alias("n_known"),
        F.lit(p.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("g", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("g", F.lit(0.0))).alias("score"),
    )
