"""Inner steps of the language model against plain loops."""

import collections
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import lm


def params(shape: lm.Shape) -> lm.Params:
    r = np.random.default_rng(3)
    cls = np.arange(shape.vocab, dtype=np.int32) % shape.heads
    place = np.arange(shape.vocab, dtype=np.int32) // shape.heads
    bias = np.full((shape.heads, shape.width), -np.inf, np.float32)
    bias[cls, place] = r.normal(size=shape.vocab)
    hashes = np.sort(lm.word_hashes([b"a", b"bc", lm.END]))
    table = lambda k: r.normal(size=(shape.rows, k)).astype(np.float32)
    return lm.Params(shape, hashes, np.array([5, 4, 3]), np.array([0, 1, -1], np.int32), cls, place, r.normal(size=shape.classes).astype(np.float32), bias, np.zeros(shape.tails), table(shape.classes), table(shape.width), 12, 3)


SHAPE = lm.Shape(vocab=6, heads=2, tails=3, contexts=6, suffixes=7, rows=16, width=3)


def test_trainers_follow_the_counts():
    """What trainers send is of one size each, so five times the counts need more than twice the trainers."""
    few, many = lm.trainers_for(lm.TRAINER_ROWS * 8 // 5), lm.trainers_for(lm.TRAINER_ROWS * 8)
    assert many >= 2 * few and lm.trainers_for(0) > 1
    assert lm.trainers_for(21_000_000) * 2 <= lm.trainers_for(105_000_000)


def test_words_of_a_chunk():
    texts = [b"", b" a  bc ", b"\n\t", b"a\x0bbc\x1cc\x00d\x85 e\r\n", b"\xff\xfe a", b"abcd bcd cd bcd"]
    p = params(SHAPE)
    got = lm.read_chunk(texts, p)
    words = [w for t in texts for w in (*t.split(), lm.END)]
    assert got["n"].tolist() == [len(t.split()) + 1 for t in texts]
    assert got["h"][got["flat"]].tolist() == [lm.word_hash(w) for w in words]
    known = dict(zip(p.hashes.tolist(), p.word.tolist()))
    word = lambda w: known.get(lm.word_hash(w), -1)
    assert got["y"].tolist() == [word(w) if word(w) >= 0 else SHAPE.vocab + zlib.crc32(w[-2:]) % SHAPE.tails for w in words]


@pytest.mark.parametrize("run", [1, 4, 64])
def test_a_step_is_the_mean_gradient(monkeypatch, run):
    """Rows met once, often, and by two features of one example; the bias differs by example or not."""
    monkeypatch.setattr(lm, "RUN", run)
    r = np.random.default_rng(5)
    for n, each in ((1, True), (200, True), (200, False)):
        table, met = r.normal(size=(40, 5)).astype(np.float32), r.random(40).astype(np.float32)
        f = np.minimum(r.zipf(1.5, (n, 3)), 30).astype(np.uint16)
        bias = r.normal(size=(n, 5) if each else 5).astype(np.float32)
        own, w = r.integers(0, 5, n), r.integers(1, 4, n).astype(np.float32)
        z = table.astype(float)[f].sum(axis=1) + bias
        g = w[:, None] * (np.exp(z) / np.exp(z).sum(axis=1, keepdims=True) - np.eye(5)[own])
        total, seen, count = np.zeros((40, 5)), np.zeros(40), met.astype(float)
        for i, rows in enumerate(f):
            for x in rows:
                total[x] += g[i]
                seen[x] += w[i]
        count += seen
        want = table - np.where(seen > 0, 0.7 / (seen + 4 + lm.SETTLE * count), 0)[:, None] * total
        lm._step(table, met, f, bias, own, w, 0.7, 4.0)
        assert table == pytest.approx(want, abs=1e-4) and met == pytest.approx(count, rel=1e-5)


def test_packed_rows_are_read_back():
    """Also from a slice of a column, which has offsets of its own."""
    x = np.random.default_rng(1).integers(0, 1 << 60, (7, 5))
    assert (lm._read_packed(lm._packed(x), np.int64) == x).all()
    assert (lm._read_packed(lm._packed(x).slice(2, 3), np.int64) == x[2:5]).all()


def test_short_words_are_hashed_at_once(monkeypatch):
    """Hashes and suffix codes equal those of single words at every length, also in a slice; only words from 32 bytes on are hashed singly."""
    r = np.random.default_rng(2)
    words = [r.bytes(n) for n in [*range(70), *range(40)]]
    want = [lm.word_hash(w) for w in words]
    at = pa.array(words, pa.large_binary())
    assert lm.word_hashes(words).tolist() == want and lm.word_hashes(at[5:90]).tolist() == want[5:90] and not len(lm.word_hashes([]))
    for k in (2, 3):
        assert lm.suffix_codes(at[5:90], k, 97).tolist() == [zlib.crc32(w[-k:]) % 97 for w in words[5:90]]
    single, digest = [], lm.xxhash.xxh64_intdigest
    monkeypatch.setattr(lm.xxhash, "xxh64_intdigest", lambda w: single.append(len(w)) or digest(w))
    lm.read_chunk([b" ".join(w.hex().encode() for w in words)], params(SHAPE))
    assert min(single) >= 32


@pytest.mark.parametrize("scale, spared", [(1, True), (20, False)])
def test_scores_take_no_exponentials(monkeypatch, scale, spared):
    """Products of the rows' exponentials give the scores of the rows' sums, over several batches; large weights keep their sums."""
    p = params(SHAPE)
    p.class_rows *= scale
    s, r = SHAPE, np.random.default_rng(7)
    around = r.integers(0, s.contexts + s.suffixes + 2, (3, 300))
    code = ((around[0] << s.context_bits | around[1]) << s.context_bits | around[2]) << s.word_bits | r.integers(0, s.vocab + s.tails, 300)
    want, kept = lm.log_probs(p, code), {k: v.copy() for k, v in vars(p).items() if isinstance(v, np.ndarray)}
    fast = lm.powers(p)
    assert fast.power == spared and all((getattr(p, k) == v).all() for k, v in kept.items())
    if spared:
        monkeypatch.setattr(lm, "_exp_rows", None)
    assert lm.log_probs(fast, code, most=128, batch=50) == pytest.approx(want, abs=1e-5)


def test_counts_of_tokens(spark):
    """Against a plain count, with all white space, empty and null texts, and words of many chunks."""
    texts = [None, "", " ", "a  B\tb\x0bc\x1cd", "\n a\r\n", "é É ß", *[f"w{i} w{i % 7} {'x' * (i % 50)}" for i in range(300)]]
    want = collections.Counter(w for t in texts for w in [*(t or "").encode().lower().split(), lm.END])
    got = lm.token_counts(spark.createDataFrame([(t,) for t in texts], "text string"), "text", 11).collect()
    assert {r["h"]: (r["tail"], r["c"]) for r in got} == {lm.word_hash(w): (zlib.crc32(w[-2:]) % 11, n) for w, n in want.items()}
    assert len(got) == len(want)
