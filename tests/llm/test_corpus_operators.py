import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hnsw, lm, mixing, neardup, sharding, tiff
from tessera.llm.queries import QUERIES


def tokens(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = tokens(text)
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(docs, k, share=80):
    """doc_id -> smallest reachable id, by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= share * len(a | b) and find(i) != find(j):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i in root}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(3000)]
    base = [rng.choice(vocab) for _ in range(150)]
    passage = [rng.choice(vocab) for _ in range(60)]
    docs = []
    for i in range(420):
        if i % 3 == 0:  # one large group of near copies
            w = [rng.choice(vocab) if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else x for x in base]
        elif i % 3 == 1:  # a passage that many share
            w = passage + [rng.choice(vocab) for _ in range(rng.randrange(5, 200))]
        else:
            w = [rng.choice(vocab) for _ in range(rng.randrange(1, 9))]
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, docs[0][1].upper()) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_components(docs, 4)
    for small in (neardup.BLOCK, 16):
        got = neardup.near_duplicates(df, words=4, small=small).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(dict(docs)[r.doc_id], 4)) for r in got)


def test_blocks_of_large_nodes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(f"x{rng.random()}" if rng.random() < 0.02 else w for w in base)) for i in range(60)]
    for depth in (0, 3):
        got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=4, small=8, depth=depth).collect()
        assert {r.doc_id: r.component_id for r in got} == brute_components(docs, 4)


def test_large_groups_meet_their_leader_first(spark, monkeypatch):
    """Rows compared in a group of near copies grow with the group, not with its square."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    met = []
    compared = neardup.compared
    monkeypatch.setattr(neardup, "compared", lambda rows, *a, **k: met.append(rows.count()) or compared(rows, *a, **k))
    base = [f"w{i}" for i in range(200)]
    counts = {}
    for n in (200, 800):
        met.clear()
        docs = [(i, " ".join(f"x{i}" if k == i % 200 else w for k, w in enumerate(base))) for i in range(n)]
        got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words=4, trees=2, small=16).collect()
        assert {r.component_id for r in got} == {0}
        counts[n] = sum(met)
    assert counts[800] < 6 * counts[200]


def test_ids_must_be_whole_numbers(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        neardup.near_duplicates(spark.createDataFrame([("a", "t")], "doc_id string, text string"))


def test_near_duplicates_edges(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == 9 and neardup.near_duplicates(no_docs).count() == 0
    assert all(r.kept for r in rows) and {r.n_shingles for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert next(r for r in rows if r.doc_id == 6).n_shingles == 1


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002)], "u long, v long")
    got = {r.rep: r.comp for r in neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in (1000, 1001, 1002)}
    assert neardup.components(edges.limit(0)).count() == 0


def test_language_model(spark, sf):
    docs = {r.doc_id: tokens(r.text) + [b"\n"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    c = collections.Counter(w for i, ws in docs.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(c.values()), len(c)
    rows = QUERIES["op2_maxent_lm"](spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r.doc_id]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_joins_rare_words(spark):
    """With a table of two words, all counts but two come from the join."""
    df = spark.createDataFrame([(i, f"a b c{i % 3} d{i}") for i in range(20)], "doc_id long, text string")
    held = F.col("doc_id") % 5 == 0
    few, many = (sorted(map(tuple, lm.score(df, held, shape=lm.Shape(vocab=2, known=k), rounds=1).select("doc_id", "n_known", F.round("base_score", 8)).collect())) for k in (2, 1 << 10))
    assert few == many


def test_language_model_is_normalised(spark):
    """Class and word chances of a context sum to 1 over all symbols."""
    df = spark.createDataFrame([(i, f"a b c a b d{i}") for i in range(30)], "doc_id long, text string")
    shape = lm.Shape(vocab=5, heads=2, tails=3, contexts=6)
    p = lm.start(lm.token_counts(df, "text", shape.tails), shape)
    p = lm.train(lm.trigrams(df, "text", p), p, rounds=2, trainers=2)
    for a, b in ((0, 1), (2, 0), (8, 9)):
        codes = np.array([(a << shape.context_bits | b) << shape.word_bits | y for y in range(shape.vocab + shape.tails)])
        assert np.exp(lm.log_probs(p, codes)).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_keeps_contexts_apart(spark):
    """Rare words before a word differ by three bytes, the word three back counts, and sizes grow with the words."""
    docs = spark.createDataFrame([(i, "a b c d") for i in range(9)], "doc_id long, text string")
    p = lm.start(lm.token_counts(docs, "text"), lm.Shape())
    code = lambda t: lm.read_chunk([t], p)["code"][-2:-1]  # noqa: E731  of the last word
    rows = lambda t: lm.decode(code(t), p)[0][0].tolist()
    assert rows(b"a xeed d")[0] != rows(b"a xaed d")[0]
    one, other = rows(b"a b c d"), rows(b"d b c d")
    assert one[:3] == other[:3] and one[3:] != other[3:]
    small, large = lm.Shape.of(1000), lm.Shape.of(16 * lm.GROWS_FROM)
    assert (small.vocab, small.heads, small.contexts, small.suffixes, small.rows) == (1000, 24, 8000, 2048, 1 << 16)
    assert (large.vocab, large.heads, large.contexts, large.suffixes, large.rows) == (2000, 34, 32000, 8192, 1 << 17)
    most = lm.Shape.of(1 << 50)
    assert 3 * most.context_bits + most.word_bits <= 63


def test_language_model_scores_by_hand(spark, monkeypatch):
    """score() against a token by token computation from the trained tables, and better than the base on held-out text."""
    rng = random.Random(3)
    pairs = {f"w{i}": [f"w{(7 * i + k) % 40}" for k in range(3)] for i in range(40)}

    def text():
        out = [f"w{rng.randrange(40)}"]
        for _ in range(60):
            out.append(rng.choice(pairs[out[-1]]) if rng.random() < 0.9 else f"x{rng.randrange(500)}")
            if out[-1][0] == "x":
                out.append(f"w{rng.randrange(40)}")
        return " ".join(out)

    docs = [(i, text()) for i in range(120)]
    seen = []
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda *a: seen.append(train(*a)) or seen[0])
    shape = lm.Shape(vocab=30, heads=4, tails=3, contexts=60, suffixes=16, rows=256, width=16)
    held = F.col("doc_id") % 4 == 0
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string"), held, shape=shape).collect()}
    p = seen[0]
    c = collections.Counter(w for i, t in docs if i % 4 for w in [*t.encode().split(), b"\n"])
    rank = {w: k for k, w in enumerate(sorted(c, key=lambda w: (-c[w], lm.word_hash(w))))}
    tail = lambda w: zlib.crc32(w[-2:]) % 3
    rest = [sum(c[w] for w in c if rank[w] >= 30 and tail(w) == k) + 0.1 * (sum(rank[w] >= 30 and tail(w) == k for w in c) + 1) for k in range(3)]

    def row(x, k):
        return ((x * 0x9E3779B97F4A7C15 + k * 0xC2B2AE3D27D4EB4F) % (1 << 64)) >> 56

    def soft(z):
        m = max(z)
        return m + math.log(sum(math.exp(x - m) for x in z))

    for i, t in docs[:20]:
        words, total = [*t.encode().split(), b"\n"], 0.0
        before = lambda w: rank[w] if rank.get(w, 99) < 60 else 60 + zlib.crc32(w[-3:]) % 16
        for at, w in enumerate(words):
            a, b, d = (before(words[at - k]) if at >= k else 76 + min(k - at - 1, 1) for k in (1, 2, 3))
            f = [row(a, 1), row(b, 2), row(a << shape.context_bits | b, 3), row(d, 4)]
            z = [float(p.class_bias[j]) + sum(float(p.class_rows[x, j]) for x in f) for j in range(7)]
            r = rank.get(w, 99)
            cls = int(p.cls[r]) if r < 30 else 4 + tail(w)
            total += (z[cls] - soft(z)) / math.log(10)
            if r < 30:
                g = [(f[k] * 31 + cls * 7919) % 256 for k in (0, 1)]
                z = [float(p.word_bias[cls, j]) + sum(float(p.word_rows[x, j]) for x in g) for j in range(16)]
                total += (z[p.place[r]] - soft(z)) / math.log(10)
            else:
                total += math.log10((c[w] + 0.1) / rest[tail(w)])
        assert got[i].score == pytest.approx(total, rel=1e-4)
    won = [got[i].score - got[i].base_score for i, _ in docs if i % 4 == 0]
    assert sum(won) > 0.2 * -sum(got[i].base_score for i, _ in docs if i % 4 == 0)


def test_language_model_edges(odd_docs, no_docs):
    held = F.lit(False)
    assert lm.score(no_docs, held).count() == 0
    rows = lm.score(odd_docs, held, rounds=1).collect()
    assert len(rows) == 9 and {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    none = lm.score(odd_docs, F.lit(True), rounds=1).collect()
    assert {(r.train_tokens, r.n_known) for r in none} == {(0, 0)}


def test_tiff_codecs_round_trip():
    rng = random.Random(1)
    for n in [*range(0, 700, 9), 4000, 9000]:
        for kind in range(3):
            d = bytes(rng.randrange(256) if kind == 0 else rng.choice(b"ab") if kind == 1 else rng.choice(b"the and of ") for _ in range(n))
            assert tiff.packbits_decode(tiff.packbits_encode(d)) == d and tiff.lzw_decode(tiff.lzw_encode(d), n + 1) == d
    for comp in (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS):
        for pred in (1, 2):
            for tile in (0, 16):
                for spp in (1, 3):
                    pages = [np.random.default_rng(h).integers(0, 256, (h, w, spp), dtype=np.uint8) for h, w in ((1, 1), (33, 20), (70, 64))]
                    got = list(tiff.read_tiff(tiff.write_tiff(pages, comp, pred, tile, strip_rows=13)))
                    assert [g["pixels"] for g in got] == [p.tobytes() for p in pages]


def test_tiff_big_endian_and_damage(spark):
    import struct

    px = bytes(range(12))
    tags = [(256, 3, 4), (257, 3, 3), (258, 3, 8), (259, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, 3), (279, 4, 12)]
    body = b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v)) for t, k, v in tags)
    good = b"MM\0*" + struct.pack(">I", 20) + px + struct.pack(">H", len(tags)) + body + struct.pack(">I", 20)
    assert [p.get("pixels") for p in tiff.read_tiff(good)] == [px]  # its chain loops
    rng = random.Random(0)
    whole = tiff.write_tiff([np.zeros((9, 9), np.uint8)], tiff.LZW)
    for _ in range(300):
        b = bytearray(whole)
        for _ in range(3):
            b[rng.randrange(len(b))] = rng.randrange(256)
        list(tiff.read_tiff(bytes(b[: rng.randrange(1, len(b) + 1)])))
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(tiff.write_tiff([np.ones((2, 2), np.uint8)] * 3))), (3, bytearray(b"x")), (4, None)], "id long, content binary")
    got = sorted((r.id, r.page, r.error is None) for r in tiff.read_pages(df, "content", ("id",)).collect())
    assert got == [(1, 0, True), (2, 0, True), (2, 1, True), (2, 2, True), (3, 0, False), (4, 0, False)]
    assert tiff.read_pages(df.limit(0), "content", ("id",)).count() == 0


def test_tiff_pages_have_no_size_limit():
    """A page of 300 MB of zeros is read from a small file; a forged size beyond what the strips unpack to is refused."""
    big = tiff.write_tiff([np.zeros((300 << 10, 1024), np.uint8)], tiff.DEFLATE, strip_rows=1 << 16)
    (page,) = tiff.read_tiff(big)
    assert len(page["pixels"]) == 300 << 20 and not any(page["pixels"][:: 1 << 20])
    small = bytearray(tiff.write_tiff([np.zeros((64, 64), np.uint8)], tiff.LZW))
    at = small.rindex(b"\x00\x01\x04\x00\x01\x00\x00\x00\x40\x00\x00\x00") + 8
    small[at : at + 4] = b"\xff\xff\xff\x7f"
    (page,) = tiff.read_tiff(bytes(small))
    assert "unpack" in page["error"] or "short" in page["error"]


def test_stored_payloads_of_any_kind(spark):
    """Every coding is met at every size; nulls, odd lengths, repeated rows and an extra column have a defined result."""
    rows = [(i, bytearray((f"w{i} " * (2 + i % 300)).encode()), "x") for i in range(300)]
    rows += [(1000, None, None), (1001, bytearray(b""), "x"), (1002, bytearray(b"abc"), "x"), (1002, bytearray(b"abc"), "x")]
    df = spark.createDataFrame(rows, "id long, payload binary, media string")
    files = tiff.store_bytes(df, "payload", ("id",))
    got = tiff.read_pages(files, "media", ("id",)).select("id", "pixels", "compression", "error").collect()
    want = collections.Counter((i, bytes(p) if p else None) for i, p, _ in rows)
    assert collections.Counter((r.id, bytes(r.pixels) if r.pixels else None) for r in got) == want
    assert {r.compression for r in got if r.pixels and len(r.pixels) > 800} == {tiff.LZW, tiff.DEFLATE, tiff.PACKBITS}
    assert all((r.error is None) == (r.pixels is not None) for r in got)
    assert tiff.store_bytes(df.limit(0), "payload", ("id",)).count() == 0
    with pytest.raises(ValueError, match="rename"):
        tiff.store_bytes(df, "payload", ("id", "media"))


def test_media_query(spark, sf):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op7_tiff_pages"](spark, sf).collect():
        b = texts[r.doc_id]
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))


def test_vector_search(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x, ids = np.array(e.embedding.tolist(), np.float64), e.vec_id.to_numpy()
    found = collections.defaultdict(list)
    for r in sorted(QUERIES["op4_hnsw"](spark, sf).collect(), key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    hits = 0
    queries = ids[ids % 20 == 0]
    for q in queries:
        s = x @ x[ids == q][0]
        want = [i for _, i in sorted((-a, i) for a, i in zip(s, ids) if i != q)[:20]]
        assert all(v == pytest.approx(s[ids == i][0]) for i, v in found[q])
        hits += len({i for i, _ in found[q]} & set(want))
    assert hits >= 0.9 * 20 * len(queries)


def test_vector_search_over_many_shards(spark):
    """Seven shards of both lengths' vectors against brute force, in double precision of double columns."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 12))
    x = centres[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 12))
    x[:, 0] += 1e-9 * np.arange(3000)
    y = rng.normal(size=(30, 5)) * 1e200
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(10_000 + i, v.tolist()) for i, v in enumerate(y / 1e60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collections.defaultdict(dict)
    for r in hnsw.neighbours(df, is_query="id % 20 = 0", k=20, shards=7).collect():
        found[r.query_id][r["rank"]] = (r.vec_id, r.score)
    hits = total = 0
    for lead, part in ((0, x), (10_000, y / 1e60)):
        for q in range(0, len(part), 20):
            s = part @ part[q]
            want = [i for _, i in sorted((-a, i) for i, a in enumerate(s) if i != q)[:20]]
            got = [found[lead + q][k + 1] for k in range(20)]
            assert all(v == pytest.approx(s[i - lead], rel=1e-12) for i, v in got) and [v for _, v in got] == sorted((v for _, v in got), reverse=True)
            hits += len({i - lead for i, _ in got} & set(want))
            total += 20
    assert len(found) == 152 and hits >= 0.9 * total


def test_vector_search_edges(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.5]) for i in range(60)] + [(100, None), (101, [0.0, 0.0]), (102, [nan, 1.0]), (103, [None, 1.0]), (104, [1.0]), (None, [1.0, 1.0]), (105, [2.0, 0.0]), (106, [-1.0, 3.0]), (0, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = hnsw.neighbours(df, is_query="id % 20 = 0", k=5).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        by[r.query_id].append(r.vec_id)
    assert by == {0: [105, 1, 2, 3, 4], 20: [105, 0, 1, 2, 3], 40: [105, 0, 1, 2, 3]}
    assert hnsw.neighbours(df.limit(0)).count() == 0
    few = hnsw.neighbours(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>"), k=5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few) == [(1, 1, 2), (2, 1, 1)]


def test_shards(spark, sf):
    rows = QUERIES["op8_kd_shards"](spark, sf).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bytes_, slots, of = collections.Counter(), collections.defaultdict(list), {}
    for r in rows:
        assert (r.size, r.text_crc32, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), None)
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert of.setdefault(texts[r.doc_id], r.shard) == r.shard
    assert set(bytes_) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * max(len(t) for t in texts.values()) + 0.05 * sum(bytes_.values()) / 16


def test_shards_native_and_edges(spark, sf, odd_docs, no_docs):
    plan = QUERIES["op8_kd_shards"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert sharding.with_slots(sharding.shard_groups(odd_docs)).count() == 9
    assert sharding.with_slots(sharding.shard_groups(no_docs)).count() == 0


def test_sources_with_a_common_prefix_are_cut_apart(spark):
    """Two sources of equal bytes, alike in all but the end of a long name: the cut goes between them."""
    docs = [(i, f"text {i:04d}", "en", "https://example.org/a/long/common/prefix/" + "ab"[i % 2]) for i in range(200)]
    got = sharding.shard_groups(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), shards=2).collect()
    assert collections.Counter((r.doc_id % 2, r.shard) for r in got) == {(0, 0): 100, (1, 1): 100}


def test_ranks_of_metadata(spark, monkeypatch):
    """Ranks follow code points over all ranges, and a shuffled join of ranks gives what a broadcast one does."""
    names = [f"s{i}" for i in range(300)] + ["é", "z", "", "Z"]
    df = spark.createDataFrame([(i, f"t{i % 97}", "en", n if i % 7 else None) for i, n in enumerate(names * 3)], "doc_id long, text string, lang string, source string")
    points = df.select(F.col("source").alias("_m0"), F.col("text").alias("_g"))
    assert {r["_m0"]: r["rank"] for r in sharding.ranks(points, "_m0", parts=5).collect()} == {n: i + 1 for i, n in enumerate(sorted(names, key=str.encode))}
    a = sorted(map(tuple, sharding.shard_groups(df, shards=4).collect()))
    monkeypatch.setattr(sharding, "SENT_VALUES", 1)
    assert sorted(map(tuple, sharding.shard_groups(df, shards=4).collect())) == a


def test_slots_of_repeated_rows_and_text_ids(spark):
    docs = [(None if i % 3 else f"id{i}", "same" if i % 2 else f"text {i}", "en", "s") for i in range(300)]
    rows = sharding.with_slots(sharding.shard_groups(spark.createDataFrame(docs, "doc_id string, text string, lang string, source string"), shards=3)).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(rows) == 300 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_group_may_hold_most_bytes(spark):
    df = spark.createDataFrame([(i, "same text " * 50 if i < 60 else f"text {i} " * 30, "en", "s") for i in range(200)], "doc_id long, text string, lang string, source string")
    got = sharding.shard_groups(df, shards=8).groupBy("shard").agg(F.sum("size").alias("b"), F.count_distinct("text_crc32").alias("g")).collect()
    assert len(got) == 8 and min(r.b for r in got) > 0.7 * sum(r.b for r in got if r.g > 1) / 7


def test_mixing_against_a_loop(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_mix"](spark, sf).collect()
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        d = docs[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) and r.taken <= 3 * r.size
        size[d.source] += r.size
        taken[d.source] += r.taken
        target[d.source] = r.target
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    want, live, left = dict.fromkeys(names, 0.0), set(names), float(sum(size.values()))
    while left > 1e-9 and live:  # the rule as told: share, stop at the cap, share the excess again
        whole, rest = sum(weight[s] for s in live), 0.0
        for s in sorted(live, key=str):
            want[s] += left * weight[s] / whole
            if want[s] >= 3 * size[s]:
                rest += want[s] - 3 * size[s]
                want[s] = 3.0 * size[s]
        live -= {s for s in live if want[s] >= 3 * size[s]}
        left = rest
    longest = collections.Counter()
    for d in docs.values():
        longest[d.source] = max(longest[d.source], len((d.text or "").split()))
    for s in names:
        assert target[s] == pytest.approx(want[s]) and 0 <= want[s] - taken[s] <= longest[s] + 1e-6


def test_mixing_caps_small_sources(spark):
    df = spark.createDataFrame([(i, "w " * 10, "a" if i < 1 else "b") for i in range(20)], "doc_id long, text string, source string")
    got = {(r.source): (r.target, r.source_size) for r in mixing.mix(df, weights=(9.0, 1.0)).collect()}
    assert got == {"a": (30.0, 10), "b": (170.0, 190)}


def test_mixing_reruns_agree_and_edges(odd_docs, no_docs):
    a, b = (sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mix(x).collect()) for x in (odd_docs, odd_docs.repartition(5)))
    assert a == b and len(a) == 9 and mixing.mix(no_docs).count() == 0
    many = sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mix(odd_docs, buckets=100_000).collect())
    assert many == a
