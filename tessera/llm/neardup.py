"""MinHash near-duplicates by chosen-path set similarity join.

A text's set is its distinct shingles of `words` words (ASCII lower case). Texts of equal sets are one
class; what follows works on a class's representative, the smallest id.

1. Chosen paths: in each of `trees` trees a representative starts at the node of one minwise token of its
   set. In a node of more than `small` members all are compared with the node's leader (its smallest id), whose
   signature goes to each block of members; those that may be its links hang together through it, and only the
   rest is still to be compared with all. A node whose rest is large branches, by `branch` further tokens whose
   positions the node draws, until nodes are small or the path has `depth` tokens. Equal paths mean equal tokens
   along them, so sets of similarity s follow a token together with chance s, and independent trees bring the
   recall to its target: a pair of 0.8 is missed by all trees with a chance under 1e-4, whatever the nodes' sizes.
2. Small nodes are compared exhaustively by their signatures, large ones the rest against all in pairs of blocks.
   A node gives a spanning forest of the pairs that may be links, so no group gives all its pairs.
3. Groups of possible links get their full sets, once. Again members of a large group meet its leader first and
   then, block by block, only those that aren't its links meet all. Intersections are counted exactly by
   inverted lists; a spanning forest of the true links is kept, which has the same connected components.
4. Components by large-star and small-star rounds on stored tables, which end when nothing changes.

Defined cases: null, empty and white-space texts have the empty set, link with nothing and are kept; with fewer
words than a shingle the whole sequence is the one shingle; rows that share an id are one document with
several texts; a null id links with nothing; ids of another type than whole numbers are refused; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import discard, stored
from .lm import chunks

POSITIONS = 64
#: A pair may be a link if this share of the signature agrees; at a similarity of 0.8 that is 4 standard deviations low.
MAYBE = 0.6
#: Up to so many rows a set of ids (8 bytes each) is broadcast; beyond, the join is shuffled.
SENT_ROWS = 1_000_000
BLOCK = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    ids: dict[bytes, int] = {}
    put, flat, n = ids.setdefault, [], []
    for t in texts:
        w = t.split()
        n.append(len(w))
        flat += [put(x, len(ids)) for x in w]
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
    w = h[np.array(flat, np.int64)] if flat else np.zeros(0, np.uint64)
    ends = np.cumsum(n)
    s = np.zeros(max(len(w) - words + 1, 0), np.uint64)
    for k in range(words):  # order counts: each step mixes what came before
        s = (s ^ (s >> np.uint64(29))) * _MIX + w[k : k + len(s)]
    s = (s ^ (s >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    out = []
    for e, m in zip(ends.tolist(), n):
        if m >= words:
            out.append(np.unique(s[e - m : e - words + 1]))
        elif m:
            out.append(np.array([xxhash.xxh64_intdigest(w[e - m : e].tobytes(), seed=m)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, POSITIONS) uint32; sets must not be empty."""
    rng = np.random.default_rng(20)
    a = rng.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, POSITIONS, dtype=np.uint64)
    every = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), POSITIONS), np.uint32)
    for i in range(POSITIONS):
        x = every * a[i] + b[i]
        out[:, i] = np.minimum.reduceat((x ^ (x >> np.uint64(33))) * _MIX >> np.uint64(32), starts)
    return out


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, n (set size), fp (digest of the set), sig (minwise tokens; null for empty sets), mark (their low 16 bits, for comparison)."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + T.StructType.fromDDL("n long, fp string, sig array<int>, mark binary").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, 1):
                sets = shingle_sets(texts, words)
                some = [i for i, s in enumerate(sets) if len(s)]
                sig, mark = [None] * len(sets), [None] * len(sets)
                if some:
                    for i, s in zip(some, signatures([sets[i] for i in some]).view(np.int32)):
                        sig[i], mark[i] = s, s.astype(np.uint16).tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]), pa.array(sig, pa.list_(pa.int32())), pa.array(mark, pa.binary())], names=schema.names)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("t")).mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first `keys` columns, of rows sorted by these; several whole runs at a time."""
    held: list[pa.RecordBatch] = []

    def last_run(b: pa.RecordBatch) -> int:
        """Where the last run begins."""
        start = 0
        for k in range(keys):
            v = np.asarray(b.column(k))
            diff = np.flatnonzero(v != v[-1])
            start = max(start, int(diff[-1]) + 1 if len(diff) else 0)
        return start

    for b in batches:
        if not b.num_rows:
            continue
        at = last_run(b)
        if held and any(held[-1].column(k)[-1] != b.column(k)[0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        if at:
            held.append(b.slice(0, at))
            yield pa.Table.from_batches(held)
            held = []
        held.append(b.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _runs(t: pa.Table, keys: int) -> np.ndarray:
    change = np.zeros(t.num_rows, bool)
    change[0] = True
    for k in range(keys):
        v = np.asarray(t.column(k))
        change[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(change), t.num_rows)


def _forest(reps: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """A spanning forest of the graph on rows, whose edges come in blocks; rows of one representative are one vertex."""
    root = np.unique(reps, return_index=True, return_inverse=True)
    root = root[1][root[2]].tolist()

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for us, vs in pairs:
        for u, v in zip(us.tolist(), vs.tolist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((u, v))
    return out


def _maybe(sig: np.ndarray, n: np.ndarray, side: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in a node that may be links, a few rows against all later ones at a time; two blocks: only across."""
    for lo in range(0, len(sig), 64):
        part = sig[lo : lo + 64]
        same = np.zeros((len(part), len(sig) - lo), np.uint8)
        for k in range(POSITIONS):
            same += part[:, k, None] == sig[None, lo:, k]
        small = np.minimum(n[lo : lo + 64, None], n[None, lo:])
        ok = (same >= MAYBE * POSITIONS) & (100 * small >= share * np.maximum(n[lo : lo + 64, None], n[None, lo:]))
        u, v = np.nonzero(ok)
        keep = (v > u) & ((side[lo + u] != side[lo + v]) | (side[lo + u] < 0))
        yield lo + u[keep], lo + v[keep]


EDGE = "u long, v long, node long"


def _edges(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    a = np.array(rows, np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays([pa.array(a[:, k]) for k in range(3)], names=["u", "v", "node"])


#: A key with this share of all rows is hot; so there are at most 1 / HOT hot keys.
HOT = 1 / 256


def _told(rows: DataFrame, facts: DataFrame, key: str, size: str) -> DataFrame:
    """rows joined with the facts about their key (a stored table): those of the few hot keys are broadcast, so no task gets all rows of one."""
    least = max((facts.agg(F.sum(size)).first()[0] or 0) * HOT, 2.0)
    hot = facts.where(F.col(size) >= least)
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(facts.where(F.col(size) < least), key)
    return near.unionByName(far)


def _known(rows: DataFrame, facts: DataFrame, key: str, size: str) -> DataFrame:
    """As _told, for facts of large groups: few beside their rows, so all are broadcast up to the counted bound."""
    return rows.join(F.broadcast(facts), key) if facts.count() <= SENT_ROWS else _told(rows, facts, key, size)


def _met(table: DataFrame, rows: DataFrame) -> DataFrame:
    """table joined by rep with rows (a stored table): up to the counted bound rows are broadcast, and table isn't shuffled."""
    return table.join(F.broadcast(rows) if rows.count() <= SENT_ROWS else rows, "rep")


def _led(rows: DataFrame, key: str) -> DataFrame:
    """Members of large groups (key, rep, size, lead) by block: the leader goes to each, as side 1."""
    many = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), many).cast("int")
    places = F.when(F.col("rep") == F.col("lead"), F.sequence(F.lit(0), many - 1)).otherwise(F.array(own))
    return rows.select(key, "rep", (F.col("rep") == F.col("lead")).cast("int").alias("side"), F.explode(places).alias("i")).withColumn("j", F.lit(0))


def _rest(rows: DataFrame, linked: DataFrame, facts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Members of large groups that don't hang together with their leader (key, rep), and the groups that have such (key, size, rest).

    linked: (key, rep) of members that do. facts: key and size of the large groups.
    """
    rest = stored(rows.where("rep != lead").join(linked, [key, "rep"], "left_anti").select(key, "rep"))
    return rest, stored(facts.select(key, "size").join(rest.groupBy(key).agg(F.count("*").alias("rest")), key))


def _rest_against_all(rows: DataFrame, rest: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Members of the groups in facts by pairs of blocks: side 1 is the rest, side 0 all."""
    few = F.ceil(F.col("rest") / BLOCK).cast("int")
    many = F.ceil(F.col("size") / BLOCK).cast("int")
    side = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = _known(rows.select(key, "rep"), facts, key, "size").select(key, "rep", F.lit(0).alias("side"), F.explode(F.sequence(F.lit(0), few - 1)).alias("i"), side(many).alias("j"))
    some = _known(rest, facts, key, "size").select(key, "rep", F.lit(1).alias("side"), side(few).alias("i"), F.explode(F.sequence(F.lit(0), many - 1)).alias("j"))
    return every.unionByName(some)


def compared(rows: DataFrame, share: float) -> DataFrame:
    """u, v, node: a spanning forest of the pairs that may be links in each (node, i, j), across sides where side isn't -1. rows have n and mark too."""
    rows = rows.select("node", "i", "j", "rep", "side", "n", "mark")
    rows = rows.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            cut, out = _runs(t, 3), []
            own, rep, side, n = (np.asarray(t.column(k)) for k in (0, 3, 4, 5))
            sig = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint16).reshape(-1, POSITIONS)
            for lo, hi in zip(cut[:-1], cut[1:]):
                if hi - lo == 2 and side[lo] < 0:  # most nodes
                    if (sig[lo] == sig[lo + 1]).sum() >= MAYBE * POSITIONS:
                        out.append((rep[lo], rep[lo + 1], own[lo]))
                elif hi - lo > 1:
                    out += [(rep[lo + u], rep[lo + v], own[lo]) for u, v in _forest(rep[lo:hi], _maybe(sig[lo:hi], n[lo:hi], side[lo:hi], share))]
            yield _edges(out)

    return rows.mapInArrow(run, EDGE).where("u != v")


def search(reps: DataFrame, share: float, trees: int, small: int, branch: int, depth: int) -> DataFrame:
    """u, v: pairs that may be links and connect what all such pairs connect, over all trees and levels."""
    seed = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(t * (POSITIONS // trees)).alias("p")) for t in range(trees)])
    now = reps.select("rep", "sig", F.explode(seed).alias("s")).select("rep", F.xxhash64("s.t", F.element_at("sig", F.col("s.p") + 1)).alias("node"))
    marks = reps.select("rep", "n", "mark")
    found: list[DataFrame] = []
    waiting = None  # rests to be compared with all; they go along with the next level's nodes
    for level in range(depth + 1):
        now = stored(now)
        sizes = stored(now.groupBy("node").agg(F.count("*").alias("size"), F.min("rep").alias("lead")).where("size > 1"))
        now = stored(_told(now, sizes, "node", "size"))
        large, big = now.where(F.col("size") > small), sizes.where(F.col("size") > small)
        alone = now.where(F.col("size") <= small).select("node", "rep", F.lit(-1).alias("side"), F.lit(0).alias("i"), F.lit(0).alias("j"))
        rows = alone.unionByName(_led(large, "node"))
        if level:  # few beside all representatives
            rows = _met(marks, stored(rows.unionByName(waiting)))
        else:
            rows = rows.join(marks, "rep")
        near, waiting = stored(compared(rows, share)), None
        found.append(near.select("u", "v"))
        if big.isEmpty():
            break
        linked = near.select("node", F.explode(F.array("u", "v")).alias("rep")).distinct()
        rest, facts = _rest(large, linked, big, "node")
        more = facts.where((F.col("rest") > BLOCK) & F.lit(level < depth))  # these branch, at the last level none
        waiting = _rest_against_all(large, rest, facts.where((F.col("rest") <= BLOCK) | F.lit(level == depth)), "node")
        if more.isEmpty():
            break
        grown = _met(reps.select("rep", "sig"), stored(_known(large.select("node", "rep"), more, "node", "rest").select("node", "rep")))
        at = lambda j: F.pmod(F.xxhash64("node", F.lit(level), F.lit(j)), F.lit(POSITIONS)).cast("int")  # noqa: B023,E731
        now = grown.select("rep", F.explode(F.array(*[F.xxhash64("node", at(j), F.element_at("sig", at(j) + 1)) for j in range(branch)])).alias("node"))
    if waiting is not None:
        found.append(compared(_met(marks, stored(waiting)), share).select("u", "v"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _true_links(sets: list[np.ndarray], side: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links by exact counts of common shingles: each set is read off the inverted lists of all."""
    n = np.array([len(s) for s in sets])
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    head = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    reach = np.append(head[1:], len(every))
    for u, s in enumerate(sets):
        k = np.searchsorted(every[head], s)
        lists = [owner[a:b] for a, b in zip(head[k].tolist(), reach[k].tolist()) if b - a > 1]
        if not lists:
            continue
        both = np.bincount(np.concatenate(lists), minlength=len(sets))
        ok = 100 * both >= share * (n[u] + n - both)
        ok[: u + 1] = False
        if side[u] >= 0:
            ok &= side != side[u]
        v = np.flatnonzero(ok)
        if len(v):
            yield np.full(len(v), u), v


def links(docs: DataFrame, id_col: str, text_col: str, groups: DataFrame, words: int, share: float) -> DataFrame:
    """u, v: true links inside groups (rep, comp) that connect what all true links connect."""
    sizes = stored(groups.groupBy("comp").agg(F.count("*").alias("size"), F.min("rep").alias("lead")))
    own = stored(_told(groups, sizes, "comp", "size"))
    texts = docs.select(docs[id_col].cast("long").alias("rep"), docs[text_col].alias("t"))
    mine = own.select("rep", "comp")
    joined = texts.join(F.broadcast(mine) if own.count() <= SENT_ROWS else mine, "rep").select("comp", "rep", "t")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, 2):
                sets = [s.tobytes() for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(rows)) for k in range(2)], pa.array(sets, pa.binary())], names=["comp", "rep", "set"])

    sets = stored(joined.mapInArrow(cut, "comp long, rep long, set binary").where(F.octet_length("set") > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3):
            cut, out = _runs(t, 3), []
            comp, rep, side = (np.asarray(t.column(k)) for k in (0, 3, 4))
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if hi - lo > 1:
                    sets = [np.frombuffer(v.as_py(), np.uint64) for v in t.column(5).slice(lo, hi - lo)]
                    out += [(rep[lo + u], rep[lo + v], comp[lo]) for u, v in _forest(rep[lo:hi], _true_links(sets, side[lo:hi], share))]
            yield _edges(out)

    def confirmed(rows: DataFrame) -> DataFrame:
        rows = _met(sets.select("rep", "set"), stored(rows)).select("comp", "i", "j", "rep", "side", "set")
        return rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j", "rep").mapInArrow(run, EDGE).where("u != v").withColumnRenamed("node", "comp")

    small, large = own.where(F.col("size") <= BLOCK), own.where(F.col("size") > BLOCK)
    alone = small.select("comp", "rep", F.lit(-1).alias("side"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    near = stored(confirmed(alone.unionByName(_led(large, "comp"))))
    out, big = near.select("u", "v"), sizes.where(F.col("size") > BLOCK)
    if not big.isEmpty():
        linked = near.select("comp", F.explode(F.array("u", "v")).alias("rep")).distinct()
        rest, facts = _rest(large, linked, big, "comp")
        if not facts.isEmpty():
            out = out.unionByName(confirmed(_rest_against_all(large, rest, facts, "comp")).select("u", "v"))
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """rep, comp: each vertex of the edges and the smallest vertex it is connected with."""
    now, last = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()), None
    while True:
        # large star: a vertex hands its smallest neighbour (or itself) to the larger neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: it hands it to itself and the smaller neighbours
        big = big.where("u != v").distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        near = big.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        before, now = now, stored(near.where("u != v").distinct())
        discard(before)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    star = now.groupBy(F.col("u").alias("rep")).agg(F.min("v").alias("comp"))
    return star.unionByName(now.select(F.col("v").alias("rep"), F.col("v").alias("comp")).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, share: int = 80, trees: int = 8, small: int = BLOCK, branch: int = 2, depth: int = 6) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs. share: least similarity in percent."""
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} must hold whole numbers")
    sets = stored(sketch(docs, id_col, text_col, words))
    some = sets.where("n > 0 AND doc_id IS NOT NULL")
    reps = stored(some.groupBy("fp").agg(F.min("doc_id").cast("long").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.max("mark").alias("mark"), F.count("*").alias("copies")))
    groups = components(search(reps.select("rep", "n", "sig", "mark"), share, trees, small, branch, depth))
    # a document of several texts joins the classes of all of them
    named = stored(_told(some.select("doc_id", "fp"), reps.select("fp", "rep", "copies"), "fp", "copies").select("doc_id", "fp", "rep"))
    same = named.where("doc_id != rep").select(F.col("doc_id").cast("long").alias("u"), F.col("rep").alias("v"))
    twice = some.groupBy("doc_id").agg(F.count_distinct("fp").alias("k")).where("k > 1").select(F.col("doc_id").cast("long").alias("u"))
    true = links(docs, id_col, text_col, groups, words, share).unionByName(same.join(twice, "u", "left_semi"))
    final = components(true)
    member = stored(reps.select("fp", "copies", "rep").join(final, "rep", "left").select("fp", "copies", F.coalesce("comp", "rep").alias("comp")))
    linked = _told(some.select("doc_id", "n", "fp"), member, "fp", "copies").select("doc_id", "n", "comp")
    alone = sets.where("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", "n", F.col("doc_id").cast("long").alias("comp"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("comp") == F.col("doc_id"), F.lit(True)).alias("kept"))
