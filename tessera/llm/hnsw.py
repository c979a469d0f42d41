"""Approximate nearest neighbours: a navigable small-world graph per shard, shard results merged.

Distinct vectors are dealt to shards: as many as the cluster has cores, so that the work of a query doesn't
grow with the table, but none of less than `least_rows` (one then) or more than `most_rows` vectors, what a
worker holds. Each shard's graph is a layered one, kept as flat neighbour arrays (a row of links per vector
and layer, -1 for none) in a stored table. It travels once, to the task that then streams the queries
through it, a block at a time. Searches of a block run in step: each round expands the best open candidates
of all queries at once in numpy. Largest inner product becomes nearest neighbour by one more component,
sqrt(R^2 - |x|^2), with R the shard's largest norm; queries have 0 there.

Equal vectors are one point of the graph with its least k + 1 ids, so copies neither crowd a beam nor hide
one another. The candidates a search finds are scored anew in double precision on the original vectors.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part as
queries or candidates; a vector meets those of its own length only; null ids take no part; ties go to the
smaller id; repeated ids of one vector count once; an id of several vectors is asked and listed for each; with
fewer candidates than k all are returned; an empty table gives no rows; other columns are ignored. Which
neighbours are missed may differ with the number of cores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored


class Graph:
    """links[l]: (rows, width) int32 of layer l; layer l > 0 has the first counts[l] vectors only (sorted by layer)."""

    def __init__(self, x: np.ndarray, links: list[np.ndarray], counts: list[int]):
        self.x, self.links, self.counts = x, links, counts

    @classmethod
    def build(cls, x: np.ndarray, m: int = 16, ef: int = 80, batch: int = 128, seed: int = 1) -> Graph:
        """x: (n, d) float32, at any lengths; near means a large inner product of rows of equal norm."""
        n = len(x)
        counts = [n]
        while counts[-1] > 4 * m and len(counts) < 8:
            counts.append(counts[-1] // m)  # expected sizes of the layers, their members drawn by shuffling
        x = np.ascontiguousarray(x)
        g = cls(x, [np.full((c, 2 * m if layer == 0 else m), -1, np.int32) for layer, c in enumerate(counts)], counts)
        for layer in range(len(counts) - 1, -1, -1):  # the sparse layers first: they lead the way for the next
            links, c = g.links[layer], counts[layer]
            width, done = links.shape[1], 0
            while done < c:
                new = np.arange(done, min(c, done + min(batch, max(16, done))))
                near, sim = np.full((len(new), 0), 0), np.zeros((len(new), 0), np.float32)
                if done:
                    entry = g._descend(x[new], layer, done)
                    near, sim = g._beam(x[new], layer, entry, min(ef, done), done)
                mutual = x[new] @ x[new].T
                np.fill_diagonal(mutual, -np.inf)
                near = np.concatenate((near, np.broadcast_to(new, mutual.shape)), axis=1)
                sim = np.concatenate((sim, mutual), axis=1)
                g._link(links, new, near, sim, width)
                done += len(new)
        return g

    def _spread(self, own: np.ndarray, near: np.ndarray, sim: np.ndarray, keep: int) -> np.ndarray:
        """Of each row's candidates, best first, those nearer to the row than to one already kept; then the best others."""
        near, sim = near.astype(np.int32), sim.copy()
        sim[near < 0] = -np.inf
        take = min(near.shape[1], 3 * keep)
        top = np.argpartition(-sim, take - 1, axis=1)[:, :take]
        sim = np.take_along_axis(sim, top, 1)
        near = np.take_along_axis(near, top, 1)
        order = np.argsort(-sim, axis=1, kind="stable")
        near, sim = np.take_along_axis(near, order, 1), np.take_along_axis(sim, order, 1)
        v = self.x[near]
        among = v @ v.transpose(0, 2, 1)
        good = np.isfinite(sim)
        kept = np.zeros(near.shape, bool)
        blocked = ~good
        for j in range(near.shape[1]):
            ok = ~blocked[:, j] & (kept.sum(1) < keep)
            kept[:, j] = ok
            blocked |= ok[:, None] & (among[:, j] > sim)
        rank = np.where(kept, 0, np.where(good, 1, 2)) * near.shape[1] + np.arange(near.shape[1])
        first = np.argsort(rank, axis=1)[:, :keep]
        out = np.where(np.take_along_axis(good, first, 1), np.take_along_axis(near, first, 1), -1)
        return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)

    def _link(self, links: np.ndarray, new: np.ndarray, near: np.ndarray, sim: np.ndarray, width: int) -> None:
        links[new] = self._spread(new, near, sim, width)
        # the other direction: what points back to a vector joins its links, of which the well spread are kept
        src, dst = np.repeat(new, width), links[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        rows, at, n = np.unique(dst, return_index=True, return_counts=True)
        most = n.max() if len(n) else 0
        if not most:
            return
        extra = np.full((len(rows), most), -1, np.int32)
        extra[np.repeat(np.arange(len(rows)), n), np.arange(len(dst)) - np.repeat(at, n)] = src
        extra[(extra[:, :, None] == links[rows][:, None, :]).any(2)] = -1
        every = np.concatenate((links[rows], extra), axis=1)
        free = (every >= 0).sum(1)
        few = free <= width
        if few.any():
            e = every[few]
            links[rows[few]] = np.take_along_axis(e, np.argsort(e < 0, axis=1, kind="stable"), 1)[:, :width]
        if (~few).any():
            e, r = every[~few], rows[~few]
            s = np.einsum("bd,bkd->bk", self.x[r], self.x[e])
            links[r] = self._spread(r, e, s, width)

    def _descend(self, q: np.ndarray, layer: int, limit: int) -> np.ndarray:
        at = np.zeros((len(q), 1), np.int32)
        for up in range(len(self.counts) - 1, layer, -1):
            at = self._beam(q, up, at, 4, self.counts[up])[0][:, :1]
        return np.where(at < limit, at, 0)

    def _beam(self, q: np.ndarray, layer: int, entry: np.ndarray, ef: int, limit: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Each query's ef best, best first, -1 where fewer were reached."""
        x, links, b = self.x, self.links[layer], len(q)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, limit + 1), bool)
        seen[:, limit] = True
        seen[rows, entry] = True
        ids = np.full((b, ef), -1, np.int32)
        sim = np.full((b, ef), -np.inf, np.float32)
        ids[:, : entry.shape[1]] = entry
        sim[:, : entry.shape[1]] = np.einsum("bd,bkd->bk", q, x[entry])
        open_ = ids >= 0
        live = np.arange(b)
        while len(live):
            s = np.where(open_[live], sim[live], -np.inf)
            k = min(step, ef)
            pick = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < ef else np.broadcast_to(np.arange(ef), s.shape)
            ok = np.take_along_axis(open_[live], pick, 1)
            open_[live[:, None], pick] = False
            nbr = links[np.where(ok, ids[live[:, None], pick], 0)]
            nbr = np.where(ok[:, :, None], nbr, -1).reshape(len(live), -1)
            nbr = np.where((nbr < 0) | (nbr >= limit), limit, nbr)
            nbr.sort(axis=1)
            nbr[:, 1:][nbr[:, 1:] == nbr[:, :-1]] = limit
            nbr[seen[live[:, None], nbr]] = limit
            seen[live[:, None], nbr] = True
            fresh = nbr < limit
            width = fresh.sum(1).max() if fresh.size else 0
            if width:
                nbr = np.take_along_axis(nbr, np.argsort(~fresh, axis=1, kind="stable"), 1)[:, :width]
                fresh = nbr < limit
                nbr = np.where(fresh, nbr, 0)
                v = np.where(fresh, np.einsum("bd,bkd->bk", q[live], x[nbr]), -np.inf)
                all_s = np.concatenate((sim[live], v), axis=1)
                all_i = np.concatenate((ids[live], np.where(fresh, nbr, -1)), axis=1)
                all_o = np.concatenate((open_[live], fresh), axis=1)
                top = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
                sim[live], ids[live], open_[live] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1), np.take_along_axis(all_o, top, 1)
            live = live[open_[live].any(axis=1)]
        order = np.argsort(-sim, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)

    def search(self, q: np.ndarray, k: int, ef: int, batch: int = 128) -> np.ndarray:
        out = []
        for lo in range(0, len(q), batch):
            part = np.ascontiguousarray(q[lo : lo + batch])
            ids = self._beam(part, 0, self._descend(part, 0, self.counts[0]), min(ef, self.counts[0]), self.counts[0])[0][:, :k]
            out.append(np.pad(ids, ((0, 0), (0, k - ids.shape[1])), constant_values=-1))
        return np.concatenate(out) if out else np.zeros((0, k), np.int32)


def lifted(x: np.ndarray) -> np.ndarray:
    """x with the component that makes all norms equal; scaled to norm 1."""
    x = x / np.abs(x).max()  # squares of large components stay finite
    sq = (x.astype(np.float64) ** 2).sum(1)
    r = sq.max()
    return (np.concatenate((x, np.sqrt(np.maximum(r - sq, 0))[:, None]), axis=1) / np.sqrt(r)).astype(np.float32)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v, dim: the rows that take part; components keep their precision."""
    kind = "array<float>" if df.schema[vec_col].dataType.elementType.typeName() == "float" else "array<double>"
    rows = df.select(df[id_col].cast("long").alias("id"), df[vec_col].cast(kind).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0))
    return rows.withColumn("dim", F.size("v"))


def neighbours(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", is_query=None, k: int = 20, least_rows: int = 1024, most_rows: int = 1 << 18, shards: int | None = None, m: int = 16, ef: int = 160, salts: int = 32) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k nearest among all other rows.

    is_query: a condition on df's column id_col, written for a column named id; all rows if None. shards: of each
    length of vectors; by default from its number of distinct vectors and the cluster's cores.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vec_col)
    wide = rows.schema["v"].dataType.elementType.typeName() == "double"
    real = np.float64 if wide else np.float32
    # a vector's least k + 1 ids, first within salts: copies of one vector may be a third of all rows
    key = F.md5(F.concat_ws(",", F.transform("v", lambda c: F.hex(c.cast("double").cast("string"))))).alias("key")
    rows = rows.select("id", "v", "dim", key, F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).distinct()
    for by in (("key", "salt"), ("key",)):
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("r") <= k + 1)
    points = stored(rows.groupBy("key").agg(F.any_value("v").alias("v"), F.any_value("dim").alias("dim"), F.sort_array(F.collect_list("id")).alias("ids")))
    cores = spark.sparkContext.defaultParallelism
    count = F.count("*")
    many = F.lit(shards) if shards else F.greatest(F.ceil(count / most_rows), F.least(F.ceil(count / least_rows), F.lit(cores)))
    sizes = stored(points.groupBy("dim").agg(many.cast("int").alias("shards")))  # a row per length
    points = points.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))

    def index(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        x = np.array(pdf["v"].tolist(), real)
        g = Graph.build(lifted(x), m)
        return pd.DataFrame({"dim": [x.shape[1]], "shard": [int(pdf["shard"].iloc[0])], "x": [x.tobytes()], "links": [[a.tobytes() for a in g.links]], "ids": [[int(i) for ids in pdf["ids"] for i in ids]], "many": [[len(i) for i in pdf["ids"]]]})

    graphs = stored(points.groupBy("dim", "shard").applyInPandas(index, "dim int, shard int, x binary, links array<binary>, ids array<long>, many array<int>"))
    queries = usable(df, id_col, vec_col)
    queries = (queries.where(is_query) if is_query is not None else queries).distinct()
    asked = queries.join(F.broadcast(sizes), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asked = asked.select("dim", "shard", F.lit(1).alias("step"), "id", "v")
    both = graphs.withColumn("step", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    parts = max(sizes.agg(F.sum("shards")).first()[0] or 0, 1)
    # a shard's graph comes first, then its queries
    both = both.repartition(parts, "dim", "shard").sortWithinPartitions("dim", "shard", "step").select("dim", "shard", "step", "x", "links", "ids", "many", "id", "v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def open_graph(b: pa.RecordBatch, i: int):
            x = np.frombuffer(b.column(3)[i].as_py(), real).reshape(-1, b.column(0)[i].as_py())
            counts, links = [len(x)], b.column(4)[i].as_py()
            while len(counts) < len(links):
                counts.append(counts[-1] // m)
            g = Graph(lifted(x), [np.frombuffer(a, np.int32).reshape(c, -1) for a, c in zip(links, counts)], counts)
            n = b.column(6)[i].values.to_numpy()
            return x, g, b.column(5)[i].values.to_numpy(), np.cumsum(n) - n, n

        def block(own: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            x, g, ids, first, n = held
            unit = q / np.abs(q).max(axis=1, keepdims=True)
            flat = np.concatenate((unit / np.linalg.norm(unit, axis=1, keepdims=True), np.zeros((len(q), 1))), axis=1).astype(np.float32)
            near = g.search(flat, min(k + 1, len(x)), max(ef, 2 * k))
            row, col = np.nonzero(near >= 0)
            at = near[row, col]
            exact = np.einsum("nd,nd->n", q[row].astype(np.float64), x[at].astype(np.float64))
            # each point stands for its ids
            copies = n[at]
            row, score = np.repeat(row, copies), np.repeat(exact, copies)
            found = ids[np.repeat(first[at], copies) + np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)]
            other = found != own[row]
            row, score, found = row[other], score[other], found[other]
            order = np.lexsort((found, -score, row))
            row, score, found = row[order], score[order], found[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            top = rank < k
            return pa.RecordBatch.from_arrays([pa.array(own[row[top]]), pa.array(score[top]), pa.array(found[top])], names=["query_id", "s", "i"])

        for b in batches:
            step = np.asarray(b.column(2))
            cuts = [0, *(np.flatnonzero(step[1:] != step[:-1]) + 1).tolist(), len(step)] if len(step) else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if step[lo] == 0:
                    held = open_graph(b, hi - 1)  # a shard without queries has only its graph
                    continue
                for at in range(lo, hi, 1024):
                    part = b.slice(at, min(1024, hi - at))
                    q = part.column(8).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    yield block(np.asarray(part.column(7)), q)

    found = both.mapInArrow(search, "query_id long, s double, i long")
    best = found.groupBy("query_id").agg(F.collect_list(F.struct("s", "i")).alias("f"))
    # descending score, ascending id
    order = F.array_sort("f", lambda a, b: F.when(a["s"] > b["s"], -1).when(a["s"] < b["s"], 1).when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0))
    best = best.select("query_id", F.posexplode(F.slice(order, 1, k)).alias("p", "x"))
    return best.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.i").alias("vec_id"), F.col("x.s").alias("score"))
