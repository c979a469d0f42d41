"""K-d tree sharding: groups of equal texts are split at distributed weighted medians.

The points are groups of equal texts, weighed by the bytes of their rows. Their dimensions are the size,
the first id and the rank of each metadata value among its distinct values. A node with k shards left
splits its points along the widest dimension where floor(k/2)/k of its bytes lie below, so
leaves end at the target bytes. A group that alone reaches a shard's target gets a shard of its own
first. Cut points come from histogram passes for all nodes of a level at once (BINS bins, then BINS bins
inside the one bin that holds the cut, until it is close): what reaches the driver is a row per node.

Defined cases: a null text counts as no bytes and is a group of its own, apart from the empty one;
sizes are bytes + 1; null metadata comes before all other; a dimension in which all of a node's points
agree has no width there; ties along a dimension are cut by the group's hash; ids that aren't whole numbers
are placed by their hash; repeated rows stay together; rows alike in all columns have interchangeable
slots; an empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import stored

#: A coordinate has its value in the high bits and a hash of the group in the low ones, so no two groups tie for long.
HASH_BITS = 32
BINS = 4096
#: A cut may miss its goal by this share of it.
CLOSE = 0.002


#: A group with this share of all rows is hot; so there are at most 1 / HOT hot groups.
HOT = 1 / 256
#: Up to so many distinct metadata values, of so many bytes in all, their ranks are broadcast; beyond, the join is shuffled.
SENT_VALUES = 100_000
SENT_BYTES = 8 << 20
#: Parts in which a hot metadata value is spread where ranks are joined by a shuffle.
SALTS = 32


def ranks(points: DataFrame, value: str, parts: int = 64) -> DataFrame:
    """value, rank: from 1 by code point; sorted by ranges, so no task holds all values."""
    values = points.where(F.col(value).isNotNull()).groupBy(value).agg(F.lit(1).alias("_one")).select(value)
    values = stored(values.repartitionByRange(parts, value).select(value, F.spark_partition_id().alias("_p")))
    counts = values.groupBy("_p").agg(F.count("*").alias("_c"))  # a row per range
    before = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(value))
    return values.withColumn("_i", inside).join(F.broadcast(before), "_p").select(value, (F.col("_before") + F.col("_i")).alias("rank"))


def _with_rank(points: DataFrame, value: str, out: str) -> DataFrame:
    found = stored(ranks(points, value))
    size = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(value)), F.lit(0)).alias("b")).first()
    if size["n"] <= SENT_VALUES and size["b"] <= SENT_BYTES:
        joined = points.join(F.broadcast(found), value, "left")
    else:
        spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = points.withColumn("_salt", F.pmod(F.xxhash64("_g"), F.lit(SALTS))).join(spread, [value, "_salt"], "left").drop("_salt")
    return joined.withColumn(out, F.coalesce("rank", F.lit(0)).cast("long")).drop(value, "rank")


def shard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, meta: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, size, text_crc32, shard for each row of docs; rows of equal text share a shard."""
    text = F.coalesce(docs[text_col], F.lit(""))
    whole = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    number = docs[id_col].cast("long") if whole else F.coalesce(docs[id_col].cast("string").try_cast("long"), F.xxhash64(docs[id_col]))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.when(docs[text_col].isNull(), F.lit("null")).otherwise(F.md5(F.encode(text, "UTF-8"))).alias("_g"),
        F.coalesce(number, F.lit(0)).alias("_d"),
        *[docs[m].cast("string").alias(f"_m{i}") for i, m in enumerate(meta)],
    )
    rows = stored(rows)
    points = rows.groupBy("_g").agg(F.sum("size").alias("_w"), F.count("*").alias("_rows"), F.max("size").alias("_s"), F.min("_d").alias("_d"), *[F.min(f"_m{i}").alias(f"_m{i}") for i in range(len(meta))])
    points = stored(points)
    ends = points.agg(F.min("_d").cast("double").alias("lo"), F.max("_d").cast("double").alias("hi"), F.sum("_rows").alias("n")).first()
    low = F.pmod(F.xxhash64("_g"), F.lit(1 << HASH_BITS))
    place = (F.col("_d").cast("double") - F.lit(ends["lo"] or 0.0)) / F.lit(max((ends["hi"] or 0.0) - (ends["lo"] or 0.0), 1.0))
    dims = {"_x0": F.round(F.log2(F.col("_s").cast("double")) * 1024).cast("long"), "_x1": F.floor(place * (1 << 30)).cast("long")}
    for i in range(len(meta)):
        points = _with_rank(points, f"_m{i}", f"_r{i}")
        dims[f"_x{i + 2}"] = F.col(f"_r{i}")
    points = stored(points.select("_g", "_w", "_rows", *[(v * (1 << HASH_BITS) + low).alias(k) for k, v in dims.items()]))
    where = _grow(points, list(dims), shards).cast("int").alias("shard")
    # rows of the few hot groups stay where they are; all others meet their group by a shuffle
    hot = points.where(F.col("_rows") >= F.lit(max((ends["n"] or 0) * HOT, 2.0))).select("_g", where)
    near = rows.join(F.broadcast(hot), "_g")
    far = rows.join(F.broadcast(hot.select("_g")), "_g", "left_anti").join(points.select("_g", where), "_g")
    return near.unionByName(far).select("doc_id", "size", "text_crc32", "shard")


def _grow(points: DataFrame, dims: list[str], shards: int):
    """The tree as one Column: a point's shard."""
    total = points.agg(F.sum("_w")).first()[0] or 0
    heavy = points.where(F.col("_w") * shards >= total).orderBy(F.desc("_w"), "_g").limit(shards - 1).select("_g", "_w").collect() if total else []
    own = [r["_g"] for r in heavy]
    rest = points.where(~F.col("_g").isin(own)) if own else points
    nodes = {0: (shards - len(own), len(own))}  # node -> shards left, first shard
    tree: dict[int, tuple[str, int, int, int]] = {}  # node -> dimension, cut, node below, node above
    leaves: dict[int, int] = {}
    spans: dict[str, int] = {}

    def walk(n: int, leaf):
        """The tree from node n on as one Column."""
        if n not in tree:
            return F.lit(leaf(n))
        d, cut, below, above = tree[n]
        return F.when(F.col(d) <= cut, walk(below, leaf)).otherwise(walk(above, leaf))

    while True:
        leaves |= {n: first for n, (k, first) in nodes.items() if k == 1}
        nodes = {n: v for n, v in nodes.items() if v[0] > 1}
        if not nodes:
            break
        at = rest.withColumn("_n", walk(0, lambda n: n)).where(F.col("_n").isin(list(nodes)))
        box = {r["_n"]: r for r in at.groupBy("_n").agg(F.sum("_w").alias("w"), *[F.min(d).alias(f"lo{d}") for d in dims], *[F.max(d).alias(f"hi{d}") for d in dims]).collect()}
        if box and not spans:
            spans = {d: max(1, _width(box[0], d)) for d in dims}
        cuts = _cuts(at, {n: _widest(r, dims, spans) for n, r in box.items()}, {n: r["w"] * (nodes[n][0] // 2) / nodes[n][0] for n, r in box.items()})
        grown = {}
        for n, (k, first) in nodes.items():
            below, above = 2 * len(tree) + 1, 2 * len(tree) + 2
            tree[n] = (*cuts.get(n, (dims[0], 0)), below, above)
            grown |= {below: (k // 2, first), above: (k - k // 2, first + k // 2)}
        nodes = grown
    out = walk(0, lambda n: leaves[n])
    for i, g in enumerate(own):
        out = F.when(F.col("_g") == g, F.lit(i)).otherwise(out)
    return out


def _width(r, d: str) -> int:
    """How far a node's values along d lie apart, the groups' hashes left aside."""
    return (r[f"hi{d}"] >> HASH_BITS) - (r[f"lo{d}"] >> HASH_BITS)


def _widest(r, dims: list[str], spans: dict[str, int]) -> tuple[str, int, int]:
    d = max(dims, key=lambda d: (_width(r, d) / spans[d], d))
    return d, r[f"lo{d}"], r[f"hi{d}"]


def _cuts(at: DataFrame, boxes: dict[int, tuple[str, int, int]], goals: dict[int, float]) -> dict[int, tuple[str, int]]:
    """By node: the dimension and the largest coordinate that goes below."""
    found = {}
    base = {n: 0.0 for n in boxes}
    while live := {n: b for n, b in boxes.items() if n not in found}:
        pick = lambda f: F.create_map(*[F.lit(x) for n in live for x in (n, f(n))])[F.col("_n")]  # noqa: B023,E731
        x = F.lit(None).cast("long")
        for n, (d, _, _) in live.items():
            x = F.when(F.col("_n") == n, F.col(d)).otherwise(x)
        step = lambda n: max(1, -(-(live[n][2] - live[n][1] + 1) // BINS))  # noqa: B023,E731
        bins = at.where(F.col("_n").isin(list(live))).select("_n", x.alias("_x"), "_w")
        bins = bins.where((F.col("_x") >= pick(lambda n: live[n][1])) & (F.col("_x") <= pick(lambda n: live[n][2])))
        bins = bins.groupBy("_n", ((F.col("_x") - pick(lambda n: live[n][1])) / pick(step)).cast("long").alias("_b")).agg(F.sum("_w").alias("_w"))
        run = F.sum("_w").over(Window.partitionBy("_n").orderBy("_b")) + pick(lambda n: float(base[n]))
        near = bins.withColumn("_run", run).withColumn("_gap", F.abs(F.col("_run") - pick(lambda n: float(goals[n]))))
        over = F.col("_run") >= pick(lambda n: float(goals[n]))
        got = near.groupBy("_n").agg(F.min(F.when(over, F.struct("_b", "_run", "_w"))).alias("hit"), F.min(F.struct("_gap", "_b")).alias("best")).collect()
        for r in got:
            n, s = r["_n"], step(r["_n"])
            d, lo, _ = live[n]
            if s == 1 or r["hit"] is None or r["best"]["_gap"] <= CLOSE * goals[n]:
                found[n] = (d, lo + (r["best"]["_b"] + 1) * s - 1)
            else:
                b = r["hit"]["_b"]
                base[n] = r["hit"]["_run"] - r["hit"]["_w"]
                boxes[n] = (d, lo + b * s, lo + (b + 1) * s - 1)
    return found


def with_slots(rows: DataFrame, shards: int = 16, slots: int = 4096) -> DataFrame:
    """rows and slot, gapless from 0 within each shard; ordered by a hash bucket of the row, then by its columns.

    Numbers come from counts by (shard, bucket), at most shards * slots rows, so no task holds a shard. Rows
    alike in all columns are counted first and numbered in a run, so no task holds all of them either.
    """
    columns = rows.columns
    same = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_b", F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int"))
    counts = same.groupBy("shard", "_b").agg(F.sum("_n").alias("_c"))
    before = counts.select("shard", "_b", (F.sum("_c").over(Window.partitionBy("shard").orderBy("_b")) - F.col("_c")).alias("_before"))
    inside = F.sum("_n").over(Window.partitionBy("shard", "_b").orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    first = same.withColumn("_i", inside).join(F.broadcast(before), ["shard", "_b"]).withColumn("_first", F.col("_before") + F.col("_i"))
    return first.select(*columns, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias("slot"))
