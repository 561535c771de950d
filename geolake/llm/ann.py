"""Nearest neighbours by vantage-point trees, one per shard.

Equal vectors are one item with its smallest k + 1 ids (more cannot be among
k nearest).  Items belong to the region of their nearest pivot, pivots being a
bounded sample of the items; a region is cut into shards of bounded size, and a
shard's task builds one vantage-point tree and streams queries through it.  A
query first searches its own region, which bounds its k-th best distance; it
is then sent to the regions that the triangle inequality (distance to the
pivot less the region's radius) does not exclude, and in a tree it skips the
subtrees that hold nothing nearer: than ``factor`` times the bound, so factor 1
is exact and a smaller one skips more.  Items are not copied, but for shards
that more than BLOCK_ROWS queries ask: once for each such block of queries.

Distances are computed in double precision on the original vectors, summed in
component order.  Defined cases: vectors that are null, empty, all zero or
hold a null or non-finite component take no part; only vectors of a query's
own length are its candidates; rows with the query's own id are not; a row
repeated in full counts once; ties go to the smaller id; rows with a null id
take no part.  With fewer candidates than k, all are returned.  A query id with
several different vectors is searched with each of them; a row's distance to it
is the smallest of theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stage, shuffle_parts, stage

#: Items of a shard, queries that one copy of it serves, and queries searched
#: at once: a task holds a shard and a batch.
SHARD_ROWS, BLOCK_ROWS, BATCH = 4096, 65_536, 1024
#: Pivots at most; their regions are cut into shards, however large.
PIVOTS = 1024
LEAF = 64


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(ok, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all of ``b``."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(total)


class Tree:
    """A vantage-point tree over items: vectors, their smallest ids and, where
    there is another, their second smallest ids."""

    def __init__(self, vecs: np.ndarray, ids: np.ndarray, second: np.ndarray):
        self.vecs, self.ids, self.second = vecs, ids, second
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows):
        if len(rows) <= LEAF:
            return rows
        # The vantage point: of a few rows, the one with the widest spread.
        tries = rows[np.linspace(0, len(rows) - 1, 5).astype(int)]
        probe = rows[np.linspace(0, len(rows) - 1, 64).astype(int)]
        best = tries[np.argmax(distances(self.vecs[tries], self.vecs[probe]).std(axis=1))]
        rest = rows[rows != best]
        d = distances(self.vecs[[best]], self.vecs[rest])[0]
        inner = np.zeros(len(rest), bool)
        inner[np.argsort(d, kind="stable")[:len(rest) // 2]] = True
        sides = [(d[part].min(), d[part].max(), self._build(rest[part])) for part in (inner, ~inner)]
        return best, sides

    def search(self, q: np.ndarray, q_ids: np.ndarray, k: int, factor: float = 1.0, bound: np.ndarray | None = None):
        """(distances, item numbers) of the k best items of every query, ties
        by their smallest id; inf pads.  Items of the query's id alone are
        none.  ``bound``: a distance that the k-th best is known not to exceed."""
        none = np.iinfo(np.int64).max
        best_d = np.full((len(q), k), np.inf)
        best_i, best_n = np.full((len(q), k), none), np.full((len(q), k), none)
        bound = np.full(len(q), np.inf) if bound is None else bound

        def offer(at, d, items):
            own = self.ids[items] == q_ids[at, None]
            n = np.where(own, self.second[items], self.ids[items])
            d = np.where(n == none, np.inf, d)
            i = np.broadcast_to(items, d.shape)
            some = (d <= best_d[at, -1:]).any(axis=1)
            at, d, i, n = at[some], d[some], i[some], n[some]
            d, i, n = (np.concatenate([old[at], new], axis=1) for old, new in ((best_d, d), (best_i, i), (best_n, n)))
            order = np.lexsort((n, d), axis=-1)[:, :k]
            for kept, new in ((best_d, d), (best_i, i), (best_n, n)):
                kept[at] = np.take_along_axis(new, order, 1)

        def visit(node, at):
            if not len(at):
                return
            if not isinstance(node, tuple):
                offer(at, distances(q[at], self.vecs[node]), node)
                return
            point, sides = node
            d = distances(q[at], self.vecs[[point]])
            offer(at, d, np.array([point]))
            d = d[:, 0]
            # How much nearer than the side's ring a query is at best (the
            # slack covers rounding of sums).
            gaps = [np.maximum(lo - d, d - hi) * (1 - 1e-9) for lo, hi, _ in sides]
            near = gaps[0] <= gaps[1]
            for first in (True, False):
                for side in (0, 1):
                    mine = (near == (side == 0)) == first
                    mine &= gaps[side] <= np.minimum(best_d[at, -1], bound[at]) * factor
                    visit(sides[side][2], at[mine])

        visit(self.root, np.arange(len(q)))
        return best_d, best_i


class Regions:
    """Pivots of every dimension, and the radii of their regions."""

    def __init__(self, pivots: list[tuple[int, list[float]]]):
        self.of = {}
        for p, (dim, _) in enumerate(pivots):
            self.of.setdefault(dim, []).append(p)
        self.vecs = {d: np.array([pivots[p][1] for p in own], float) for d, own in self.of.items()}
        self.radius = np.zeros(len(pivots))

    def nearest(self, vecs: np.ndarray):
        """Number and distance of the nearest pivot of each vector; a dimension
        without pivots is one region, -1."""
        if (dim := vecs.shape[1]) not in self.of:
            return np.full(len(vecs), -1), np.zeros(len(vecs))
        d = distances(vecs, self.vecs[dim])
        at = d.argmin(axis=1)
        return np.array(self.of[dim])[at], d[np.arange(len(vecs)), at]

    def within(self, vecs: np.ndarray, reach: np.ndarray):
        """(query, pivot) of all regions that may hold something in reach."""
        if (dim := vecs.shape[1]) not in self.of:
            return np.zeros(0, int), np.zeros(0, int)
        own = np.array(self.of[dim])
        far = (distances(vecs, self.vecs[dim]) - self.radius[own]) * (1 - 1e-9)
        row, col = np.nonzero(far <= reach[:, None])
        return row, own[col]


def _by_dim(column):
    """(rows, matrix) of the vectors of each length in a batch."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)
    start = column.offsets.to_numpy()[:-1]
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        yield rows, flat[start[rows, None] + np.arange(dim)]


def _placed(rows: DataFrame, regions) -> DataFrame:
    """``rows`` (n, id, vec) with their nearest pivot ``p`` and distance ``d``."""
    names = rows.columns

    def run(batches):
        for batch in batches:
            p, d = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for at, vecs in _by_dim(batch.column("vec")):
                p[at], d[at] = regions.value.nearest(vecs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array(d)], names=[*names, "p", "d"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, p int, d double")


def _items(points: DataFrame, k: int) -> DataFrame:
    """(n, ids, vec): different vectors and their smallest k + 1 ids."""
    least = Window.partitionBy("vec").orderBy("id")
    some = points.distinct().withColumn("at", F.row_number().over(least)).where(F.col("at") <= k + 1)
    return some.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("n"), "ids", "vec")


def _searched(items: DataFrame, sent: DataFrame, k: int, factor: float) -> DataFrame:
    """(q, id, n, ids, score): the k best items of every query in each shard of
    the region it is sent to.  ``items`` (n, ids, vec, p), ``sent`` (q, id, vec,
    p, bound)."""
    where = ["dim", "p"]
    items, sent = (t.withColumn("dim", F.size("vec")) for t in (items, sent))
    shards = items.groupBy(*where).agg(F.ceil(F.count("*") / F.lit(SHARD_ROWS)).cast("int").alias("shards"))
    blocks = sent.groupBy(*where).agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    sizes = stage(shards.join(blocks, where), "sizes")   # a row for each pivot

    def dealt(c, n):
        return F.pmod(F.xxhash64(c), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = [*where, "shard", "block"]
    there = items.join(sizes, where).select(*where, dealt("n", "shards").alias("shard"), every("blocks").alias("block"),
                                            F.lit(0).alias("role"), "n", "ids", "vec", F.lit(0.0).alias("bound"))
    asked = sent.join(sizes, where).select(*where, every("shards").alias("shard"), dealt("q", "blocks").alias("block"),
                                           F.lit(1).alias("role"), F.col("q").alias("n"), F.array("id").alias("ids"), "vec", "bound")
    rows = (there.unionByName(asked).repartition(shuffle_parts(items.sparkSession), *cell)
            .sortWithinPartitions(*cell, "role"))
    none = np.iinfo(np.int64).max

    def run(batches):
        now, parts, tree = None, [], None
        for batch in batches:
            places = np.column_stack([batch.column(c).to_numpy() for c in range(5)])
            cuts = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(places)]):
                if lo == hi:
                    continue
                *here, role = places[lo].tolist()
                if here != now:
                    now, parts, tree = here, [], None
                part = batch.slice(lo, hi - lo)
                vecs = next(_by_dim(part.column(7)))[1]
                if role == 0:
                    parts.append((part.column(5).to_numpy(), part.column(6).to_pylist(), vecs))
                elif parts:
                    if tree is None:
                        number, ids = (np.concatenate([x[0] for x in parts]), [i for x in parts for i in x[1]])
                        tree = Tree(np.concatenate([x[2] for x in parts]), np.array([i[0] for i in ids]),
                                    np.array([i[1] if len(i) > 1 else none for i in ids]))
                    own = np.array([i[0] for i in part.column(6).to_pylist()])
                    d, i = tree.search(vecs, own, k, factor, part.column(8).to_numpy())
                    row, col = np.nonzero(np.isfinite(d))
                    item = i[row, col]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(5).take(pa.array(row)), pa.array(own[row]), pa.array(number[item]),
                         pa.array([ids[x] for x in item], pa.list_(pa.int64())), pa.array(d[row, col])],
                        names=["q", "id", "n", "ids", "score"])

    out = rows.mapInArrow(run, "q long, id long, n long, ids array<long>, score double")
    return out


def _rows(found: DataFrame) -> DataFrame:
    """(q, id, n, vec_id, score): the rows of the items found, but the query's own."""
    return found.select("q", "id", "n", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("id"))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of each query."""
    spark = rows.sparkSession
    points, asked = (t.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
                     .where(F.col("id").isNotNull() & usable(F.col("vec"))) for t in (rows, queries))
    items = stage(_items(points, k), "items")
    asked = stage(asked.distinct().select(F.monotonically_increasing_id().alias("q"), "id", "vec"), "asked")

    # Pivots: a sample of the items by hash, of every dimension its share.
    many = min(PIVOTS, items.count() // SHARD_ROWS + 1)
    chosen = items.select(F.size("vec").alias("dim"), "vec").orderBy(F.xxhash64("vec")).limit(many).collect()
    regions = Regions([(r["dim"], r["vec"]) for r in chosen])
    placed = stage(_placed(items, spark.sparkContext.broadcast(regions)), "placed")   # PIVOTS vectors at most
    for r in placed.where("p >= 0").groupBy("p").agg(F.max("d").alias("d")).collect():   # a row for each pivot
        regions.radius[r["p"]] = r["d"]
    known = spark.sparkContext.broadcast(regions)

    home = stage(_placed(asked, known).withColumn("bound", F.lit(float("inf"))), "home")
    first = stage(_searched(placed, home, k, factor), "first")
    best = Window.partitionBy("q").orderBy("score", "vec_id")
    reach = _rows(first).withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).groupBy("q").agg(
        F.when(F.count("*") == k, F.max("score")).alias("bound"))
    bound = home.drop("bound", "d").join(reach, "q", "left").select("q", "id", "vec", "p", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))

    def send(batches):
        for batch in batches:
            for at, vecs in _by_dim(batch.column(2)):
                for lo in range(0, len(at), BATCH):
                    rows_, own = at[lo:lo + BATCH], batch.column(3).to_numpy()[at[lo:lo + BATCH]]
                    row, p = known.value.within(vecs[lo:lo + BATCH], batch.column(4).to_numpy()[rows_] * factor)
                    other = p != own[row]
                    part = batch.take(pa.array(rows_[row[other]]))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(p[other].astype(np.int32)), part.column(4)],
                                                     names=["q", "id", "vec", "p", "bound"])

    sent = stage(bound.mapInArrow(send, "q long, id long, vec array<double>, p int, bound double"), "sent")
    found = _rows(first.unionByName(_searched(placed, sent, k, factor)))
    # Several vectors of a query id: a row's distance is the smallest.
    found = found.groupBy("id", "n", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("id").orderBy("score", "vec_id")
    out = stage(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "nearest")
    for t in (items, asked, placed, home, first, sent):
        drop_stage(t)
    return out.select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
