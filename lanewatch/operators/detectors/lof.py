"""Exact local outlier factor (Euclidean, k neighbours) without comparing all pairs.

kNN: equal points are one point (with its few smallest keys), so copies cost nothing. Median
splits of a hashed sample, each along the widest feature, deal the points into cells of about
``cell_rows``; a cell is packed into one row with the box of its points. Cells that lie together
form a block; one task searches for all points of a block. It reads the block's own cells
first, then the other cells, nearest box first, and compares a point with a cell only while the
box is nearer than its k-th best distance. Cells that no point of a block can need (their
box is farther than the points of an own cell are apart) are not sent to it. The neighbours
are exact: a matrix product of points and cell finds the pairs that may count, with a margin for its
rounding, and these get their distance feature by feature. The split tree and the boxes
(at most ``max_cells`` cells, more only where the sample misses a dense spot) are held by the driver.

LOF itself (k-distance, reachability, lrd, ratio) is plain joins and
aggregations on the kNN table, so it has an SQL restatement.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewatch.functions.columns import sum_cols
from lanewatch.session import in_few_parts, keep

#: relative slack of bounds against rounding
SLACK = 1e-9
FAR = float("inf")
#: points compared with a cell at once
CHUNK = 512


def _matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _distinct(points: DataFrame, features: list[str], key: str, k: int) -> DataFrame:
    """One row per distinct point: its k + 1 smallest keys in order, and how many other points it needs."""
    vec = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in features])       # + 0.0: no negative zero
    base = points.select(F.col(key).cast("string").alias("_id"), vec.alias("vec"))
    least = Window.partitionBy("vec").orderBy("_id")
    few = base.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= k + 1)
    out = few.groupBy("vec").agg(F.sort_array(F.collect_list("_id")).alias("ids"))
    return out.select(F.element_at("ids", 1).alias("rep"), "vec", "ids", F.greatest(F.lit(0), F.lit(k + 1) - F.size("ids")).alias("need"))


class Tree:
    """Splits of a sample at medians, along the widest feature, down to ``leaf`` points; a point's cell is its leaf, numbered from left to right."""

    def __init__(self, sample: np.ndarray, leaf: float):
        self.feature, self.cut, self.below, self.cells = [], [], [], 0
        self._grow(np.nan_to_num(sample), leaf)
        self.feature, self.cut, self.below = np.array(self.feature), np.array(self.cut), np.array(self.below)

    def _grow(self, x: np.ndarray, leaf: float) -> int:
        at = len(self.feature)
        self.feature.append(-1), self.cut.append(0.0), self.below.append((0, 0))
        j = int(np.argmax(x.var(axis=0))) if len(x) > max(leaf, 1) else -1
        if j < 0 or x[:, j].min() == x[:, j].max():
            self.cut[at] = float(self.cells)        # a leaf: its number
            self.cells += 1
            return at
        values = np.sort(x[:, j])
        cut = max(values[len(values) // 2], values[np.searchsorted(values, values[0], "right")])       # both sides have points
        self.feature[at], self.cut[at] = j, float(cut)
        left = x[:, j] < cut
        self.below[at] = (self._grow(x[left], leaf), self._grow(x[~left], leaf))
        return at

    def cell(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(rows := rows[self.feature[node[rows]] >= 0]):
            at = node[rows]
            node[rows] = self.below[at, np.where(x[rows, self.feature[at]] < self.cut[at], 0, 1)]
        return self.cut[node].astype(np.int32)


PACKED = "cell int, part int, asks long, n long, lo array<double>, hi array<double>, body binary"


def _packed(table: pa.Table, most: int) -> pa.Table:
    """The points of a cell as rows of at most ``most``: number, size, box and an Arrow stream of (vec, ids, need)."""
    table = table.sort_by("rep").combine_chunks()
    rows = []
    for i in range(0, table.num_rows, most):
        part = table.slice(i, most).select(["vec", "ids", "need"])
        x, sink = _matrix(part.column("vec")), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_table(part)
        asks = int((_column(part, "need") > 0).sum())
        rows.append({"cell": table.column("cell")[0].as_py(), "part": i // most, "asks": asks, "n": len(x), "lo": x.min(axis=0).tolist(),
                     "hi": x.max(axis=0).tolist(), "body": sink.getvalue().to_pybytes()})
    return pa.Table.from_pylist(rows, schema=pa.schema([("cell", pa.int32()), ("part", pa.int32()), ("asks", pa.int64()), ("n", pa.int64()), (
        "lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("body", pa.binary())]))


def _gaps(lo: np.ndarray, hi: np.ndarray, x_lo: np.ndarray, x_hi: np.ndarray) -> np.ndarray:
    """Least distances between boxes, or between points and a box."""
    return np.sqrt((np.maximum(0.0, np.maximum(lo - x_hi, x_lo - hi)) ** 2).sum(axis=-1))


def _needed(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, block: np.ndarray, k: int) -> dict[int, list[tuple[int, int]]]:
    """Block -> (cell, place) of the cells it has to read: its own at place 0, then those in reach of a point of it, nearest first."""
    out = {}
    for b in np.unique(block[block >= 0]):
        own = np.flatnonzero(block == b)
        # a point of a cell with over k points has k others within the cell's diagonal
        reach = np.where(n[own] > k, np.sqrt(((hi[own] - lo[own]) ** 2).sum(axis=1)), FAR)
        if n[own].sum() > k:
            reach = np.fmin(reach, np.sqrt(((hi[own].max(axis=0) - lo[own].min(axis=0)) ** 2).sum()))
        near, wanted = np.full(len(n), FAR), np.zeros(len(n), dtype=bool)
        for i, c in enumerate(own):
            gap = _gaps(lo, hi, lo[c], hi[c])
            near = np.fmin(near, gap)
            wanted |= ~(gap * (1 - SLACK) > reach[i] * (1 + SLACK))
        wanted[own] = False
        others = np.flatnonzero(wanted)
        out[int(b)] = [(int(c), 0) for c in own] + [(int(c), i + 1) for i, c in enumerate(others[np.argsort(near[others], kind="stable")])]
    return out


NEAR = "vec array<double>, near array<struct<dist double, nbr string>>, pairs long"


def _order(q: np.ndarray, d: np.ndarray, names) -> np.ndarray:
    """The order by (q, d, name); ``names`` (of the rows given) is only asked for ties."""
    order = np.lexsort((d, q))
    tied = np.flatnonzero((np.diff(q[order]) == 0) & (np.diff(d[order]) == 0))
    if not len(tied):
        return order
    tied = order[np.union1d(tied, tied + 1)]
    rank = np.zeros(len(q), dtype=np.int64)
    rank[tied] = pc.rank(names(pa.array(tied)), sort_keys="ascending", tiebreaker="dense").to_numpy()
    return np.lexsort((rank, d, q))


def _places(q: np.ndarray) -> np.ndarray:
    """The place of every row among those of its number, in a sorted column."""
    return np.arange(len(q)) - np.searchsorted(q, q, "left")


class _Points:
    """A packed cell."""

    def __init__(self, body: bytes):
        (rows,) = pa.ipc.open_stream(body).read_all().combine_chunks().to_batches()
        self.vec, self.ids, self.need = (rows.column(c) for c in ("vec", "ids", "need"))
        self.need, self.x = self.need.to_numpy(), _matrix(self.vec)
        self.lo, self.hi = self.x.min(axis=0), self.x.max(axis=0)
        square = (self.x ** 2).sum(axis=1)
        self.far = np.sqrt(square.max())
        self.right = np.column_stack([self.x, square]).T


class _Search:
    """The nearest points of a block: ``take`` its own cells, then ``read`` the others."""

    def __init__(self):
        self.own: list[_Points] = []
        self.x = None

    def take(self, cell: _Points) -> None:
        self.own.append(cell)

    def start(self) -> None:
        asks = [np.flatnonzero(c.need > 0) for c in self.own]
        ends = np.concatenate([[0], np.cumsum([len(a) for a in asks])])
        self.groups = [slice(ends[i], ends[i + 1]) for i in range(len(asks))]
        self.place = np.concatenate(asks)                                   # in the own cell
        self.x = np.concatenate([c.x[a] for c, a in zip(self.own, asks)])
        self.need = np.concatenate([c.need[a] for c, a in zip(self.own, asks)])
        self.vec, self.ids = (pa.concat_arrays([getattr(c, f).take(pa.array(a)) for c, a in zip(self.own, asks)]) for f in ("vec", "ids"))
        self.left = np.column_stack([-2.0 * self.x, np.ones(len(self.x))])
        self.square = (self.x ** 2).sum(axis=1)
        self.tau, self.pairs = np.full(len(self.x), FAR), np.zeros(len(self.x), dtype=np.int64)
        self.kept = (np.zeros(0, dtype=np.int64), np.zeros(0), self.ids[:0])
        self.new, self.waiting = [], 0
        for i, c in enumerate(self.own):
            self._compare(i, c, same=True)
        self._cut()
        for i, c in enumerate(self.own):
            self.read(c, but=i)

    def read(self, cell: _Points, but: int = -1) -> None:
        for i, g in enumerate(self.groups):
            if i != but and g.stop > g.start:
                self._compare(i, cell)
        if self.waiting > max(len(self.kept[0]) // 2, 50_000):
            self._cut()

    def _compare(self, group: int, cell: _Points, same: bool = False) -> None:
        g = self.groups[group]
        if g.stop == g.start:
            return
        own, tau = self.own[group], self.tau[g]
        if not same:
            if _gaps(cell.lo, cell.hi, own.lo, own.hi) * (1 - SLACK) > tau.max():
                return
            at = np.flatnonzero(~(_gaps(cell.lo, cell.hi, self.x[g], self.x[g]) * (1 - SLACK) > tau))
        else:
            at = np.arange(g.stop - g.start)
        for s in range(0, len(at), CHUNK):
            rows = at[s:s + CHUNK] + g.start
            self.pairs[rows] += len(cell.x)
            tau, square = self.tau[rows], self.square[rows]
            near = self.left[rows] @ cell.right             # squared distance less the point's own square
            margin = 1e-12 * (np.sqrt(square) + cell.far) ** 2
            if same:
                near[np.arange(len(rows)), self.place[rows]] = FAR
            limit = tau * tau * (1 + SLACK) - square + margin
            need = int(self.need[rows].max())
            if need < len(cell.x) and (tau == FAR).any():   # the need-th nearest of this cell alone
                kth = np.partition(near, need - 1, axis=1)[:, need - 1]
                limit = np.fmin(limit, kth + SLACK * np.abs(kth + square) + 2 * margin)
            r, c = np.divmod(np.flatnonzero(~(near > limit[:, None])), len(cell.x))
            d = np.zeros(len(r))
            for j in range(cell.x.shape[1]):                # the rounding of the SQL restatement
                one = self.x[rows[r], j] - cell.x[c, j]
                d = d + one * one
            d = np.sqrt(d)
            ok = (d <= tau[r]) & (d < FAR)
            if same:
                ok &= c != self.place[rows[r]]
            if ok.any():
                self.new.append((rows[r[ok]], d[ok], cell.ids.take(pa.array(c[ok]))))
                self.waiting += int(ok.sum())

    def _cut(self) -> None:
        """Keep what every point needs, ties by name, and take its last distance as the limit."""
        if not self.new:
            return
        q, d, ids = zip(self.kept, *self.new)
        q, d, ids = np.concatenate(q), np.concatenate(d), pa.concat_arrays(ids)
        self.new, self.waiting = [], 0
        order = _order(q, d, lambda at: pc.list_element(ids.take(at), 0))
        q, place = q[order], _places(q[order])
        last = place == self.need[q] - 1
        self.tau[q[last]] = d[order[last]]
        stay = place < self.need[q]
        self.kept = (q[stay], d[order[stay]], ids.take(pa.array(order[stay])))

    def found(self, rows: int = 8192):
        """Every point's own copies and its neighbours' in order, as many as it needs."""
        if self.x is None:
            self.start()
        self._cut()
        for s in range(0, len(self.x), rows):
            own = self.ids[s:s + rows]
            lo, hi = np.searchsorted(self.kept[0], [s, s + len(own)])
            ids, copies, many = self.kept[2][lo:hi], *(i.value_lengths().to_numpy() for i in (self.kept[2][lo:hi], own))
            q = np.concatenate([np.repeat(np.arange(len(own)), many), np.repeat(self.kept[0][lo:hi] - s, copies)])
            d = np.concatenate([np.zeros(many.sum()), np.repeat(self.kept[1][lo:hi], copies)])
            name = pa.concat_arrays([own.flatten(), ids.flatten()])
            order = _order(q, d, name.take)
            order = order[_places(q[order]) < (self.need[s:s + rows] + many)[q[order]]]
            ends = np.concatenate([[0], np.cumsum(np.bincount(q[order], minlength=len(own)))]).astype(np.int32)
            near = pa.StructArray.from_arrays([pa.array(d[order]), name.take(pa.array(order))], ["dist", "nbr"])
            yield pa.RecordBatch.from_arrays([self.vec[s:s + rows], pa.ListArray.from_arrays(pa.array(ends), near),
                                              pa.array(self.pairs[s:s + rows])], ["vec", "near", "pairs"])


def _search(batches):
    """Rows of (block, place, body) in this order -> NEAR."""
    block, state = None, None
    for b in batches:
        for to, place, body in zip(*(b.column(i).to_pylist() for i in range(3))):
            if to != block:
                if state is not None:
                    yield from state.found()
                block, state = to, _Search()
            if place == 0:
                state.take(_Points(body))
                continue
            if state.x is None:
                state.start()
            state.read(_Points(body))
    if state is not None:
        yield from state.found()


def _keys_of_partitions(spark, n: int) -> list[int]:
    """A key for each of n hash partitions."""
    rows = spark.range(64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p")).groupBy("p").agg(F.min("id").alias("id")).collect()
    found = {r["p"]: r["id"] for r in rows}
    return [found.get(p, 64 * n + p) for p in range(n)]


def nearest_points(reps: DataFrame, n: int, cell_rows: int = 1024, max_cells: int = 8192, block_rows: int = 65_536,
                   batch_bytes: int = 16 << 20) -> DataFrame:
    """(vec, near, pairs) of every distinct point with a need: the keys of its copies and of the ``need`` nearest others (ties by their
    smallest key) by distance, and how many distances were computed; (rep, vec, ids, need) in."""
    spark = reps.sparkSession
    wanted = min(max_cells, max(1, -(-n // cell_rows)))
    of_cell = min(32, max(8, 65_536 // wanted))
    chosen = reps.orderBy(F.xxhash64("rep"), "rep").limit(wanted * of_cell).select("vec").collect()       # at most 65,536, or 8 a cell
    if not chosen:
        return spark.createDataFrame([], NEAR)
    sample = np.array([r["vec"] for r in chosen], dtype=float).reshape(len(chosen), -1)
    tree = spark.sparkContext.broadcast(Tree(sample, len(sample) / wanted))

    def assign(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree.value.cell(_matrix(b.column("vec"))), pa.int32())],
                                                 ["rep", "vec", "ids", "need", "cell"])

    members = reps.select("rep", "vec", "ids", "need").mapInArrow(assign, "rep string, vec array<double>, ids array<string>, need int, cell int")
    most = 2 * max(cell_rows, -(-n // wanted))
    packed = keep(in_few_parts(members.groupBy("cell").applyInArrow(lambda t: _packed(t, most), PACKED), n))
    info = sorted(packed.drop("body").collect(), key=lambda r: (r["cell"], r["part"]))      # a row a cell
    lo, hi = (np.array([r[c] for r in info], dtype=float) for c in ("lo", "hi"))
    asks, size = (np.array([r[c] for r in info]) for c in ("asks", "n"))
    total = int(asks.sum())
    tasks = max(-(-total // block_rows), min(3 * spark.sparkContext.defaultParallelism, len(info)))
    block = np.where(asks > 0, (np.cumsum(asks) - asks) * tasks // max(total, 1), -1)
    k = reps.agg(F.max("need")).first()[0]
    keys = _keys_of_partitions(spark, tasks)
    table = spark.createDataFrame([(info[c]["cell"], info[c]["part"], keys[b], i) for b, cells in _needed(lo, hi, size, block, k).items()
                                   for c, i in cells], "cell int, part int, block long, place int")
    asked = packed.select("cell", "part", "body").join(F.broadcast(table), ["cell", "part"]).repartition(tasks, "block") \
        .sortWithinPartitions("block", "place", "cell", "part").select("block", "place", "body")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch_bytes))      # a row is a cell
    try:
        return keep(asked.mapInArrow(_search, NEAR))
    finally:
        spark.conf.set(name, before)


def knn(points: DataFrame, features: list[str], key: str = "ROTTA", k: int = 20, cell_rows: int = 1024,
        max_cells: int = 8192) -> DataFrame:
    """(key, nbr, dist, rank) for the k nearest other points, ties by neighbour key."""
    n = points.count()
    k = int(min(k, max(n - 1, 1)))
    reps = keep(in_few_parts(_distinct(in_few_parts(points, n), features, key, k), n))
    near = nearest_points(reps, reps.count(), cell_rows, max_cells)
    copies = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("dist"), i.alias("nbr"))).alias("near")
    # at most k + 1 keys a point; dealt anew, since a search has few tasks
    lists = near.select("vec", "near").unionByName(reps.filter("need = 0").select("vec", copies)).repartition("vec")
    vec = F.array(*[F.col(c).cast("double") + F.lit(0.0) for c in features])
    named = points.select(F.col(key).cast("string").alias("_id"), vec.alias("vec")).join(lists, "vec")
    own_list = F.slice(F.filter("near", lambda s: s["nbr"] != F.col("_id")), 1, k)
    return (named.select(F.col("_id").alias(key), F.posexplode(own_list).alias("_p", "_s"))
            .select(key, F.col("_s.nbr").alias("nbr"), F.col("_s.dist").alias("dist"), (F.col("_p") + 1).alias("rank")))


def lof_from_knn(nn: DataFrame, key: str = "ROTTA", k: int | None = None) -> DataFrame:
    """(key, lof) from the kNN table: reach-dist = max(k-dist(o), d(p, o));
    lrd = 1 / (mean reach-dist + 1e-10); LOF = mean lrd(o) / lrd(p)."""
    kd = nn.groupBy(key).agg(F.max("dist").alias("kdist"))
    kd_o = kd.select(F.col(key).alias("nbr"), F.col("kdist").alias("kdist_o"))
    reach = nn.join(kd_o, on="nbr").withColumn("reach", F.greatest("dist", "kdist_o"))
    lrd = reach.groupBy(key).agg((F.lit(1.0) / (F.avg("reach") + F.lit(1e-10))).alias("lrd"))
    lrd_o = lrd.select(F.col(key).alias("nbr"), F.col("lrd").alias("lrd_o"))
    ratio = nn.join(lrd_o, on="nbr").groupBy(key).agg(F.avg("lrd_o").alias("_m"))
    return ratio.join(lrd, on=key).select(key, (F.col("_m") / F.col("lrd")).alias("lof"))


def local_outlier_factor(points: DataFrame, features: list[str], key: str = "ROTTA", k: int = 20,
                         cell_rows: int = 1024) -> DataFrame:
    nn = knn(points, features, key=key, k=k, cell_rows=cell_rows)
    nn = keep(in_few_parts(nn, points.count()))     # read by three joins
    return lof_from_knn(nn, key=key)


def local_outlier_factor_by(points: DataFrame, features: list[str], group_col: str, key: str = "ROTTA", k: int = 20,
                            cell_rows: int = 1024) -> DataFrame:
    """(group, key, lof): the factor of every point inside its group, all groups in one set of jobs.

    Groups lie apart along one more coordinate, farther than any two points of a group, so that a point's
    nearest are of its own group as long as this has enough; neighbours of other groups do not count.
    """
    far = points.agg(F.sqrt(sum_cols([F.max(c) - F.min(c) for c in features]) ** 2).alias("d")).first()["d"] or 0.0
    ids = F.concat_ws("|", F.col(group_col).cast("string"), F.col(key).cast("string"))
    apart = points.select(group_col, key, ids.alias("_key"), *features, (F.col(group_col) * F.lit(4.0 * far + 1.0)).alias("_apart"))
    nn = knn(apart, [*features, "_apart"], key="_key", k=k, cell_rows=cell_rows)
    same = F.substring_index("_key", "|", 1) == F.substring_index("nbr", "|", 1)
    lof = lof_from_knn(keep(nn.filter(same)), key="_key")
    return apart.select(group_col, key, "_key").join(lof, "_key", "left").drop("_key")
