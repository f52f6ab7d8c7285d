"""Exact top-k inner-product search: a ball tree per shard, branch and bound, with a shared kth score.

Vectors become whole numbers floor(scale * x). A coarse tree over a bounded sample deals rows to cells of space; a cell
with more rows than a shard may hold is split by a hash of the ids. Shards are packed once, with their ball. A query's
bound in a ball is q . centre + |q| * radius. Queries go to shards in waves, by falling bounds: to the best shard
first, then to the next NEXT ones, then to all others; after each wave the kth scores found so far close every shard
whose bound is below. Inside a shard a heap opens the tree's nodes best first; a leaf is scored against all queries of
a block that still need it as one product. Only queries travel to shards, and the shards to a grid of groups of
queries that is chosen by the session's parallelism, so that what is shuffled doesn't grow with rows times queries.

Sums of products are exact in doubles while the largest components prove that none reaches 2^53; else they are made of
Python integers without bounds. Nodes and shards close only if a bound with its rounding is below the kth score, so that
ties are all seen; ties go to the smaller id. Scores outside of a long's range count as its ends.

Defined results: vectors that are null, empty, or hold null or non-finite components (also after scaling) take no part,
nor do null ids; vectors of several lengths are refused; a query's own id is no candidate, also in repeated rows; fewer
than k candidates are all returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrymill.llm.common import written

#: Rows of a shard: the most, and the fewest that are worth a task of their own; the most shards (a ball each is sent to tasks).
SHARD_ROWS, LEAST_ROWS, MOST_SHARDS = 1 << 16, 1 << 12, 20_000
#: Bound of the sample that the coarse tree is made of, and of its cells.
SAMPLE, CELLS = 1 << 14, 1 << 10
QUERY_BLOCK, GROUP_QUERIES = 512, 1 << 16
LEAF = 128
SCALE = 64
#: Shards of the second wave.
NEXT = 8
_LONG = 1 << 63


def scaled_vectors(rows: DataFrame, scale: int = SCALE, id_col="vec_id", vec_col="embedding") -> DataFrame:
    """vec_id long, v array<double> (scaled, not yet floored) of the rows that take part."""
    v = F.transform(F.col(f"`{vec_col}`").cast("array<double>"), lambda x: x * scale)
    picked = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    return picked.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))


def _matrix(column) -> np.ndarray:
    """The floored rows of a column of arrays of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)) if len(column) else np.empty((0, 1))


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A direction from one far row to another, and each row's place along it."""
    centre = x.mean(axis=0)
    a = x[((x - centre) ** 2).sum(axis=1).argmax()]
    b = x[((x - a) ** 2).sum(axis=1).argmax()]
    return b - a, x @ (b - a)


def _floors(kth) -> np.ndarray:
    """kth scores as doubles that are not above them; null as minus infinity."""
    kth = kth.combine_chunks() if isinstance(kth, pa.ChunkedArray) else kth
    none = kth.is_null().to_numpy(zero_copy_only=False)
    whole = pa.compute.fill_null(kth, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = whole.astype(float)
    return np.where(none, -np.inf, np.where(np.abs(out) > 1 << 53, np.nextafter(out, -np.inf), out))


class CoarseTree:
    """Splits of space at the middle of a sample, down to about `leaves` cells."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.splits: list[tuple[np.ndarray, float, int, int]] = []  # direction, cut, left, right; a negative child is cell -child - 1
        self.cells = 0

        def build(x: np.ndarray, most: int) -> int:
            if most > 1 and len(x) > 1:
                with np.errstate(over="ignore", invalid="ignore"):
                    way, at = _halves(x)
                cut = float(np.median(at))
                if np.isfinite(cut) and (at < cut).any():
                    me = len(self.splits)
                    self.splits.append((way, cut, 0, 0))
                    left = build(x[at < cut], most // 2)
                    self.splits[me] = (way, cut, left, build(x[at >= cut], most - most // 2))
                    return me
            self.cells += 1
            return -self.cells

        self.root = build(sample, leaves)

    def cell(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int32)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
            elif len(rows):
                way, cut, left, right = self.splits[node]
                with np.errstate(over="ignore", invalid="ignore"):
                    low = x[rows] @ way < cut
                todo += [(left, rows[low]), (right, rows[~low])]
        return out


def _bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products, with room for rounding; what cannot be told is infinite."""
    with np.errstate(over="ignore", invalid="ignore"):
        norm = np.sqrt((q**2).sum(axis=1))[:, None]
        bound = q @ centres.T + norm * radii
        bound = bound + 1e-6 + 1e-9 * (np.abs(bound) + norm * (radii + np.sqrt((centres**2).sum(axis=1))))
    return np.where(np.isfinite(bound), bound, np.inf)


class BallTree:
    """Leaves of at most LEAF rows; for every node its rows, children, centre and radius."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []  # lo, hi, left, right
        centres, radii = [], []

        def build(lo: int, hi: int) -> int:
            own = x[order[lo:hi]]
            with np.errstate(over="ignore", invalid="ignore"):
                centre = own.mean(axis=0)
                radius = np.sqrt(((own - centre) ** 2).sum(axis=1).max())
            me = len(self.nodes)
            self.nodes.append((lo, hi, -1, -1))
            centres.append(centre)
            radii.append(radius)
            if hi - lo > LEAF and 0 < radius < np.inf:
                _, side = _halves(own)
                mid = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(side, mid)]
                self.nodes[me] = (lo, hi, build(lo, lo + mid), build(lo + mid, hi))
            return me

        build(0, len(ids))
        self.ids, self.x = ids[order], x[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.largest = float(np.abs(x).max(initial=0))

    def search(self, qids: np.ndarray, q: np.ndarray, k: int, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vec_id, score): of every query all that may be among its k best. kth: the kth scores so far."""
        if float(np.abs(q).max(initial=0)) * self.largest * q.shape[1] >= 1 << 53:
            return self._plain(qids, q, k)
        bound = _bounds(q, self.centres, self.radii)
        best = _Best(len(qids), k, kth)
        heap = [(-float(bound[:, 0].max()), 0, np.arange(len(qids)))]
        while heap:
            _, node, asked = heapq.heappop(heap)
            asked = asked[bound[asked, node] >= best.kth[asked]]
            if not len(asked):
                continue
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    own = asked[bound[asked, child] >= best.kth[asked]]
                    if len(own):
                        heapq.heappush(heap, (-float(bound[own, child].max()), child, own))
                continue
            scores = q[asked] @ self.x[lo:hi].T
            scores[self.ids[lo:hi] == qids[asked, None]] = -np.inf
            best.add(asked, scores, self.ids[lo:hi])
        of, ids, scores = best.found()
        return qids[of], ids, scores.astype(np.int64)

    def _plain(self, qids, q, k):
        """All scores, of Python integers."""
        rows = [[int(c) for c in x] for x in self.x.tolist()]
        out = []
        for qid, own in zip(qids.tolist(), q.tolist(), strict=True):
            own = [int(c) for c in own]
            scored = [(-max(-_LONG, min(_LONG - 1, sum(map(int.__mul__, own, x)))), i) for i, x in zip(self.ids.tolist(), rows, strict=True) if i != qid]
            out += [(qid, i, -s) for s, i in heapq.nsmallest(k, scored)]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        return tuple(np.array(c, np.int64) for c in cols)


class _Best:
    """The k best of each query so far; what leaves bring waits in a buffer that is cut when it holds a few times k a query."""

    def __init__(self, n: int, k: int, kth: np.ndarray):
        self.n, self.k, self.kth, self.waiting = n, k, kth.astype(float).copy(), 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, asked: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        row, col = np.nonzero((scores >= self.kth[asked, None]) & (scores > -np.inf))
        if len(row):
            self.parts.append((asked[row], ids[col], scores[row, col]))
            self.waiting += len(row)
            if self.waiting > 2 * self.k * min(self.n, 2 * len(asked)):
                self.cut()

    def cut(self) -> None:
        of, ids, scores = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((ids, -scores, of))
        of, ids, scores = of[order], ids[order], scores[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        rank = np.arange(len(of)) - np.repeat(first, np.diff(np.r_[first, len(of)]))
        last = rank == self.k - 1
        self.kth[of[last]] = np.maximum(self.kth[of[last]], scores[last])
        keep = rank < self.k
        self.parts, self.waiting = [(of[keep], ids[keep], scores[keep])], 0

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.cut()
        return self.parts[0]


def _compact(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in the smallest type that holds them all."""
    for kind in ("int8", "int16", "int32"):
        if not len(x) or np.abs(x).max() <= np.iinfo(kind).max:
            return kind, x.astype(kind).tobytes()
    return "float64", x.tobytes()


def _packed(vectors: DataFrame, shards: int, most: int) -> DataFrame:
    """shard, ids, kind, x, centre, radius: a row per shard. Cells of space that hold more than `most` rows are split by a hash."""
    cells = min(shards, CELLS)
    sample = _matrix(vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow().column("v"))
    coarse = CoarseTree(sample, cells)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(coarse.cell(_matrix(batch.column("v")))), batch.column("vec_id"), batch.column("v")], ["cell", "vec_id", "v"])

    rows = written(vectors.mapInArrow(dealt, "cell int, vec_id long, v array<double>"), "topk-cells")
    # A row a cell, at most CELLS of them.
    parts = {r["cell"]: -(-r["n"] // most) for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    split = F.element_at(F.create_map(*[F.lit(x) for c, n in parts.items() for x in (c, n)]), F.col("cell")) if parts else F.lit(1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), split).cast("int"))

    def pack(part: pa.Table) -> pa.Table:
        x = _matrix(part.column("v"))
        ids = part.column("vec_id").to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            centre = x.mean(axis=0)
            radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
        kind, data = _compact(x)
        return pa.table({"shard": pa.array([part.column("cell")[0].as_py() << 32 | part.column("part")[0].as_py()], pa.int64()), "ids": pa.array([ids.tobytes()], pa.binary()), "kind": [kind], "x": pa.array([data], pa.binary()), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius])})

    return written(rows.groupBy("cell", "part").applyInArrow(pack, "shard long, ids binary, kind string, x binary, centre array<double>, radius double"), "topk-shards")


def _routed(asked: DataFrame, balls: tuple[np.ndarray, np.ndarray, np.ndarray], first: int, last: int | None) -> DataFrame:
    """asked(query_id, v, kth) for every shard from place `first` to before `last` of its order by bounds that kth does not close."""
    shards, centres, radii = balls

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(lo, QUERY_BLOCK)
                bound = _bounds(_matrix(part.column("v")), centres, radii)
                order = np.argsort(-bound, axis=1, kind="stable")[:, first:last]
                kth = _floors(part.column("kth"))
                row, col = np.nonzero(np.take_along_axis(bound, order, axis=1) >= kth[:, None])
                of = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(shards[order[row, col]]), *(part.column(c).take(of) for c in ("query_id", "v", "kth"))], ["q_shard", "query_id", "v", "kth"])

    return asked.mapInArrow(run, "q_shard long, query_id long, v array<double>, kth long")


def _searched(packed: DataFrame, routed: DataFrame, k: int, groups: int) -> DataFrame:
    """(query_id, vec_id, score) of the routed queries' searches in their shards."""
    tree = packed.select("shard", "ids", "kind", "x").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = routed.withColumn("q_group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))

    def search(shard: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if shard.num_rows and queries.num_rows:
            ids = np.frombuffer(shard.column("ids")[0].as_py(), np.int64)
            x = np.frombuffer(shard.column("x")[0].as_py(), shard.column("kind")[0].as_py()).reshape(len(ids), -1).astype(float)
            own = BallTree(ids, x)
            for lo in range(0, queries.num_rows, QUERY_BLOCK):
                part = queries.slice(lo, QUERY_BLOCK)
                found.append(own.search(part.column("query_id").to_numpy(), _matrix(part.column("v")), k, _floors(part.column("kth"))))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in cols), strict=True)))

    return tree.groupBy("shard", "group").cogroup(asked.groupBy("q_shard", "q_group")).applyInArrow(search, "query_id long, vec_id long, score long")


def _grid(n: int, m: int, tasks: int) -> tuple[int, int]:
    """(shards, groups of queries) for n rows and m queries: enough tasks, at the least that is shuffled."""
    least = max(1, -(-n // SHARD_ROWS))
    shards = max(least, min(-(-n // LEAST_ROWS), round((tasks * n / max(1, m)) ** 0.5)))
    shards = min(shards, max(MOST_SHARDS, 1))
    groups = min(max(1, -(-tasks // shards)), max(1, -(-m // QUERY_BLOCK)))
    return max(1, shards), max(groups, -(-m // GROUP_QUERIES), 1)


def top_k(rows: DataFrame, queries, k: int = 20, scale: int = SCALE, id_col="vec_id", vec_col="embedding", tasks: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. queries: a condition on vec_id (SQL text) that picks the queries."""
    spark = rows.sparkSession
    vectors = written(scaled_vectors(rows, scale, id_col, vec_col).dropDuplicates(["vec_id", "v"]), "topk-vectors")
    facts = vectors.agg(F.count("*").alias("n"), F.count_if(F.expr(queries)).alias("m"), F.min(F.size("v")).alias("low"), F.max(F.size("v")).alias("high")).first()
    if facts["low"] != facts["high"]:
        raise ValueError("vectors of several lengths")
    shards, groups = _grid(facts["n"], facts["m"], tasks or 2 * spark.sparkContext.defaultParallelism)
    packed = _packed(vectors, shards, min(SHARD_ROWS, max(LEAST_ROWS, -(-facts["n"] // shards))))
    got = packed.select("shard", "centre", "radius").orderBy("shard").toArrow()
    balls = got.column("shard").to_numpy(), np.array(got.column("centre").to_pylist() or np.empty((0, 1))), got.column("radius").to_numpy()
    asked = vectors.where(queries).select(F.col("vec_id").alias("query_id"), "v")
    best, current, first = None, asked.withColumn("kth", F.lit(None).cast("long")), 0
    for last in (1, 1 + NEXT, None):
        if first and first >= len(balls[0]):
            break
        wave = _searched(packed, _routed(current, balls, first, last), k, groups)
        best = written(_best(wave if best is None else best.select("query_id", "vec_id", "score").unionByName(wave), k), "topk-best")
        kths = best.where(F.col("rank") == k).select(F.col("query_id").alias("k_id"), F.col("score").alias("kth"))
        current, first = asked.join(kths, F.col("query_id") == F.col("k_id"), "left").select("query_id", "v", "kth"), last
    return best


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
