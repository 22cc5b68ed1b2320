"""Exact top-k search by a Voronoi kNN join (operator 13).

Components become integers, floor(scale * x), and the score is the integer inner
product, so ranks do not depend on the order of summation.  The search for the
largest inner product is one for the nearest neighbour in one more dimension: a
row s gets the coordinate sqrt(M^2 - |s|^2), M being the greatest norm, a query
gets 0, and then |q - s|^2 = |q|^2 + M^2 - 2 q.s.

1. ``pivots`` rows, chosen by a hash of their vector, are the pivots; every row and
   every query belongs to the cell of its nearest pivot.
2. Summaries: a cell's rows, least and greatest distance to the pivot and its k + 1
   least distances; a query cell's count and greatest distance.  They reach the
   driver, pivots * (k + 4) numbers however many rows there are.
3. Bounds: the pivot distances bound from above how far the k-th neighbour of any
   query of a cell can be, and so from below how far from its own pivot a row must
   lie to be of use.  Query cells next to each other form groups of at most
   ``GROUP_BYTES``; a row is copied to the groups that it may serve, no others.
   A query goes to the chunks of those cells only that its own bounds (triangle
   inequality, rings and hyperplanes between pivots) leave.
4. Chunks: cells are cut, or put together, into chunks of about equal size and at
   most ``CHUNK_BYTES``, so a cell that holds a third of all rows is many chunks.  A
   task solves one group against one chunk; the k best of each chunk are merged.

On data without clusters in many dimensions the bounds exclude little; the work is
then that of all queries against all rows in blocks.

Rows are told apart by a number given when they are first written.

Edge cases: a vector that is null or holds a null, NaN or infinite component takes
no part; a shorter vector is continued by zeros; rows that repeat an id are rows
of their own, as queries and as candidates; a row without id is no query, and as a
candidate comes last among equal scores; an empty table gives an empty result;
scores that do not fit in 64 bits are an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import shipped, written

PIVOTS = 128
#: Integer vectors that a task holds: rows of a chunk, queries of a group.
CHUNK_BYTES = GROUP_BYTES = 32 << 20
#: Rows that a chunk has at least where there are fewer chunks than tasks.
LEAST_CHUNK = 512
#: Scores that are held at a time.
_SCORES = 1 << 21
_LAST = np.iinfo(np.int64).max


def integer_vectors(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str,
                    scale: int) -> DataFrame:
    """(row, id, query, y, norm2) of the vectors that take part, written."""
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    ok = F.col(vec_col).isNotNull() & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < math.inf))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.coalesce(is_query, F.lit(False)).alias("query"),
                          F.when(ok, F.transform(x, lambda v: F.floor(v * scale))).alias("y"))
    norm2 = F.aggregate("y", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    rows = rows.where(F.col("y").isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), "*", norm2.alias("norm2"))
    return written(rows, "search-vectors")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as float64 rows, short ones continued by zeros."""
    lengths = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths),
        np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


@dataclass
class Space:
    """The pivots and the greatest norm: all that distances need."""

    pivots: np.ndarray
    most2: float

    @property
    def width(self) -> int:
        return self.pivots.shape[1]

    @property
    def slack(self) -> float:
        """More than rounding can make of a distance."""
        return 1e-6 * (1.0 + math.sqrt(self.most2))

    def heights(self, y: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most2 - (y * y).sum(axis=1), 0.0))

    def of_queries(self, y: np.ndarray) -> np.ndarray:
        """Distances of queries to every pivot."""
        d2 = (y * y).sum(axis=1)[:, None] + self.most2 - 2.0 * (y @ self.pivots.T)
        return np.sqrt(np.maximum(d2, 0.0))

    def of_rows(self, y: np.ndarray) -> np.ndarray:
        """Distances of rows to every pivot."""
        height = np.outer(self.heights(y), self.heights(self.pivots))
        return np.sqrt(np.maximum(2.0 * (self.most2 - y @ self.pivots.T - height), 0.0))


def choose_pivots(points: DataFrame, pivots: int) -> Space:
    """``pivots`` different vectors, least by a hash of their components: a
    bounded sample that does not depend on the order of the rows."""
    most = points.agg(F.max("norm2"), F.max(F.size("y"))).first()
    if (most[0] or 0.0) >= 2.0 ** 62:
        raise ValueError("scores of these vectors do not fit in 64 bits")
    some = points.select("y").distinct().orderBy(F.xxhash64("y"), "y").limit(pivots).collect()
    held = pa.array([r["y"] for r in some], pa.list_(pa.int64()))
    return Space(matrix(held, max(most[1] or 0, 1)), most[0] or 0.0)


def _kernel(schema: str, names: list[str], make: Callable) -> Callable:
    def apply(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(make(batch), names=names)
        return df.mapInArrow(run, schema)
    return apply


def in_cells(points: DataFrame, space: Space, queries: bool) -> DataFrame:
    """Adds ``cell`` and ``dist`` to rows (row, id, y)."""
    def make(batch: pa.RecordBatch) -> list:
        y = matrix(batch.column(2), space.width)
        d = space.of_queries(y) if queries else space.of_rows(y)
        cell = d.argmin(axis=1)
        return [*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])]

    return _kernel("row long, id long, y array<long>, cell int, dist double",
                   ["row", "id", "y", "cell", "dist"], make)(points.select("row", "id", "y"))


@dataclass
class Summary:
    """By cell: rows, least and greatest distance to the pivot, and the least k + 1
    distances (infinite where there are fewer rows)."""

    n: np.ndarray
    low: np.ndarray
    high: np.ndarray
    nearest: np.ndarray


def summary(cells: DataFrame, space: Space, k: int) -> Summary:
    """Each task sums up its rows of each cell before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            cell = np.asarray(batch.column(0))
            dist = np.asarray(batch.column(1))
            for c in np.unique(cell).tolist():
                own = dist[cell == c]
                n, low, high, near = held.get(c, (0, math.inf, 0.0, np.empty(0)))
                near = np.sort(np.concatenate([near, own]))[:k + 1]
                held[c] = (n + len(own), min(low, own.min()), max(high, own.max()), near)
        cols = list(zip(*held.values(), strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array(cols[0], pa.int64()),
             pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.float64()),
             pa.array([x.tolist() for x in cols[3]], pa.list_(pa.float64()))],
            names=["cell", "n", "low", "high", "near"])

    parts = cells.select("cell", "dist").mapInArrow(
        run, "cell int, n long, low double, high double, near array<double>")
    rows = parts.groupBy("cell").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near")).collect()
    p = len(space.pivots)
    out = Summary(np.zeros(p, np.int64), np.zeros(p), np.zeros(p), np.full((p, k + 1), np.inf))
    for r in rows:
        c = r["cell"]
        out.n[c], out.low[c], out.high[c] = r["n"], r["low"], r["high"]
        out.nearest[c, :len(r["near"])] = r["near"]
    return out


def _order(between: np.ndarray) -> list[int]:
    """The pivots in a chain, each time the nearest that is left."""
    left, at, out = set(range(len(between))), 0, []
    while left:
        at = min(left, key=lambda j: (between[at, j], j)) if out else min(left)
        left.remove(at)
        out.append(at)
    return out


def _dealt(order: list[int], counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first, pieces, total): neighbouring cells share a place of at most
    ``most`` rows, a larger cell has several places of its own."""
    first = np.zeros(len(counts), np.int64)
    pieces = np.ones(len(counts), np.int64)
    place, filled = -1, most + 1
    for c in order:
        if counts[c] > most:
            pieces[c] = math.ceil(counts[c] / most)
            first[c] = place + 1
            place += int(pieces[c])
            filled = most + 1
            continue
        if filled + counts[c] > most:
            place, filled = place + 1, 0
        first[c] = place
        filled += counts[c]
    return first, pieces, place + 1


@dataclass
class Plan:
    """What the driver makes of the summaries: for rows, the chunk of each cell and
    the least pivot distance by which a group of query cells needs them; for
    queries, their group."""

    space: Space
    rows: Summary
    chunk_first: np.ndarray
    chunk_pieces: np.ndarray
    chunks: int
    group_first: np.ndarray
    group_pieces: np.ndarray
    needs: list[tuple[int, int, int, float]]


def make_plan(space: Space, rows: Summary, queries: Summary, k: int, chunk_rows: int,
              group_rows: int) -> Plan:
    between = space.of_rows(space.pivots)
    order = _order(between)
    chunk_first, chunk_pieces, chunks = _dealt(order, rows.n, chunk_rows)
    group_first, group_pieces, _ = _dealt(order, queries.n, group_rows)
    least: dict[tuple[int, int], float] = {}
    for i in np.flatnonzero(queries.n):
        reach = queries.high[i] + between[i][:, None] + rows.nearest
        bound = np.partition(reach.ravel(), k)[k]
        low = between[i] - queries.high[i] - bound - space.slack
        for j in np.flatnonzero(rows.n):
            if low[j] <= rows.high[j]:
                key = (int(j), int(group_first[i]))
                least[key] = min(least.get(key, math.inf), float(low[j]))
    pieces = {int(group_first[i]): int(group_pieces[i]) for i in np.flatnonzero(queries.n)}
    needs = [(j, g, pieces[g], low) for (j, g), low in least.items()]
    return Plan(space, rows, chunk_first, chunk_pieces, chunks, group_first, group_pieces, needs)


def _dealt_rows(cells: DataFrame, plan: Plan) -> DataFrame:
    """(grp, chunk, row, id, y): every row with the groups that may need it."""
    spark = cells.sparkSession
    p = len(plan.space.pivots)
    # At most pivots^2 rows are broadcast.
    needs = spark.createDataFrame(plan.needs, "cell int, first int, pieces int, low double")
    places = spark.createDataFrame(
        [(c, int(plan.chunk_first[c]), int(plan.chunk_pieces[c])) for c in range(p)],
        "cell int, chunk_first int, chunk_pieces int")
    out = cells.join(F.broadcast(places), "cell").join(F.broadcast(needs), "cell").where(
        F.col("dist") >= F.col("low"))
    chunk = F.col("chunk_first") + F.pmod(F.xxhash64("row"), F.col("chunk_pieces")).cast("int")
    groups = F.sequence(F.col("first"), F.col("first") + F.col("pieces") - 1)
    return out.select(F.explode(groups).alias("grp"), chunk.alias("chunk"), "row", "id", "y")


def _dealt_queries(cells: DataFrame, plan: Plan, k: int) -> DataFrame:
    """(grp, chunk, row, id, y, bound): every query with the chunks that its bounds
    leave; its k-th neighbour is no farther than ``bound``."""
    space, rows = plan.space, plan.rows
    between = space.of_rows(space.pivots)
    alive = rows.n > 0

    def make(batch: pa.RecordBatch) -> list:
        y = matrix(batch.column(2), space.width)
        own = np.asarray(batch.column(3))
        d = space.of_queries(y)
        bound = np.empty(len(y))
        chunks = []
        for n in range(len(y)):
            bound[n] = np.partition((d[n][:, None] + rows.nearest).ravel(), k)[k]
            apart = between[own[n]]
            plane = np.divide(d[n] ** 2 - d[n, own[n]] ** 2, 2.0 * apart,
                              out=np.zeros(len(apart)), where=apart > 0)
            least = np.maximum(np.maximum(d[n] - rows.high, rows.low - d[n]), plane)
            cells_left = np.flatnonzero(alive & (least <= bound[n] + space.slack))
            chunks.append(np.unique(np.concatenate(
                [np.arange(plan.chunk_pieces[c]) + plan.chunk_first[c] for c in cells_left]
                + [np.empty(0, np.int64)])))
        return [*batch.columns[:4], pa.array(bound),
                pa.array([c.astype(np.int32) for c in chunks], pa.list_(pa.int32()))]

    schema = "row long, id long, y array<long>, cell int, bound double, chunks array<int>"
    out = _kernel(schema, ["row", "id", "y", "cell", "bound", "chunks"], make)(
        cells.select("row", "id", "y", "cell"))
    places = cells.sparkSession.createDataFrame(
        [(c, int(plan.group_first[c]), int(plan.group_pieces[c]))
         for c in range(len(space.pivots))], "cell int, first int, pieces int")
    group = F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int")
    return out.join(F.broadcast(places), "cell").select(
        group.alias("grp"), F.explode("chunks").alias("chunk"), "row", "id", "y", "bound")


def best_in_chunk(q_row: np.ndarray, q: np.ndarray, least: np.ndarray, s_row: np.ndarray,
                  s_id: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, row, score) of every query's k best among the rows of one chunk with
    at least the score ``least``; equal scores go by id.  Arithmetic is that of
    the arrays given (float64 while scores stay exact in it, else int64)."""
    by_id = np.argsort(s_id, kind="stable")
    by_row = np.argsort(s_row)
    none = -np.inf if q.dtype.kind == "f" else np.iinfo(np.int64).min
    top_q, top_s, top_v = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, q.dtype)
    kth, full = least.copy(), np.zeros(len(q), bool)
    # Where a query's own row is in this chunk, by place in the order of ids.
    place = np.empty(len(s_row), np.int64)
    place[by_id] = np.arange(len(by_id))
    found = np.minimum(np.searchsorted(s_row, q_row, sorter=by_row), len(s_row) - 1)
    own = np.where(s_row[by_row[found]] == q_row, place[by_row[found]], -1)
    at, step = 0, 4 * k
    while at < len(by_id):
        step = max(1, min(2 * step, _SCORES // max(len(q), 1)))
        here = by_id[at:at + step]
        score = q @ s[here].T
        mine = np.flatnonzero((own >= at) & (own < at + len(here)))
        score[mine, own[mine] - at] = none
        # Later rows have greater ids: they must beat, not equal, a full list.
        better = np.where(full[:, None], score > kth[:, None], score >= kth[:, None])
        better &= score > none
        i, j = np.nonzero(better)
        if len(i):
            all_q = np.concatenate([top_q, i])
            all_s = np.concatenate([top_s, at + j])
            all_v = np.concatenate([top_v, score[i, j]])
            order = np.lexsort((all_s, -all_v, all_q))
            all_q, all_s, all_v = all_q[order], all_s[order], all_v[order]
            start = np.flatnonzero(np.r_[True, all_q[1:] != all_q[:-1]])
            size = np.diff(np.r_[start, len(all_q)])
            rank = np.arange(len(all_q)) - np.repeat(start, size)
            keep = rank < k
            top_q, top_s, top_v = all_q[keep], all_s[keep], all_v[keep]
            last = rank[keep] == k - 1
            kth[top_q[last]] = top_v[last]
            full[top_q[last]] = True
        at += len(here)
    return top_q, by_id[top_s], top_v


def _solve(space: Space, k: int) -> Callable:
    exact = space.most2 < 2.0 ** 52

    def solve(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if queries.num_rows and rows.num_rows:
            kind = np.float64 if exact else np.int64
            s = matrix(rows["y"].combine_chunks(), space.width).astype(kind)
            s_row = np.asarray(rows["row"])
            ids = rows["id"].combine_chunks()
            s_id = np.asarray(ids.fill_null(_LAST))
            # Null ids come after the greatest id there is.
            null = np.asarray(ids.is_null())
            rank_id = np.empty(len(s_id), np.int64)
            rank_id[np.lexsort((s_id, null))] = np.arange(len(s_id))
            size = max(1, _SCORES // 256)
            for at in range(0, queries.num_rows, size):
                part = queries.slice(at, size)
                q = matrix(part["y"].combine_chunks(), space.width)
                bound = np.asarray(part["bound"]) + space.slack
                least = ((q * q).sum(axis=1) + space.most2 - bound ** 2) / 2.0 - 1.0
                least = np.where(np.isfinite(least), least - 1e-6 * abs(least), -2.0 ** 62)
                if not exact:
                    least = np.maximum(np.floor(least), -2.0 ** 62).astype(np.int64)
                i, j, v = best_in_chunk(np.asarray(part["row"]), q.astype(kind), least, s_row,
                                        rank_id, s, k)
                out[0].append(part["row"].take(pa.array(i)).combine_chunks())
                out[1].append(part["id"].take(pa.array(i)).combine_chunks())
                out[2].append(ids.take(pa.array(j)))
                out[3].append(pa.array(v.astype(np.int64)))
        return pa.table([pa.chunked_array(c, pa.int64()) for c in out],
                        names=["query_row", "query_id", "vec_id", "score"])

    return solve


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = 1024, pivots: int = PIVOTS,
          chunk_rows: int | None = None, group_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest score of every row
    for which ``is_query`` holds, itself left out; all, if there are fewer."""
    spark = vectors.sparkSession
    shipped(spark)
    points = integer_vectors(vectors, is_query, id_col, vec_col, scale)
    n = points.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    space = choose_pivots(points, pivots)
    rows = written(in_cells(points, space, False), "search-rows")
    queries = written(in_cells(points.where("query"), space, True), "search-queries")
    row_bytes = 8 * space.width
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = max(LEAST_CHUNK, math.ceil(n / tasks))
    plan = make_plan(space, summary(rows, space, k), summary(queries, space, k), k,
                     chunk_rows or min(max(1, CHUNK_BYTES // row_bytes), even),
                     group_rows or max(1, GROUP_BYTES // row_bytes))
    found = _dealt_queries(queries, plan, k).groupBy("grp", "chunk").cogroup(
        _dealt_rows(rows, plan).groupBy("grp", "chunk")).applyInArrow(
        _solve(space, k), "query_row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
