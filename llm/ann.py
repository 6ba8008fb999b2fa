"""Approximate nearest neighbours by cross-polytope hashing, exact reranking.

A table rotates the directions of vectors by three rounds of random signs and fast Hadamard transforms.  Each half of
the rotated coordinates is a cross-polytope of its own, and the nearest signed axes of both are the bucket, one of up to
16,384.  A query probes, in every table, the buckets of its nearest axes in the first half with its nearest in the
second.  How many axes is one number for every table, so that a pair that is found stays found as rows are added.

Points and queries are dealt in blocks, and a task holds one block of each with the buckets of all tables, so that a
vector travels once per block and not once per table and bucket.  Within a task the points of a first axis meet the
queries that probe it.  Directions are held in half precision; a candidate's score is known there within a proven error,
and a query keeps all whose upper bound reaches the lower bound of its last place so far, which all tables of the task
share.  What is left of all blocks is scored on the original vectors in double precision.

Long vectors can win far from the query's direction, so where norms differ, the longest of the table are candidates of
every query.  Equal vectors are one candidate that carries its smallest ids, as many as a result can hold, so a vector
that many rows share costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.hashing import seeds
from llm.tables import stored, table

#: Tables, results, and most axes of a half.
TABLES, NEAREST, AXES = 16, 20, 128
#: Points of a block: about ``BLOCKS`` blocks, within these bounds; and most queries of a block.
BLOCKS, BLOCK_POINTS, BLOCK_QUERIES = 24, (4_096, 65_536), 16_384
#: Scores a task holds at once.
SCORES = 1 << 22
#: Share of the points, the longest, that every query meets if norms differ by more than rounding.
LONGEST, ROUNDING = 1 / 16, 1e-5
#: Relative error of an inner product of two directions in half precision.
HALF = 2.0**-10 + 2.0**-14


def probed_axes(points: int, axes: int = AXES) -> int:
    """Axes of each half with which a table of so many uniform vectors has a recall at 20 of about 0.9."""
    return max(3, min(axes, round(55 / max(points, 1) ** 0.15)))


#: Axes of each half that every query probes, whatever the table's size: those that 100 vectors need, whose nearest lie
#: furthest.  In larger tables nearest neighbours are closer, and recall is higher.
PROBES = probed_axes(100)


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(unit: np.ndarray, tables: int) -> Iterator[np.ndarray]:
    """The pseudo-rotation of every table, over the next power of two of dimensions."""
    n, d = unit.shape
    size = 1 << max(d - 1, 1).bit_length()
    padded = np.zeros((n, size))
    padded[:, :d] = unit
    for t in range(tables):
        x = padded
        for k in range(3):
            signs = np.where(seeds(size, 1_000 * t + k) >> np.uint64(63), 1.0, -1.0)
            x = _hadamard(x * signs)
        yield x


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """A matrix; shorter vectors end in zeros."""
    out = np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


_PLACED = "id long, firsts binary, seconds binary, direction binary, norm double"


def _hashed(width: int, tables: int, probes: int):
    """Rows (id, vector) -> the axes of both halves, table by table, as bytes, the direction and the norm.

    With 0 ``probes`` the nearest axes, which are the bucket of a point, else those a query probes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1), width)
            most = np.abs(x).max(1)
            scaled = x / most[:, None]
            length = np.sqrt((scaled * scaled).sum(1))
            unit = scaled / length[:, None]
            # One more coordinate, so that even powers of two of dimensions have twice the axes.
            firsts, seconds = [np.zeros((len(x), 0), np.uint8)], [np.zeros((len(x), 0), np.uint8)]
            for y in rotations(np.column_stack([unit, np.zeros(len(x))]), tables):
                half = min(AXES // 2, y.shape[1] // 2)
                for found, h in ((firsts, y[:, :half]), (seconds, y[:, half : 2 * half])):
                    signed = np.concatenate([h, -h], 1)
                    axes = np.argsort(-signed, 1, kind="stable")[:, :probes] if probes else signed.argmax(1)[:, None]
                    found.append(axes.astype(np.uint8))
            binary = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    binary(np.concatenate(firsts, 1)),
                    binary(np.concatenate(seconds, 1)),
                    binary(unit.astype(np.float16)),
                    pa.array(most * length),
                ],
                ["id", "firsts", "seconds", "direction", "norm"],
            )

    return run


class _Best:
    """The candidates of each query that can still be among its nearest, over all cells of a task."""

    def __init__(self, nearest: int, most: int = 1 << 20):
        self.nearest, self.most, self.parts, self.size = nearest, most, [], 0
        #: Queries and the lower bound of the last place of each, when the candidates were last looked through.
        self.least = np.zeros(0, np.int64), np.zeros(0)

    def add(self, *columns: np.ndarray) -> bool:
        """Whether the candidates were looked through."""
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size <= self.most:
            return False
        kept = self.kept()
        self.parts, self.size = [kept], len(kept[0])
        return True

    def kept(self) -> tuple[np.ndarray, ...]:
        """Query, point, lower and upper bound of the score."""
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        query, point, low, high = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((-low, point, query))
        query, point, low, high = query[order], point[order], low[order], high[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (point[1:] != point[:-1])
        query, point, low, high = query[new], point[new], low[new], high[new]
        order = np.lexsort((-low, query))
        query, point, low, high = query[order], point[order], low[order], high[order]
        named, begin, group = np.unique(query, return_index=True, return_inverse=True)
        # One more than wanted, as a query's own vector is no candidate.
        last = begin + self.nearest
        ends = np.append(begin[1:], len(query))
        least = np.where(last < ends, low[np.minimum(last, len(low) - 1)], -np.inf)
        self.least = named, least
        fit = high >= least[group]
        return query[fit], point[fit], low[fit], high[fit]


class _Block:
    """The points of one block and the queries of another, all their tables."""

    def __init__(self, points: pa.Table, queries: pa.Table, tables: int, nearest: int):
        matrix = lambda t, name: np.frombuffer(b"".join(t[name].to_pylist()), np.uint8).reshape(len(t), -1)
        self.p_ids, self.q_ids = points["id"].to_numpy(), queries["id"].to_numpy()
        self.points, self.asked = (matrix(t, "direction").view(np.float16).astype(np.float32) for t in (points, queries))
        self.norms, self.far = points["norm"].to_numpy(), points["far"].to_numpy(zero_copy_only=False)
        self.p_first, self.p_second = (matrix(points, c) for c in ("firsts", "seconds"))
        self.q_first, self.q_second = (matrix(queries, c).reshape(len(queries), max(tables, 1), -1) for c in ("firsts", "seconds"))
        self.tables = tables
        self.best = _Best(nearest, max(1 << 18, 64 * len(queries)))
        self.least = np.full(len(queries), -np.inf)

    def compare(self, who: np.ndarray, here: np.ndarray, probed: np.ndarray | None = None, second: np.ndarray | None = None) -> None:
        """Queries ``who`` meet points ``here``; where ``probed`` is given, those whose second axis they probe."""
        step = max(1, SCORES // len(here))
        if len(who) > step:
            for k in range(0, len(who), step):
                self.compare(who[k : k + step], here, probed, second)
            return
        norms, least = self.norms[here], self.least[who]
        score = self.asked[who] @ self.points[here].T
        # No score below this can reach the last place, whatever the norm of its point.
        with np.errstate(over="ignore", invalid="ignore"):
            floor = np.where(least >= 0, least / norms.max(), least / norms.min()) - HALF - 1e-6
        floor[np.isnan(floor)] = -np.inf
        at = np.flatnonzero(score >= floor.astype(np.float32)[:, None])
        row, column = np.divmod(at, len(here))
        if probed is not None:
            fit = probed[who[row], second[here[column]]]
            row, column = row[fit], column[fit]
        # A query's own norm orders nothing: bounds are of the inner product with its direction.
        norm = norms[column]
        value, slack = score[row, column].astype(np.float64) * norm, HALF * norm
        fit = value + slack >= least[row]
        row, column, value, slack = row[fit], column[fit], value[fit], slack[fit]
        if len(row) and self.best.add(who[row], here[column], value - slack, value + slack):
            found, lows = self.best.least
            self.least[found] = np.maximum(self.least[found], lows)

    def met(self) -> pa.RecordBatch:
        far = np.flatnonzero(self.far)
        if len(far):
            every = np.arange(len(self.q_ids))
            for k in range(0, len(far), 4_096):
                self.compare(every, far[k : k + 4_096])
        for t in range(self.tables):
            first, asked = self.p_first[:, t], self.q_first[:, t]
            probed = np.zeros((len(self.q_ids), AXES), bool)
            probed[np.arange(len(probed))[:, None], self.q_second[:, t]] = True
            by_axis, by_probe = np.argsort(first, kind="stable"), np.argsort(asked.ravel(), kind="stable")
            cuts = np.arange(AXES + 1)
            p_cut, q_cut = np.searchsorted(first[by_axis], cuts), np.searchsorted(asked.ravel()[by_probe], cuts)
            for axis in range(AXES):
                here, who = by_axis[p_cut[axis] : p_cut[axis + 1]], by_probe[q_cut[axis] : q_cut[axis + 1]] // asked.shape[1]
                for k in range(0, len(here) if len(who) else 0, 4_096):
                    self.compare(who, here[k : k + 4_096], probed, self.p_second[:, t])
        query, point, low, high = self.best.kept()
        columns = self.q_ids[query], self.p_ids[point], low, high
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "id", "low", "high"])


def _meet(tables: int, nearest: int):
    """Rows sorted by pair of blocks, points before queries -> what each query can use of the points of the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = None, []

        def met() -> Iterator[pa.RecordBatch]:
            if held:
                rows = pa.Table.from_batches(held)
                sides = rows["side"].to_numpy()
                points, queries = rows.filter(pa.array(sides == 0)), rows.filter(pa.array(sides == 1))
                if len(points) and len(queries):
                    yield _Block(points, queries, tables, nearest).met()

        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("p_part", "q_part")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(keys)] if len(keys) else []):
                if (key := tuple(keys[begin])) != pair:
                    yield from met()
                    pair, held = key, []
                held.append(batch.slice(begin, end - begin))
        yield from met()

    return run


def _dealt(probed: DataFrame, placed: DataFrame, queries: DataFrame, points: DataFrame, total: int, tables: int, nearest: int) -> DataFrame:
    """query_id, rank, vec_id, score of what meets in a bucket, or is ``far``; ``total`` is the number of points."""
    p_parts = max(1, -(-total // max(BLOCK_POINTS[0], min(BLOCK_POINTS[1], total // BLOCKS))))
    q_parts = max(1, -(-queries.count() // BLOCK_QUERIES))

    def dealt(rows: DataFrame, side: int, own: str, mine: int, other: str, others: int) -> DataFrame:
        place = F.pmod(F.xxhash64("id"), F.lit(mine)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        placed = rows.select("*", place).select("*", every)
        return placed.select("p_part", "q_part", F.lit(side).alias("side"), "id", "firsts", "seconds", "direction", "norm", "far")

    both = dealt(placed, 0, "p_part", p_parts, "q_part", q_parts).unionByName(
        dealt(probed.withColumn("far", F.lit(False)), 1, "q_part", q_parts, "p_part", p_parts)
    )
    # More partitions than pairs of blocks, so that few pairs share one.
    pairs = both.repartition(3 * p_parts * q_parts, "p_part", "q_part").sortWithinPartitions("p_part", "q_part", "side")
    met = pairs.mapInArrow(_meet(tables, nearest), "query_id long, id long, low double, high double")
    once = met.groupBy("query_id", "id").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    by_low = Window.partitionBy("query_id").orderBy(F.desc("low"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = F.nth_value("low", nearest + 1).over(by_low)
    usable = once.withColumn("least", least).where(F.col("least").isNull() | (F.col("high") >= F.col("least"))).select("query_id", "id")
    asked = queries.select(F.col("id").alias("query_id"), F.col("vector").alias("q"))
    paired = usable.join(points.select("id", "ids", "vector"), "id").join(asked, "query_id")
    product = F.zip_with("q", "vector", lambda x, y: F.coalesce(x, F.lit(0.0)) * F.coalesce(y, F.lit(0.0)))
    score = F.aggregate(product, F.lit(0.0), lambda total, x: total + x)
    each = paired.select("query_id", score.alias("score"), F.explode("ids").alias("vec_id")).where("query_id != vec_id").distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= nearest)


def search(rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST, tables: int = TABLES, longest: float = LONGEST) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the nearest found for each row where ``is_query`` is true.

    Nearest first by inner product, ties to the smaller id; a query's own id is no candidate.  Rows with a null key, and
    vectors that are null, empty, zero or hold null or non-finite components, take no part.  Repeated rows
    count once; a shorter vector is as if it ended in zeros.  A query that finds fewer than ``nearest``
    is compared with every vector instead.  ``longest`` is the share of long vectors that all queries meet.
    """
    whole = F.col(vector).cast("array<double>")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(whole, lambda x: x != 0)
    valid = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(finite)
    kept = stored(valid.select(F.col(key).cast("long").alias("id"), whole.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).distinct())
    top = kept.agg(F.max(F.size("vector")).alias("width"), F.count_distinct("id").alias("n")).first()
    width, total = top["width"] or 1, top["n"]

    same = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]
    order = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = kept.select("id", "vector", *same).withColumn("n", order).where(F.col("n") <= nearest + 1)
    points = few.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.sort_array(F.collect_set("id")).alias("ids"), F.first("vector").alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    points = stored(points.select("id", "ids", "vector", norm.alias("norm")))
    n_points = points.count()
    # Norms that differ by rounding only are equal: none of them is among the longest.
    cut = (points.agg(F.percentile_approx("norm", 1 - longest, 10_000)).first()[0] or 0.0) * (1 + ROUNDING)
    queries = kept.where("asks").select("id", "vector")

    def hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
        return rows.select("id", "vector").mapInArrow(_hashed(width, tables, probes), _PLACED)

    far = F.col("norm") > cut if longest > 0 else F.lit(False)
    found = stored(_dealt(hashed(queries, tables, PROBES), hashed(points, tables, 0).withColumn("far", far), queries, points, n_points, tables, nearest))
    counted = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("c")).where(F.col("c") >= min(nearest, total - 1))
    short = stored(queries.join(counted, "id", "left_anti"))
    if total > 1 and short.limit(1).count():
        every = hashed(points, 0, 0).withColumn("far", F.lit(True))
        rest = _dealt(hashed(short, 0, 0), every, short, points, n_points, 0, nearest)
        found = found.join(short, found["query_id"] == short["id"], "left_anti").unionByName(rest)
    return found.select("query_id", "rank", "vec_id", "score")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
