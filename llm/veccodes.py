"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, learned by ball k-means.

Everything is in integers.  An entry and the parts it had in the last round form a ball.  Another entry can
take (or, at equal distance and lower number, tie) a part x of entry c only if its squared distance to c is
at most 4 |x - c|^2.  So the ball's radius names its neighbour entries; parts nearer than half the distance
to the nearest neighbour are the stable core and are left alone; and rings around it each have a prefix of
the neighbours, sorted by distance, as their only candidates.  The result is exactly that of comparing all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import stored, table
from streammart.operators.skew import lookup_join

#: Components beyond this have squared distances that may not fit 64 bits; they raise an error.
LARGEST = 1 << 24
#: Neighbours of a ball compared at once.
_STEP = 32


def _numbers(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles where every sum on the way stays an exact integer (fast), else as 64-bit integers."""
    most = max(np.abs(vectors).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if 16 * max(1, book.shape[1]) * int(most) ** 2 < 1 << 53 else np.int64
    return vectors.astype(kind), book.astype(kind)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest entry, the lowest at ties, and the squared distance, for each row."""
    x, book = _numbers(vectors, book)
    all_of = _squares(x, book)
    found = all_of.argmin(1)
    return found, all_of[np.arange(len(x)), found].astype(np.int64)


def nearest_from(vectors: np.ndarray, book: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, starting from the entry each row had before."""
    x, book = _numbers(vectors, book)
    own = ((x - book[prior]) ** 2).sum(1)
    found, least = prior.copy(), own.copy()
    between = _squares(book, book)
    by_ball = np.argsort(prior, kind="stable")
    balls, begins = np.unique(prior[by_ball], return_index=True)
    for ball, members in zip(balls, np.split(by_ball, begins[1:])):
        radius = own[members].max()
        others = np.flatnonzero(between[ball] <= 4 * radius)
        others = others[others != ball]
        if not len(others):
            continue
        others = others[np.argsort(between[ball, others], kind="stable")]
        ring = np.searchsorted(between[ball, others], 4 * own[members], "right")
        for start in range(0, len(others), _STEP):
            who = members[ring > start]
            if not len(who):
                break
            candidates = np.sort(others[start : start + _STEP])
            squares = _squares(x[who], book[candidates])
            at = squares.argmin(1)
            square, entry = squares[np.arange(len(who)), at], candidates[at]
            better = (square < least[who]) | ((square == least[who]) & (entry < found[who]))
            found[who[better]], least[who[better]] = entry[better], square[better]
    return found, least.astype(np.int64)


def _sums(codes: np.ndarray, vectors: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the rows of each entry."""
    order = np.argsort(codes, kind="stable")
    used, begins = np.unique(codes[order], return_index=True)
    count, total = np.bincount(codes, minlength=entries), np.zeros((entries, vectors.shape[1]), np.int64)
    if len(used):
        total[used] = np.add.reduceat(vectors[order], begins, axis=0)
    return count, total


def _floors(batch: pa.RecordBatch, scale: int) -> np.ndarray:
    values = np.floor(batch["vector_"].flatten().to_numpy(zero_copy_only=False) * float(scale))
    if np.abs(values).max(initial=0) > LARGEST:
        raise ValueError(f"a component times {scale} exceeds {LARGEST}")
    return values.astype(np.int64).reshape(batch.num_rows, -1)


def _pass(books: np.ndarray, scale: int, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One round over a partition: codes of its rows and, but for the last, a row with the sums of their parts.

    In the first round, told by vectors in place of integers, rows have no entry to start from.
    """
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        empty = None
        for batch in batches:
            if not batch.num_rows:
                continue
            begun = "codes_" in batch.schema.names
            if begun:
                whole = batch["ints_"].flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1)
                before = batch["codes_"].flatten().to_numpy().reshape(batch.num_rows, parts).astype(np.int64)
            else:
                whole = _floors(batch, scale)
            codes, error = np.empty((batch.num_rows, parts), np.int64), np.zeros(batch.num_rows, np.int64)
            for p in range(parts):
                mine = whole[:, p * width : (p + 1) * width]
                codes[:, p], square = nearest_from(mine, books[p], before[:, p]) if begun else nearest(mine, books[p])
                error += square
                if not last:
                    count, total = _sums(codes[:, p], mine, entries)
                    counts[p] += count
                    totals[p] += total
            kept = [batch["key_"], batch["label_"]]
            flat = pa.array(codes.astype(np.int16).ravel())
            coded = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, parts, dtype=np.int32), flat)
            if last:
                yield pa.RecordBatch.from_arrays([*kept, coded, pa.array(error)], ["key_", "label_", "codes_", "error_"])
                continue
            steps = np.arange(0, whole.size + 1, max(1, whole.shape[1]), dtype=np.int32) if whole.size else np.zeros(batch.num_rows + 1, np.int32)
            ints = pa.ListArray.from_arrays(steps, pa.array(whole.astype(np.int32).ravel()))
            made = pa.RecordBatch.from_arrays(
                [*kept, coded, ints, pa.nulls(batch.num_rows, _SUMS)], ["key_", "label_", "codes_", "ints_", "sums_"]
            )
            empty = made.schema
            yield made
        if empty is not None:
            sums = [
                {"part": int(p), "entry": int(e), "n": int(counts[p, e]), "total": totals[p, e].tolist()} for p, e in zip(*np.nonzero(counts))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, f.type) if f.name != "sums_" else pa.array([sums], _SUMS) for f in empty], schema=empty
            )

    return work


_SUMS = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]))
_SUMS_SQL = "array<struct<part:int,entry:int,n:bigint,total:array<bigint>>>"


def _moved(rounded: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round; at most entries * dimension numbers reach the driver."""
    parts, entries, width = books.shape
    sums = rounded.filter("sums_ IS NOT NULL").select(F.inline("sums_"))
    wide = [F.sum(F.col("total")[k].cast("decimal(20,0)")).alias(f"t{k}") for k in range(width)]
    after = books.copy()
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *wide).collect():
        after[row["part"], row["entry"]] = [int(row[f"t{k}"]) // row["n"] for k in range(width)]
    return after


def compress(
    vectors: DataFrame, key: str, column: str, label: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> tuple[DataFrame, np.ndarray]:
    """Rows (``key``, ``label``, ``codes_`` array of entry numbers, ``error_``) and the codebooks, (part, entry, position).

    Vectors that are null or hold a null or non-finite component are left out, and so are vectors of another
    length than that of the smallest key; that length must be a multiple of ``parts``.  Fewer rows than
    ``entries`` give as many entries.  Repeated keys are rows of their own (ordered by their vectors), a null
    key comes last, an empty table gives an empty result with empty codebooks.  Other columns are not read.

    Each round reads a stored table and writes the next, so a lost executor costs its own tasks.  A task
    sends one row of sums, added up in the cluster; the driver sees the codebooks only.
    """
    rows = vectors.select(F.col(key).alias("key_"), F.col(label).alias("label_"), F.col(column).cast("array<double>").alias("vector_"))
    rows = rows.filter(F.col("vector_").isNotNull() & ~F.exists("vector_", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    first = rows.orderBy(F.col("key_").asc_nulls_last(), "vector_").limit(entries).select("vector_").collect()
    length = len(first[0]["vector_"]) if first else 0
    if length % parts:
        raise ValueError(f"{length} components cannot be cut into {parts} equal parts")
    begin = [np.floor(np.array(r["vector_"], float) * scale) for r in first if len(r["vector_"]) == length]
    books = np.array(begin).astype(np.int64).reshape(len(begin), parts, length // parts).transpose(1, 0, 2).copy()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    keep = f"key_ {kinds['key_']}, label_ {kinds['label_']}, codes_ array<smallint>"
    state = rows.filter(F.size("vector_") == length)
    for _ in range(rounds if first else 0):
        state = stored(state.mapInArrow(_pass(books, scale, last=False), f"{keep}, ints_ array<int>, sums_ {_SUMS_SQL}"))
        books = _moved(state, books)
        state = state.filter("sums_ IS NULL").drop("sums_")
    coded = state.mapInArrow(_pass(books, scale, last=True), f"{keep}, error_ long")
    return coded.withColumnsRenamed({"key_": key, "label_": label}), books


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """Add ``label_error_``: the error summed over the rows of equal label, nulls together.  Give a stored table."""
    rows = coded.withColumns({"name_": F.coalesce(F.col(label).cast("string"), F.lit("")), "none_": F.col(label).isNull()})
    sums = rows.groupBy("name_", "none_").agg(F.sum("error_").alias("label_error_"))
    return lookup_join(rows, sums, on={"name_": "name_", "none_": "none_"}).drop("name_", "none_")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings."""
    coded, books = compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    two = lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")
    return with_label_error(stored(coded), "label").select(
        "vec_id",
        F.array_join(F.transform("codes_", lambda c: two(c)), "").alias("code"),
        F.col("error_").alias("error"),
        F.col("label_error_").alias("label_error"),
        F.lit(digest).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    """Plain k-means in SQL: every part against every entry."""
    steps = [
        """v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """p AS MATERIALIZED (
  SELECT vec_id, part, x[part * (len(x) // 4) + 1 : (part + 1) * (len(x) // 4)] AS x FROM v, range(4) r(part))""",
        """b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 256)""",
    ]
    for k in range(5):
        steps.append(f"""d{k} AS (
  SELECT vec_id, part, p.x, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM p JOIN b{k} b USING (part)),
a{k} AS MATERIALIZED (
  SELECT vec_id, part, any_value(x) AS x, min(d) AS d, arg_min(entry, d * 256 + entry) AS entry FROM d{k} GROUP BY vec_id, part)""")
        if k < 4:
            steps.append(f"""s{k} AS (
  SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, range(1, (SELECT max(len(x)) + 1 FROM p)) r(i) GROUP BY ALL),
m{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{k} GROUP BY ALL),
b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))""")
    return (
        "WITH " + ",\n".join(steps) + """,
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS digest FROM b4),
e AS (
  SELECT vec_id, string_agg(format('{:02x}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a4 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h.digest AS codebooks_sha256
FROM e JOIN v USING (vec_id), h
"""
    )


ORACLE = _oracle()
