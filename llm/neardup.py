"""Near-duplicates by SetSketch registers.

A document's set of word shingles becomes 256 one-byte registers: minima of hashed shingles, truncated on an
exponential scale.  Registers of a union are the maxima of registers, and equal ones show similar sets.
Bands of registers gather candidates, the joint likelihood of two sketches drops those that are
far from the threshold, and the full sets decide.

Documents with equal sets are one class.  Components need no list of all pairs: in every bucket of a band
the members first meet one of them, by turns another one, and only what is still in different components
then is compared pair by pair, register against register, in cells of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BooleanType

from llm.components import components
from llm.hashing import U64, pieces, seeds, shingle_hashes, word_hashes
from llm.tables import set_aside, stored, table

REGISTERS, BASE, RATE = 256, 1.1, 20.0
#: 42 bands of 6 registers: a pair of similarity 0.8 meets in none of them once in a million times.
BANDS, ROWS = 42, 6
#: Standard errors of the estimate below the threshold at which a pair is still verified.
MARGIN = 4.5
#: Turns in which the members of a bucket meet one of them; in one more each meets the one most like it.
STARS = 1
#: Members of a bucket that are compared in one task.
CELL = 1_000
_FACTORS, _SHIFTS = seeds(REGISTERS, 11) | U64(1), seeds(REGISTERS, 12)


def registers(shingles: np.ndarray) -> np.ndarray:
    """floor(1 - log_BASE(x)) of the smallest exponential variate x of each register, kept to one byte."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, U64)
    for k in range(0, len(shingles), 2_000):
        low = np.minimum(low, (shingles[k : k + 2_000, None] * _FACTORS + _SHIFTS).min(axis=0))
    x = -np.log1p(-(low.astype(float) + 0.5) / 2.0**64 * (1 - 2.0**-52)) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, 255).astype(np.uint8)


def likely(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the most likely similarity of two sketches reaches ``threshold`` less the margin.

    more, less: registers in which a is above, below b; n_a, n_b: sizes of the sets.  The log-likelihood
    is concave in the similarity, so the sign of its slope at the bound tells on which side its peak is.
    Sets of sizes that cannot reach ``threshold`` are never likely.
    """
    bound = max(threshold - MARGIN * math.sqrt(threshold * (1 - threshold) / REGISTERS), 0.01)
    n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
    u = n_a / (n_a + n_b)
    v = 1 - u
    step = (BASE - 1) / BASE
    inner_a, inner_b = np.maximum(u - v * bound, 1e-12), np.maximum(v - u * bound, 1e-12)
    p = lambda x: -np.log1p(-x * step) / math.log(BASE)
    slope = lambda x: step / (1 - x * step) / math.log(BASE)
    pa_, pb_, sa, sb = p(inner_a), p(inner_b), v * slope(inner_a), u * slope(inner_b)
    rise = -more * sa / pa_ - less * sb / pb_ + (REGISTERS - more - less) * (sa + sb) / (1 - pa_ - pb_)
    return (rise >= 0) & (np.minimum(n_a, n_b) >= (threshold - 1e-9) * np.maximum(n_a, n_b))


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    for _, part in pieces(texts):
        words, first = word_hashes(part, lower=True)
        hashes, at = shingle_hashes(words, first, size)
        for a, b in zip(at, at[1:]):
            yield np.unique(hashes[a:b])


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, print_, sketch = [], [], []
            for found in _sets(batch.column(2), size):
                count.append(len(found))
                print_.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                sketch.append(registers(found).tobytes() if len(found) else None)
            made = [pa.array(count, pa.int64()), pa.array(print_, pa.binary()), pa.array(sketch, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["row", "doc_id", "n", "print", "registers"])

    return run


def _full(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_sets(batch.column(1), size))
            full, short = (pa.array([f(x) for x in found], pa.binary()) for f in (np.ndarray.tobytes, _short))
            yield pa.RecordBatch.from_arrays([batch.column(0), full, short], names=["class", "shingles", "short"])

    return run


def _short(shingles: np.ndarray) -> bytes:
    """The first 16 bits of each shingle's hash, in order; a quarter of the full set."""
    return (shingles >> U64(48)).astype("<u2").tobytes()


def _counted(short: bytes) -> np.ndarray:
    """Makes equal numbers different by their count so far, so that common elements can be counted."""
    x = np.frombuffer(short, "<u2").astype(np.int64)
    first = np.maximum.accumulate(np.where(np.diff(x, prepend=-1) != 0, np.arange(len(x)), 0))
    return x << 32 | np.arange(len(x)) - first


def _common(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), np.uint8).reshape(-1, REGISTERS)


def _likely_pairs(threshold: float):
    @arrow_udf(BooleanType())
    def run(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        x, y = _matrix(a), _matrix(b)
        return pa.array(likely((x > y).sum(1), (x < y).sum(1), n_a.to_numpy(), n_b.to_numpy(), threshold))

    return run


def _confirmed(percent: int):
    @arrow_udf(BooleanType())
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
            common = _common(x, y)
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    return run


def _cells(percent: int, best: bool):
    """Pairs of different components in one cell (two blocks of a bucket, or one with itself) that are likely.

    ``best``: for each member the pair with the most equal registers only.  Otherwise all pairs whose shortened
    sets have enough in common: equal shingles stay equal when shortened, so no link is lost.
    """
    threshold = percent / 100

    def run(rows: pa.Table) -> pa.Table:
        sketch, n = _matrix(rows["registers"]), rows["n"].to_numpy()
        name, part, left = rows["class"].to_numpy(), rows["component"].to_numpy(), rows["left_"].to_numpy()
        right = rows["right_"].to_numpy()
        band = rows["band"][0].as_py()
        short = [] if best else [_counted(x) for x in rows["short"].to_pylist()]
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        found = [np.zeros((0, 2), np.int64)]
        for i in a:
            other = b[(part[b] != part[i]) & (~(left[b] & right[i]) | (name[b] > name[i]))]
            more, less = (sketch[i] > sketch[other]).sum(1), (sketch[i] < sketch[other]).sum(1)
            hit = other[likely(more, less, n[i], n[other], threshold)]
            # A pair that meets in several bands is left to the first.
            equal = (sketch[hit][:, : BANDS * ROWS] == sketch[i][: BANDS * ROWS]).reshape(len(hit), BANDS, ROWS).all(2)
            if best and len(hit):
                hit = hit[[(sketch[hit] == sketch[i]).sum(1).argmax()]]
            elif len(hit):
                hit = hit[equal.argmax(1) == band]
                common = np.array([_common(short[i], short[k]) for k in hit], np.int64)
                hit = hit[100 * common >= percent * (n[i] + n[hit] - common)]
            found.append(np.stack([np.minimum(name[hit], name[i]), np.maximum(name[hit], name[i])], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    one = full.select(F.col("class").alias("a"), F.col("shingles").alias("set_a"))
    two = full.select(F.col("class").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(one, "a").join(two, "b").where(_confirmed(percent)("set_a", "set_b")).select("a", "b")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``row__``, stored: Spark numbers rows anew in every scan, and splits depend on the cores alive then."""
    return stored(docs.withColumn("row__", F.monotonically_increasing_id()))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, membership): rows have row, doc_id, n, class; membership has class and component.

    ``docs`` is a table of ``_numbered``; ``row`` is its ``row__``.  A text without a word has no class and is similar to nothing.
    """
    threshold = percent / 100
    numbered = docs.select(F.col("row__").alias("row"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema[key].dataType.simpleString()
    sketches = stored(numbered.mapInArrow(_sketch(size), f"row long, doc_id {id_type}, n long, print binary, registers binary"))
    with_class = sketches.where("n > 0").groupBy("print").agg(F.min("row").alias("class"))
    rows = stored(sketches.select("row", "doc_id", "n", "print").join(with_class, "print", "left").drop("print"))
    heads = sketches.join(rows.where("row = class").select("row", "class"), "row").select("class", "n", "registers")
    heads = stored(heads)

    band = F.explode(F.expr(f"transform(sequence(0, {BANDS - 1}), i -> struct(i as band, xxhash64(i, substring(registers, i * {ROWS} + 1, {ROWS})) as bucket))"))
    members = heads.select("class", band.alias("k")).select("class", "k.band", "k.bucket")
    shared = members.groupBy("band", "bucket").agg(F.count("*").alias("g")).where("g > 1")
    labelled = stored(members.join(shared, ["band", "bucket"]).withColumn("component", F.col("class")))

    candidates = labelled.select("class").distinct()
    texts = numbered.select(F.col("row").alias("class"), "text").join(candidates, "class", "left_semi")
    full = stored(texts.mapInArrow(_full(size), "class long, shingles binary, short binary"))

    sketch_a = heads.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    sketch_b = heads.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))
    links = None
    for turn in range(STARS + 1):
        if turn < STARS:
            pivot = F.min_by(F.struct("class", "component"), F.xxhash64(F.lit(turn), "class")).alias("pivot")
            stars = _open(labelled, pivot).where("component != pivot.component")
            stars = stars.select(F.least("class", "pivot.class").alias("a"), F.greatest("class", "pivot.class").alias("b")).distinct()
            near = stars.join(sketch_a, "a").join(sketch_b, "b").where(_likely_pairs(threshold)("r_a", "r_b", "n_a", "n_b")).select("a", "b")
        else:
            near = _crossing(labelled, heads, percent, True).distinct()
        confirmed = _verified(near, full, percent)
        links = stored(links.union(confirmed) if links else confirmed)
        found = components(links, "a", "b")
        members = labelled.drop("component").join(found, F.col("class") == F.col("node"), "left")
        labelled = stored(members.select("band", "bucket", "class", "g", F.coalesce("component", "class").alias("component")))
    last = _verified(_crossing(labelled, heads.join(full.select("class", "short"), "class"), percent, False), full, percent)
    return rows, components(stored(links.union(last)), "a", "b").select(F.col("node").alias("class"), "component")


def _crossing(labelled: DataFrame, heads: DataFrame, percent: int, best: bool) -> DataFrame:
    """a, b: likely pairs of different components that share a bucket; all of them, once, unless ``best``."""
    blocks = f"int(ceil(g / {CELL}.0))"
    cell = F.expr(f"transform(sequence(0, {blocks} - 1), j -> struct(least(j, own) as i, greatest(j, own) as j, own <= j as left_, own >= j as right_))")
    dealt = _open(labelled).join(heads, "class").withColumn("own", F.expr(f"int(pmod(xxhash64(class), {blocks}))")).withColumn("c", F.explode(cell))
    dealt = dealt.select("band", "bucket", "c.i", "c.j", "c.left_", "c.right_", "class", "component", "n", "registers", *([] if best else ["short"]))
    return dealt.groupBy("band", "bucket", "i", "j").applyInArrow(_cells(percent, best), "a long, b long")


def _open(labelled: DataFrame, *more: Column) -> DataFrame:
    """Members of the buckets that still hold several components; ``more`` is computed per bucket."""
    ends = labelled.groupBy("band", "bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), *more)
    return labelled.join(ends.where("x != y").drop("x", "y"), ["band", "bucket"])


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest key reachable), kept, for each row of ``docs``.

    Null keys count last: a component has a null id only if all its keys are null.  Rows with equal key and
    text are in one component and both kept if theirs is the smallest key.  A text without a word stands alone.
    """
    numbered = _numbered(docs.select(key, text))
    rows, membership = classes(numbered, text, key, size, percent)
    placed = rows.join(membership, "class", "left").withColumn("group_", F.coalesce("component", "class"))
    lowest = placed.where("group_ is not null").groupBy("group_").agg(F.min("doc_id").alias("lowest"))
    placed = placed.join(lowest, "group_", "left").withColumn("component_id", F.when(F.col("group_").isNull(), F.col("doc_id")).otherwise(F.col("lowest")))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without all but the row of smallest key (then the first) of each group; its columns."""
    own, renamed = set_aside(docs, ["row__"])
    numbered = _numbered(own)
    rows, membership = classes(numbered, text, key, size, percent)
    placed = rows.where("class is not null").join(membership, "class", "left").withColumn("group_", F.coalesce("component", "class"))
    first = placed.groupBy("group_").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    gone = placed.join(first, "group_").where("row != first.row").select(F.col("row").alias("row__"))
    left = numbered.join(gone, "row__", "left_anti").drop("row__")
    return left.withColumnsRenamed({new: old for old, new in renamed.items()})


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents over 3-word shingles at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Every pair that shares a shingle, compared on full sets; components by reachability.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (
  SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.root FROM reach r JOIN edge e ON e.a = r.doc_id),
lowest AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM lowest LEFT JOIN n USING (doc_id)
"""
