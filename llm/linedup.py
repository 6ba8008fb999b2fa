"""Deletion of later copies of repeated line runs, by prefix doubling over line ids.

Lines with a word get 128-bit ids; a document is a sequence of ids.  Round k names the next 2**k lines from
each position by hashing the names of its two halves, so equal names are equal prefixes: the suffixes of
the suffix array that share a prefix stand together as one group, an interval whose longest common
prefix is at least that long.  A position whose name occurs once cannot lie in a longer repeat and is
dropped, which leaves little to sort after the first round.

A repeated run counts from ``min_words`` words.  The shortest run of so many words from a line on, and the
shortest that ends at a line, are looked up in these intervals; all but the first copy (by key, then
line) are deleted.  The union of those shortest runs is the union of all maximal repeated runs of
``min_words`` words: each line of a maximal run lies in a shortest run that stays inside it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.tables import stored, table

MIN_WORDS = 50
#: Words as in ``[^\x20\x09-\x0D]+``.
WORD = "[^\\x20\\x09-\\x0D]+"
_DOC = ["k", "h"]


def _free(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def _sequence(docs: DataFrame, key: str, text: str) -> DataFrame:
    """k, h (hash of the text), i (0, 1, ... over lines with a word), line (its place in the text), words, id_1, id_2."""
    split = F.split(F.col(text), "\n", -1)
    line = F.transform(split, lambda x, n: F.struct(n.cast("int").alias("line"), x.alias("x")))
    worded = F.filter(line, lambda s: s["x"].rlike(WORD))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.posexplode(worded).alias("i", "s")).select("k", "h", "i", "s.line", "s.x")
    words = F.regexp_count("x", F.lit(WORD))
    # Rows of equal key and text are one document.
    ids = rows.select("k", "h", "i", "line", words.alias("words"), F.xxhash64("x").alias("id_1"), F.xxhash64(F.lit(1), "x").alias("id_2"))
    return ids.dropDuplicates(["k", "h", "i"])


def _runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Distinct shortest runs of ``min_words`` words: k, h, i (first line), n (lines)."""
    along = Window.partitionBy(*_DOC).orderBy("i")
    counted = lines.select(*_DOC, "i", "words", F.sum("words").over(along).alias("upto"))
    counted = counted.withColumn("before", F.col("upto") - F.col("words"))
    total = F.max("upto").over(Window.partitionBy(*_DOC))
    ahead = F.count("*").over(Window.partitionBy(*_DOC).orderBy("before").rangeBetween(0, min_words - 1))
    behind = F.count("*").over(Window.partitionBy(*_DOC).orderBy("upto").rangeBetween(-(min_words - 1), 0))
    sized = counted.select(*_DOC, "i", "before", "upto", total.alias("total"), ahead.alias("ahead"), behind.alias("behind"))
    from_here = F.when(F.col("total") - F.col("before") >= min_words, F.struct(F.col("i").alias("i"), F.col("ahead").cast("int").alias("n")))
    to_here = F.when(F.col("upto") >= min_words, F.struct((F.col("i") - F.col("behind") + 1).cast("int").alias("i"), F.col("behind").cast("int").alias("n")))
    each = sized.select(*_DOC, F.explode(F.array_compact(F.array_distinct(F.array(from_here, to_here)))).alias("r"))
    return each.select(*_DOC, "r.i", "r.n").distinct()


def _repeated(names: DataFrame) -> DataFrame:
    """Positions whose name occurs more than once."""
    often = names.groupBy("id_1", "id_2").agg(F.count("*").alias("c")).where("c > 1").select("id_1", "id_2")
    return names.join(often, ["id_1", "id_2"]).select(*_DOC, "i", "id_1", "id_2")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """k, h, first, last: stretches of lines (places in the text) that are later copies, not touching each other."""
    lines = stored(_sequence(docs, key, text))
    runs = _runs(lines, min_words).withColumn("level", F.expr("int(floor(log2(n + 0.5)))"))
    runs = stored(runs)
    longest = runs.agg(F.max("n")).first()[0] or 0
    found, names, level = [], lines.select(*_DOC, "i", "id_1", "id_2"), 0
    while longest >= 1 << level:
        if level:
            half = 1 << (level - 1)
            shifted = Window.partitionBy(*_DOC).orderBy("i").rangeBetween(half, half)
            pair = names.select(*_DOC, "i", "id_1", "id_2", F.first("id_1").over(shifted).alias("next_1"), F.first("id_2").over(shifted).alias("next_2"))
            names = pair.where("next_1 is not null").select(
                *_DOC, "i", F.xxhash64("id_1", "id_2", "next_1", "next_2").alias("id_1"), F.xxhash64(F.lit(1), "id_1", "id_2", "next_1", "next_2").alias("id_2")
            )
        names = stored(_repeated(names))
        # A run of n lines is its first and its last 2**level lines, which overlap.
        mine = runs.where(F.col("level") == level)
        head = names.select(*[F.col(c).alias(f"{c}_a") for c in (*_DOC, "i")], F.col("id_1").alias("a_1"), F.col("id_2").alias("a_2"))
        tail = names.select(*[F.col(c).alias(f"{c}_b") for c in (*_DOC, "i")], F.col("id_1").alias("b_1"), F.col("id_2").alias("b_2"))
        at = lambda side, place: F.col("k").eqNullSafe(F.col(f"k_{side}")) & (F.col("h") == F.col(f"h_{side}")) & (place == F.col(f"i_{side}"))
        named = mine.join(head, at("a", F.col("i"))).join(tail, at("b", F.col("i") + F.col("n") - (1 << level)))
        found.append(named.select(*_DOC, "i", "n", "a_1", "a_2", "b_1", "b_2"))
        level += 1
    if not found:
        return lines.select(*_DOC, F.col("line").alias("first"), F.col("line").alias("last")).limit(0)
    copies = stored(reduce(DataFrame.union, found))
    run = ["n", "a_1", "a_2", "b_1", "b_2"]
    order = F.struct(F.col("k").isNotNull().alias("x"), F.col("k").alias("k"), F.col("h").alias("h"), F.col("i").alias("i"))
    firsts = copies.groupBy(*run).agg(F.min(order).alias("earliest"), F.count("*").alias("c")).where("c > 1").drop("c")
    later = copies.join(firsts, run).where(order != F.col("earliest"))
    deleted = later.select(*_DOC, F.explode(F.expr("sequence(i, i + n - 1)")).alias("i")).distinct()
    placed = deleted.join(lines.select(F.col("k").alias("k_"), F.col("h").alias("h_"), F.col("i").alias("i_"), "line"), F.col("k").eqNullSafe(F.col("k_")) & (F.col("h") == F.col("h_")) & (F.col("i") == F.col("i_")))
    island = F.col("i") - F.row_number().over(Window.partitionBy(*_DOC).orderBy("i"))
    return placed.select(*_DOC, "line", island.alias("island")).groupBy(*_DOC, "island").agg(F.min("line").alias("first"), F.max("line").alias("last")).drop("island")


def _without(text: Column, gone: Column) -> Column:
    """The text without the stretches of lines in ``gone``, an ascending array of (first, last)."""
    lines = F.split(text, "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g["last"] + 1))
    ends = F.concat(F.transform(gone, lambda g: g["first"]), F.array(F.size(lines)))
    kept = F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(kept), "\n")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later copies of repeated runs deleted from the text, plus ``gone``, what was deleted.

    ``gone`` is an ascending array of (first, last) lines from 0, empty where nothing was.  Blank lines inside
    a deleted run go with it; a text that is one later copy becomes empty.  Null texts stay null.  Equal
    keys with different texts are different documents, the first by the text's hash; rows with equal key
    and text are one document and get the same text.  A null key comes first.  A column ``gone`` of ``docs`` is replaced.
    """
    stretches = repeated_lines(docs, key, text, min_words)
    gone = stretches.groupBy(*_DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("stretches"))
    names = [c for c in docs.columns if c != "gone"]
    k, h, g = (_free(x, docs.columns) for x in ("k_of_gone", "h_of_gone", "stretches_gone"))
    gone = gone.toDF(k, h, g)
    joined = docs.select(*names).join(gone, F.col(key).eqNullSafe(F.col(k)) & (F.xxhash64(text) == F.col(h)), "left")
    changed = F.when(F.col(g).isNull(), F.col(text)).otherwise(_without(F.col(text), F.col(g)))
    none = F.expr("cast(array() as array<struct<first:int,last:int>>)")
    return joined.select(*[changed.alias(c) if c == text else F.col(c) for c in names], F.coalesce(g, none).alias("gone"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication leaves of all documents, as counts and a digest."""
    done = without_repeats(table(spark, sf_dir, "documents"))
    deleted = F.aggregate("gone", F.lit(0), lambda n, g: n + g["last"] - g["first"] + 1)
    return done.select("doc_id", deleted.cast("long").alias("deleted_lines"), F.size("gone").cast("long").alias("deleted_runs"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS i, line, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
),
counted AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM lines),
runs AS (
  SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i), b.i FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.i
),
contents AS (
  SELECT r.doc_id, r.a, r.b, string_agg(l.x, chr(10) ORDER BY l.i) AS content FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.i BETWEEN r.a AND r.b GROUP BY ALL
),
later AS (SELECT * FROM contents QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, a) > 1),
gone AS (SELECT DISTINCT l.doc_id, l.i, l.line FROM later r JOIN lines l ON l.doc_id = r.doc_id AND l.i BETWEEN r.a AND r.b),
islands AS (
  SELECT doc_id, min(line) AS first, max(line) AS last
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM gone) GROUP BY doc_id, island
),
per_doc AS (SELECT doc_id, sum(last - first + 1) AS deleted_lines, count(*) AS deleted_runs FROM islands GROUP BY doc_id),
kept AS (
  SELECT t.doc_id, string_agg(t.x, chr(10) ORDER BY t.line) AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL) t
  WHERE NOT EXISTS (SELECT 1 FROM islands g WHERE g.doc_id = t.doc_id AND t.line BETWEEN g.first AND g.last)
  GROUP BY t.doc_id
)
SELECT d.doc_id, CAST(coalesce(p.deleted_lines, 0) AS BIGINT) AS deleted_lines, CAST(coalesce(p.deleted_runs, 0) AS BIGINT) AS deleted_runs, md5(coalesce(k.text, '')) AS text_md5
FROM documents d LEFT JOIN per_doc p USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
