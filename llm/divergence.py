"""How the sources of a language differ in their words, from count-level bitmaps, in exact integers.

Terms of a language get gapless ids.  For every (group, count) there is a bitset of the ids with that count
in that group, kept in chunks of the id space; the ids a group does not hold are the complement.  Two
groups' bitsets, ANDed and counted, give the sizes of the pair's joint cells (count here, count there), and
the divergence, which depends on the two counts only, is evaluated once per cell instead of once per term.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.tables import bucket_count, ranked, stored, table
from streammart.operators.skew import lookup_join

SCALE = 1_000_000_000
#: Bytes outside terms become spaces, A-Z becomes a-z; in UTF-8 all bytes of a character above 0x7F are above 0x7F.
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
#: Counts a task holds before it sends them on.
_HELD = 400_000
#: Frequent terms have counts of their own, so their chunks are one word; the others share few counts.
_HEAD, _HEAD_CHUNK, _CHUNK = 1 << 14, 64, 1024
#: Groups of a language that meet in one task, on each side.
_BLOCK = 32


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), added up within a task; each group also without a term."""
    terms: dict = defaultdict(Counter)
    docs: dict = defaultdict(Counter)
    groups, held = set(), 0

    def flush():
        for key, counted in terms.items():
            of = docs[key]
            words = list(counted)
            size = len(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * size, pa.string()),
                    pa.array([key[1]] * size, pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(list(counted.values()), pa.int64()),
                    pa.array([of[w] for w in words], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        terms.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"].cast(pa.large_binary())):
            key = (lang, source)
            groups.add(key)
            found = text.as_py().translate(_TERMS).split()
            counted = terms[key]
            before = len(counted)
            counted.update(found)
            docs[key].update(set(found))
            held += len(counted) - before
            if held > _HELD:
                yield from flush()
                held = 0
    yield from flush()
    for lang, source in groups:
        yield pa.RecordBatch.from_pylist(
            [{"lang": lang, "source": source, "term": None, "n": 0, "docs": 0}],
            pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]),
        )


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact beyond 64 bits."""
    above = (count + 1).cast("decimal(27,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, F.greatest(total + terms, F.lit(1)).cast("decimal(20,0)")).cast("long") + 1


def _chunk_of(rank: str) -> tuple[Column, Column]:
    """Chunk and place in it of a term id."""
    head = F.col(rank) < _HEAD
    chunk = F.when(head, F.expr(f"{rank} div {_HEAD_CHUNK}")).otherwise(F.expr(f"{_HEAD // _HEAD_CHUNK} + ({rank} - {_HEAD}) div {_CHUNK}"))
    return chunk, F.when(head, F.col(rank) % _HEAD_CHUNK).otherwise((F.col(rank) - _HEAD) % _CHUNK).cast("int")


def _chunks(terms: Column) -> Column:
    """How many chunks a language has; one, empty, for a language without terms."""
    head = F.ceil(F.least(terms, F.lit(_HEAD)) / _HEAD_CHUNK)
    return F.greatest(head + F.ceil(F.greatest(terms - _HEAD, F.lit(0)) / _CHUNK), F.lit(1)).cast("long")


def _joint_cells(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums over the joint cells of all pairs of groups of two blocks, for one chunk of terms."""
    lang, chunk, one, other = (k.as_py() for k in key)
    source, block, level = (rows[c].to_pylist() for c in ("source", "block", "p"))
    word, bits = rows["word"].to_numpy(), rows["bits"].to_numpy()
    start = chunk * _HEAD_CHUNK if chunk < _HEAD // _HEAD_CHUNK else _HEAD + (chunk - _HEAD // _HEAD_CHUNK) * _CHUNK
    whole = _HEAD_CHUNK if chunk < _HEAD // _HEAD_CHUNK else _CHUNK
    marks = np.flatnonzero(word < 0)
    size = max(0, min(whole, int(bits[marks[0]]) - start))
    every = np.zeros(whole, np.uint8)
    every[:size] = 1
    every = np.packbits(every, bitorder="little").view(np.uint64)
    sets: dict[str, dict[int, np.ndarray]] = defaultdict(lambda: defaultdict(lambda: np.zeros(len(every), np.uint64)))
    for k in np.flatnonzero(word >= 0):
        sets[source[k]][level[k]][word[k]] |= bits[k].astype(np.int64).view(np.uint64)

    def levels(name: str, zero: int) -> tuple[np.ndarray, np.ndarray]:
        have = sets.get(name, {})
        known = np.array(list(have.values()), np.uint64).reshape(len(have), len(every))
        rest = every & ~np.bitwise_or.reduce(known, axis=0) if len(have) else every
        return np.array([*have, zero], np.int64), np.vstack([known, rest[None]])

    sides: tuple[list, list] = ([], [])
    for k in marks:
        made = (source[k], *levels(source[k], level[k]))
        if block[k] == one:
            sides[0].append(made)
        if block[k] == other:
            sides[1].append(made)
    names = [m[0] for m in sides[1]]
    q = np.concatenate([m[1] for m in sides[1]])
    masks = np.vstack([m[2] for m in sides[1]])
    owner = np.repeat(np.arange(len(names)), [len(m[1]) for m in sides[1]])
    out: list[tuple[str, str, int]] = []
    for name, p, own in sides[0]:
        there, back = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        step = max(1, (1 << 22) // max(1, masks.size))
        for k in range(0, len(p), step):
            cells = np.bitwise_count(own[k : k + step, None, :] & masks[None]).sum(-1, dtype=np.int64)
            i, j = np.nonzero(cells)
            n, a, b = cells[i, j], p[k + i], q[j]
            square = (a - b) ** 2
            np.add.at(there, owner[j], n * (square // b))
            if one != other:
                np.add.at(back, owner[j], n * (square // a))
        for at, item in enumerate(names):
            if item != name or one != other:
                out.append((name, item, int(there[at])))
                if one != other:
                    out.append((item, name, int(back[at])))
    columns = list(zip(*out)) or [(), (), ()]
    return pa.table(
        {
            "lang": pa.array([lang] * len(out), pa.string()),
            "source": pa.array(columns[0], pa.string()),
            "item": pa.array(columns[1], pa.string()),
            "value": pa.array(columns[2], pa.int64()),
        }
    )


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """One row per (lang, source, part, item): ``value`` and its ``rank`` from 1 within (lang, source, part).

    ``docs`` has ``text``, ``lang``, ``source``; a null in any is an empty text, and other columns are not
    read.  A row is a document, so repeated rows count as often as they stand there.  A language keeps the
    terms found in at least ``min_docs`` of its documents.  With p and q as floors of a billion times the
    smoothed share plus one, part ``pair`` holds for each other source of the language the sum of
    floor((p - q)^2 / q) over all kept terms (0 without any), part ``term`` the ``top`` terms in which a
    group is above its language.  Ties go by item.  An empty table gives an empty result.

    A group's terms or documents are never gathered: counts are combined in every input task, then by
    (group, term).  A task of the pair part holds one chunk of at most 1,024 terms of 64 groups.  All pairs
    of a language are in the result, so blocks of groups meet; what moves is bitsets, not terms.
    """
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))

    terms = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    terms = stored(terms.filter(F.col("docs") >= min_docs).drop("docs"))
    # Ids go by class of frequency, then by hash: gapless, frequent terms first, and no class in one task.
    spread = bucket_count(terms.count())
    bucket = (F.lit(64) - F.floor(F.log2("total"))) * spread + F.pmod(F.xxhash64("term"), F.lit(spread))
    ids = ranked(terms, ["lang"], bucket, [F.col("term")], "id").withColumnRenamed("id_of", "terms_")
    known = stored(counts.filter("term IS NOT NULL").select("lang", "source", "term", "n").join(ids, ["lang", "term"]))

    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("of_group"))
    langs = known.groupBy("lang").agg(F.sum("n").alias("of_lang"), F.max("terms_").alias("of_terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(
        groups.select("lang", "source", zero("of_group"), zero("of_lang"), zero("of_terms")).withColumn(
            "block", F.expr(f"cast((row_number() over (partition by lang order by source) - 1) div {_BLOCK} as int)")
        )
    )
    blocks = F.max("block").over(Window.partitionBy("lang")) + 1
    groups = stored(groups.withColumn("blocks", blocks))
    cells = lookup_join(known, groups, on={"lang": "lang", "source": "source"})
    cells = cells.withColumn("p", _share(F.col("n"), F.col("of_group"), F.col("of_terms")))

    chunk, place = _chunk_of("id")
    bitsets = (
        cells.withColumns({"chunk": chunk, "place": place})
        .withColumn("word", F.expr("place div 64").cast("int"))
        .groupBy("lang", "source", "block", "blocks", "chunk", "p", "word")
        .agg(F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits"))
    )
    marks = groups.select(
        "lang", "source", "block", "blocks",
        F.explode(F.sequence(F.lit(0).cast("long"), _chunks(F.col("of_terms")) - 1)).alias("chunk"),
        _share(F.lit(0).cast("long"), F.col("of_group"), F.col("of_terms")).alias("p"),
        F.lit(-1).alias("word"),
        F.col("of_terms").alias("bits"),
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = bitsets.unionByName(marks).withColumn("partner", partner)
    met = met.select(
        "lang", "chunk", F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("other"),
        "source", "block", "p", "word", "bits",
    )
    partial = met.groupBy("lang", "chunk", "one", "other").applyInArrow(_joint_cells, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    q = _share(F.col("total"), F.col("of_lang"), F.col("of_terms"))
    above = cells.withColumn("q", q).filter("p > q")
    above = above.select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    place_in = lambda rows, part: rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )
    return place_in(pairs, "pair").unionByName(place_in(above, "term").filter(F.col("rank") <= top))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents: every pair of sources, and the 200 terms most above their language."""
    return audit(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
t AS (SELECT lang, source, r, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = x.lang AND c.source = x.source), 0) AS of_group,
         coalesce((SELECT sum(total) FROM kept k WHERE k.lang = x.lang), 0) AS of_lang,
         (SELECT count(*) FROM kept k WHERE k.lang = x.lang) AS v
  FROM (SELECT DISTINCT lang, source FROM d) x),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.of_group + g.v)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (k.total + 1) // (g.of_lang + g.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
above AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM above))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
