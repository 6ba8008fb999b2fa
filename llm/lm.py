"""Language-model scores from a weighted backoff automaton over smoothed n-grams of up to three tokens.

Counting and scoring need every n-gram of the corpus, which fits no single task.  So texts are stored as
blocks of a few million tokens, and a block asks for the corpus counts of its different n-grams by their
sorted hashes.  Questions go up a tree: a block cuts its hashes into 256 ranges; where a range of all
blocks would not fit a task, 256 blocks' questions are added up and cut into 256 ranges again.  Each level
moves every hash at most once in messages of some thousand hashes, so the work is linear in the corpus but for
the number of levels, which is its logarithm to base 256.  Answers come down the same tree.

A first turn asks for words and bigrams.  A second asks for trigrams both of whose bigrams were seen
``MIN_SEEN`` times, and for the sums over such trigrams of a context, so that each state's arcs and failure
arc share out exactly one.  A block then has all arcs its texts can take, and one left-to-right traversal
per text accumulates log-probabilities.  Nothing but a few totals reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from llm.hashing import U64, mix, pieces, word_hashes
from llm.tables import stored, table

#: Strengths of the lower order in states of one and two tokens:
#: p(w|h) = (c(hw) + strength * p(w|shorter h)) / (c(h) + strength).
STRENGTHS = (500.0, 20.0)
#: A trigram can be an arc if both its bigrams occur this often in the training texts.
MIN_SEEN = 3
_SPREAD = U64(0x9E3779B97F4A7C15)
_END, _START = U64(0x5BD1E9955BD1E995), U64(0xC6A4A7935BD1E995)


@dataclass(frozen=True)
class Sizes:
    """Bytes of a block, most corpus tokens for each range at the top of the tree, and the binary logarithm of
    the ranges a range is cut into and of the askers a level joins.  They bound memory and change no result."""

    block_bytes: int = 12 << 20
    range_tokens: int = 1_500_000
    fan_bits: int = 8


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, texts in pieces(batch.column(2), block_bytes):
            words, at = word_hashes(texts, lower=True)
            docs = len(texts)
            places = np.arange(len(words)) + np.repeat(np.arange(docs), np.diff(at))
            tokens = np.full(len(words) + docs, _END, U64)
            tokens[places] = words
            vocabulary, ids, counts = np.unique(tokens, return_inverse=True, return_counts=True)
            # Frequent words get small numbers; among words of like frequency hashes stay sorted.
            order = np.lexsort((vocabulary, -np.frexp(counts)[1]))
            number_of = np.empty(len(order), "<u4")
            number_of[order] = np.arange(len(order))
            vocabulary, ids = vocabulary[order], number_of[ids]
            sizes = np.diff(at) + 1
            keys = pa.concat_arrays([batch.column(0).slice(first, docs)])
            number += 1
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    one(keys),
                    one(pa.concat_arrays([batch.column(1).slice(first, docs)])),
                    one(pa.array(sizes.astype(np.int32))),
                    pa.array([_planes(np.diff(vocabulary, prepend=U64(0)))], pa.binary()),
                    pa.array([_planes(ids)], pa.binary()),
                    pa.array([len(tokens)], pa.int64()),
                ],
                names=["block", "keys", "trains", "sizes", "vocabulary", "tokens", "n_tokens"],
            )


def _planes(values: np.ndarray) -> bytes:
    """Numbers by byte position, compressed: the high bytes of small numbers are runs of zeros."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T))


def _unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1).T).view(kind).ravel()


def _messages(owner: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Sorted hashes and their counts, one row for each value of the hashes' first ``bits`` bits."""
    prefix = keys >> U64(64 - bits)
    starts = np.flatnonzero(np.diff(prefix, prepend=~prefix[:1]))
    cuts = list(zip(starts, [*starts[1:], len(keys)]))
    return pa.RecordBatch.from_pydict(
        {
            "range": pa.array(prefix[starts].astype(np.int64)),
            "owner": pa.array(np.full(len(starts), owner)),
            "keys": pa.array([_planes(np.diff(keys[a:b], prepend=U64(0))) for a, b in cuts], pa.binary()),
            "counts": pa.array([_planes(counts[a:b]) for a, b in cuts], pa.binary()),
        }
    )


_MESSAGE = "range long, owner long, keys binary, counts binary"
_ANSWER = "range long, owner long, totals binary, train_tokens long, train_types long"


def _added(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Different hashes of several messages, their summed counts, and each message's places among them."""
    keys = [np.cumsum(_unplanes(x.as_py(), U64), dtype=U64) for x in rows["keys"]]
    names, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, which, np.concatenate([_unplanes(x.as_py(), np.int64) for x in rows["counts"]]))
    return names, total, np.split(which, np.cumsum([len(k) for k in keys])[:-1])


def _answer(rows: pa.Table) -> pa.Table:
    """Corpus counts of all hashes of one range, for each asker in the order it asked."""
    names, total, places = _added(rows)
    word = (names & U64(1) == U64(1)) & (names != mix(np.array([_START]))[0] | U64(1))
    first = np.arange(len(places)) == 0
    return pa.table(
        {
            "range": rows["range"],
            "owner": rows["owner"],
            "totals": pa.array([_planes(total[p]) for p in places], pa.binary()),
            "train_tokens": pa.array(total[word].sum() * first, pa.int64()),
            "train_types": pa.array((total[word] > 0).sum() * first, pa.int64()),
        }
    )


def _corpus_counts(asked: DataFrame, owners: int, depth: int, fan_bits: int, level: int = 1) -> tuple[DataFrame, DataFrame]:
    """(range, owner, totals) for all messages, and the stored answers at the top of the tree."""
    if level >= depth:
        top = stored(asked.groupBy("range").applyInArrow(_answer, _ANSWER))
        return top, top
    groups = -(-owners >> fan_bits) or 1
    joined = asked.withColumn("group", F.pmod(F.xxhash64("owner"), F.lit(groups)))

    def merge(rows: pa.Table) -> pa.Table:
        names, total, _ = _added(rows)
        return pa.Table.from_batches([_messages(rows["group"][0].as_py(), names, total, fan_bits * (level + 1))])

    def spread(rows: pa.Table, answers: pa.Table) -> pa.Table:
        places = _added(rows)[2]
        total = np.concatenate([_unplanes(x.as_py(), np.int64) for x in answers.sort_by("range")["totals"]])
        return pa.table({"range": rows["range"], "owner": rows["owner"], "totals": pa.array([_planes(total[p]) for p in places], pa.binary())})

    merged = stored(joined.groupBy("range", "group").applyInArrow(merge, _MESSAGE))
    above, top = _corpus_counts(merged, groups, depth, fan_bits, level + 1)
    above = above.select((F.shiftright("range", fan_bits)).alias("parent"), "range", F.col("owner").alias("group"), "totals")
    down = joined.groupBy("range", "group").cogroup(above.groupBy("parent", "group"))
    return stored(down.applyInArrow(spread, "range long, owner long, totals binary")), top


class _Block:
    """Tokens of a block and its different n-grams."""

    def __init__(self, row: pa.Table):
        self.owner = row["block"][0].as_py()
        sizes, trains = (np.array(row[name][0].values.to_numpy(zero_copy_only=False)) for name in ("sizes", "trains"))
        self.trains = trains.astype(bool)
        self.learns = np.repeat(self.trains, sizes)
        words = np.cumsum(_unplanes(row["vocabulary"][0].as_py(), U64), dtype=U64)
        self.tokens = _unplanes(row["tokens"][0].as_py(), "<u4").astype(np.int64)
        self.n_words = len(words)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        # The token before a token; before a text's first, the state in which texts start.
        self.before = np.concatenate([[self.n_words], self.tokens[:-1]])
        self.before[self.starts] = self.n_words
        pairs, self.pair = np.unique(self.before * (self.n_words + 1) + self.tokens, return_inverse=True)
        self.context, self.target = np.divmod(pairs, self.n_words + 1)
        self.names = np.append(words, _START)
        self.two = mix(self.names[self.context] * _SPREAD ^ mix(self.names[self.target])) & ~U64(1)

    def low(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and training counts of the block's words, the start state, and its bigrams."""
        words = np.bincount(self.tokens[self.learns], minlength=self.n_words)
        return np.concatenate([mix(self.names) | U64(1), self.two]), np.concatenate([words, [self.trains.sum()], np.bincount(self.pair[self.learns], minlength=len(self.two))])

    def high(self, arcs: np.ndarray, min_seen: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for trigrams that can be arcs, then for their contexts; ``arcs`` are the bigrams' corpus counts."""
        often = arcs >= min_seen
        at = np.arange(1, len(self.tokens))
        self.at = at = at[often[self.pair[at - 1]] & (self.before[at] != self.n_words)]
        self.contexts, self.which = np.unique(self.pair[at - 1], return_inverse=True)
        self.can = often[self.pair[at]]
        triples, self.triple = np.unique(self.pair[at - 1][self.can] * len(self.two) + self.pair[at][self.can], return_inverse=True)
        left, right = np.divmod(triples, max(len(self.two), 1))
        self.n_triples = len(triples)
        learns = self.learns[at]
        counts = [np.bincount(self.triple[learns[self.can]], minlength=len(triples)), np.bincount(self.which[self.can & learns], minlength=len(self.contexts))]
        keys = [mix(self.two[left] * _SPREAD ^ mix(mix(self.names[self.target[right]]))), mix(self.two[self.contexts] ^ _SPREAD)]
        return np.concatenate(keys) & ~U64(1), np.concatenate(counts)


def _ask(block: _Block, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    order = np.argsort(keys)
    return _messages(block.owner, keys[order], counts[order].astype(np.int64), bits)


def _heard(keys: np.ndarray, answers: pa.Table, turn: int) -> np.ndarray:
    """Corpus counts of hashes in the order given, from the answers to :func:`_ask`."""
    got = answers.filter(pa.compute.equal(answers["turn"], turn)).sort_by("range")["totals"]
    out = np.zeros(len(keys), np.int64)
    if len(keys):
        out[np.argsort(keys)] = np.concatenate([_unplanes(x.as_py(), np.int64) for x in got])
    return out


def _traverse(block: _Block, low: np.ndarray, high: np.ndarray, tokens: int, types: int, strengths: tuple[float, float]):
    """Per text: known tokens, base score, score."""
    n = block.n_words
    words, ones, arcs = low[:n], low[: n + 1], low[n + 1 :]
    triples, twos = high[: block.n_triples], high[block.n_triples :]
    root_arc = np.log10((words + 1) / (tokens + types + 1))
    lower = strengths[0] * (words[block.target] + 1) / (tokens + types + 1)
    # A state of one token: its own arc for the next, else its failure arc to the root and the root's arc.
    fails = np.log10(strengths[0] / (ones + strengths[0]))
    p_two = (arcs + lower) / (ones[block.context] + strengths[0])
    step = np.where(arcs > 0, np.log10(p_two), fails[block.context] + root_arc[block.target])[block.pair]
    # The state carried to a token is the longest read that has arcs: two tokens here, one token elsewhere.
    carried = twos[block.which] > 0
    at, state = block.at[carried], twos[block.which[carried]]
    own = np.zeros(len(block.at), np.int64)
    own[block.can] = triples[block.triple]
    own = own[carried]
    by_arc = np.log10((own + strengths[1] * p_two[block.pair[at]]) / (state + strengths[1]))
    step[at] = np.where(own > 0, by_arc, np.log10(strengths[1] / (state + strengths[1])) + step[at])
    return (np.add.reduceat(x, block.starts) for x in ((words[block.tokens] > 0).astype(np.int64), root_arc[block.tokens], step))


def score(
    docs: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", strengths: tuple[float, float] = STRENGTHS, min_seen: int = MIN_SEEN, sizes: Sizes = Sizes()
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Rows where ``learns`` is true (null: true) give the counts; every row is scored.  A null or empty text
    is one end token.  Rows with a null or repeated key are texts like any other.
    """
    key_type = docs.schema[key].dataType
    shape = StructType(
        [
            StructField("block", LongType()),
            StructField("keys", ArrayType(key_type)),
            StructField("trains", ArrayType(BooleanType())),
            StructField("sizes", ArrayType(IntegerType())),
            StructField("vocabulary", BinaryType()),
            StructField("tokens", BinaryType()),
            StructField("n_tokens", LongType()),
        ]
    )
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(learns, F.lit(True)).alias("learns"), F.col(text).alias("text"))
    blocks = stored(narrow.mapInArrow(lambda batches: _blocks(batches, sizes.block_bytes), shape))
    size = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("blocks")).first()
    depth = 1
    while size["tokens"] >> (sizes.fan_bits * depth) > sizes.range_tokens:
        depth += 1
    narrow = blocks.drop("keys", "n_tokens")

    def ask_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Block(pa.Table.from_batches([batch.slice(row, 1)]))
                yield _ask(block, *block.low(), sizes.fan_bits)

    def ask_high(left: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(left)
        low = _heard(block.low()[0], answers, 1)
        return pa.Table.from_batches([_ask(block, *block.high(low[block.n_words + 1 :], min_seen), sizes.fan_bits)])

    def turn(number: int, answers: DataFrame) -> DataFrame:
        return answers.select(F.lit(number).alias("turn"), "range", "owner", "totals")

    found, top = _corpus_counts(narrow.mapInArrow(ask_low, _MESSAGE), size["blocks"], depth, sizes.fan_bits)
    known = top.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("train_tokens", "train_types")]).first()
    tokens, types = known["train_tokens"], known["train_types"]
    answered = turn(1, found)
    asked = narrow.groupBy("block").cogroup(answered.groupBy("owner")).applyInArrow(ask_high, _MESSAGE)
    # Used twice where the tree has more than one level.
    asked = stored(asked) if depth > 1 else asked
    answered = answered.unionAll(turn(2, _corpus_counts(asked, size["blocks"], depth, sizes.fan_bits)[0]))
    out = StructType(
        [StructField(key, key_type), StructField("held_out", BooleanType())]
        + [StructField(c, LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [StructField(c, DoubleType()) for c in ("base_score", "score")]
    )

    def scored(left: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(left)
        low = _heard(block.low()[0], answers, 1)
        high = _heard(block.high(low[block.n_words + 1 :], min_seen)[0], answers, 2)
        known, base, own = _traverse(block, low, high, tokens, types, strengths)
        lengths, trains = left["sizes"][0].values, left["trains"][0].values
        return pa.table(
            [
                left["keys"][0].values,
                pa.compute.invert(trains),
                lengths.cast(pa.int64()),
                pa.array(known, pa.int64()),
                pa.array(np.full(len(lengths), tokens), pa.int64()),
                pa.array(base),
                pa.array(own),
            ],
            names=[f.name for f in out],
        )

    return blocks.drop("n_tokens").groupBy("block").cogroup(answered.groupBy("owner")).applyInArrow(scored, out)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; those whose crc32(doc_id as text) mod 7 is 2 are held out."""
    learns = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    return score(table(spark, sf_dir, "documents"), learns)
