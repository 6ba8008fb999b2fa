"""Quality scores from a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse row x: its words hashed into buckets (log counts, unit length), then statistics of its
structure and the table's character count, standardised.  The machine's logit is
w0 + w.x + (|xV|^2 - sum_i x_i^2 |v_i|^2) / 2, so all pairwise interactions cost no more than the row's
own entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.hashing import _LOWER, mix, pieces, raw, shingle_hashes, span_hash, word_bounds
from llm.tables import table

#: Buckets for words, and the bound of the sample the machine is fitted on.
WORDS, SAMPLE = 1 << 12, 8192
FACTORS, EPOCHS, BATCH, RATE, DECAY = 8, 12, 64, 0.01, 1e-4
#: predicted is 1 from this score on.
THRESHOLD = 0.3
_CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#*$%&|<>", "!?", ".", ",;:", "()[]{}\"'`", "@/\\_=+~^-", "\n"]
STATISTICS = len(_CLASSES) + 10


@dataclass
class Rows:
    """Sparse word values (row after row) and dense statistics of some texts."""

    begins: np.ndarray
    buckets: np.ndarray
    values: np.ndarray
    dense: np.ndarray


def features(texts: pa.Array, n_chars: np.ndarray) -> Rows:
    """``n_chars`` is the table's own count, NaN where it has none."""
    body, at = raw(texts)
    rows = len(texts)
    starts, ends, first = word_bounds(body, at)
    count = np.diff(first)
    owner = np.repeat(np.arange(rows), count)
    words = span_hash(_LOWER[body], starts, ends)
    key, tf = np.unique(owner * WORDS + (words >> np.uint64(40)).astype(np.int64) % WORDS, return_counts=True)
    row, bucket = key // WORDS, key % WORDS
    begins = np.searchsorted(row, np.arange(rows + 1))
    value = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, value * value, rows))
    value = value / np.maximum(norm, 1e-12)[row]

    size = np.maximum(np.diff(at), 1)
    kinds = np.full(256, len(_CLASSES), np.uint8)
    for k, chars in enumerate(_CLASSES):
        kinds[[ord(c) for c in chars]] = k
    kind = kinds[body]
    shares = []
    for k in range(len(_CLASSES)):
        upto = np.concatenate([[0], np.flatnonzero(kind == k)])
        shares.append((np.searchsorted(upto[1:], at[1:]) - np.searchsorted(upto[1:], at[:-1])) / size)
    many = np.maximum(count, 1)
    distinct = np.diff(begins)
    most = np.zeros(rows)
    np.maximum.at(most, row, tf)
    same = np.zeros(rows)
    if len(words) > 1:
        again = np.flatnonzero((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
        same = np.bincount(owner[again], minlength=rows)
    threes, three_at = shingle_hashes(words, first, 3)
    three_owner = np.repeat(np.arange(rows), np.diff(three_at))
    _, inverse, copies = np.unique(mix(threes + mix(three_owner.astype(np.uint64))), return_inverse=True, return_counts=True)
    repeated = np.bincount(three_owner[copies[inverse] > 1], minlength=rows)
    length = np.bincount(owner, ends - starts, rows)
    ended = np.bincount(owner, kind[ends - 1] == 3, rows) if len(ends) else np.zeros(rows)
    shouted = np.bincount(owner, (kind[starts] == 0) & (kind[np.minimum(starts + 1, ends - 1)] == 0), rows) if len(ends) else np.zeros(rows)
    dense = np.stack(
        [
            *shares,
            np.log1p(count),
            length / many,
            distinct / many,
            most / many,
            same / many,
            repeated / np.maximum(np.diff(three_at), 1),
            ended / many,
            shouted / many,
            np.log1p(np.maximum(np.nan_to_num(n_chars), 0)),
            np.isnan(n_chars),
        ],
        1,
    )
    return Rows(begins, bucket, value, dense)


@dataclass
class Machine:
    """Weights of a fitted factorisation machine; ``centre`` and ``spread`` standardise the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.centre) / self.spread, -4, 4)

    def scores(self, x: Rows) -> np.ndarray:
        """Probability of label 1 for each row, in time linear in its entries."""
        dense = self.standard(x.dense)
        w, v = self.weights[:WORDS], self.factors[:WORDS]
        rows = len(dense)
        row = np.repeat(np.arange(rows), np.diff(x.begins))
        linear = np.bincount(row, w[x.buckets] * x.values, rows) + (dense * self.weights[WORDS:]).sum(1)
        pairs = np.zeros(rows)
        for f in range(v.shape[1]):
            part, own = v[x.buckets, f] * x.values, dense * self.factors[WORDS:, f]
            total = np.bincount(row, part, rows) + own.sum(1)
            pairs += total**2 - np.bincount(row, part * part, rows) - (own * own).sum(1)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -30, 30)))


def fit(x: Rows, labels: np.ndarray, seed: int = 13) -> Machine:
    """Logistic loss by Adam on small batches, weights decayed; one class or no rows give its smoothed base rate."""
    rows, size = len(labels), WORDS + STATISTICS
    draw = np.random.default_rng(seed)
    base = float(np.log((labels.sum() + 1) / ((1 - labels).sum() + 1)))
    centre = x.dense.mean(0) if rows else np.zeros(STATISTICS)
    spread = np.maximum(x.dense.std(0), 1e-6) if rows else np.ones(STATISTICS)
    made = Machine(base, np.zeros(size), draw.normal(0, 0.02, (size, FACTORS)), centre, spread)
    if not rows or labels.min() == labels.max():
        made.factors[:] = 0
        return made
    dense = made.standard(x.dense)
    bias = np.array([base])
    held = [bias, made.weights, made.factors]
    first, second = [np.zeros_like(h) for h in held], [np.zeros_like(h) for h in held]
    turn = 0
    for _ in range(EPOCHS):
        order = draw.permutation(rows)
        for at in range(0, rows, BATCH):
            mine = order[at : at + BATCH]
            batch = np.zeros((len(mine), size))
            for k, r in enumerate(mine):
                span = slice(x.begins[r], x.begins[r + 1])
                batch[k, x.buckets[span]] = x.values[span]
            batch[:, WORDS:] = dense[mine]
            total = batch @ made.factors
            square = batch * batch
            logit = bias[0] + batch @ made.weights + (total**2 - square @ (made.factors**2)).sum(1) / 2
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[mine]) / len(mine)
            steps = [
                np.array([error.sum()]),
                batch.T @ error + DECAY * made.weights,
                batch.T @ (error[:, None] * total) - (square.T @ error)[:, None] * made.factors + DECAY * made.factors,
            ]
            turn += 1
            for h, s, m, v in zip(held, steps, first, second):
                m += 0.1 * (s - m)
                v += 0.001 * (s * s - v)
                h -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    made.bias = float(bias[0])
    return made


def _counted(batch: pa.RecordBatch) -> np.ndarray:
    return batch["n_chars"].cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of labelled texts, packed as bytes."""
    for batch in batches:
        n_chars = _counted(batch)
        for begin, texts in pieces(batch["text"]):
            x = features(texts, n_chars[begin : begin + len(texts)])
            cut = lambda a, kind: [a[i:j].astype(kind).tobytes() for i, j in zip(x.begins[:-1], x.begins[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["label"].slice(begin, len(texts)),
                    pa.array(cut(x.buckets, np.uint16), pa.binary()),
                    pa.array(cut(x.values, np.float32), pa.binary()),
                    pa.array([d.tobytes() for d in x.dense], pa.binary()),
                ],
                ["label", "buckets", "values", "dense"],
            )


def _remainder(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` labelled documents, those of the smallest hashes of their keys.

    Held-out documents are never among them.  Several labels of a document are averaged; null labels and
    labels without a document are passed over.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (_remainder(F.col(key)) != 0))
    known = known.groupBy(F.col(key).alias("key_")).agg(F.avg(label).alias("label"))
    chosen = known.join(docs.select(F.col(key).alias("key_")), "key_", "left_semi").orderBy(F.md5(F.col("key_").cast("string")), "key_").limit(sample)
    texts = docs.select(F.col(key).alias("key_"), F.coalesce("text", F.lit("")).alias("text"), F.col("n_chars").cast("long").alias("n_chars"))
    # At most ``sample`` keys, so they can be sent to every task; a key on many rows stays within the bound as well.
    rows = texts.join(F.broadcast(chosen), "key_").orderBy(F.md5(F.col("key_").cast("string")), "key_", F.md5("text")).limit(sample)
    found = rows.select("label", "n_chars", "text").mapInArrow(_sparse, "label double, buckets binary, values binary, dense binary").toArrow()
    buckets = [np.frombuffer(b, np.uint16) for b in found["buckets"].to_pylist()]
    values = [np.frombuffer(b, np.float32) for b in found["values"].to_pylist()]
    dense = np.array([np.frombuffer(b) for b in found["dense"].to_pylist()]).reshape(-1, STATISTICS)
    begins = np.concatenate([[0], np.cumsum([len(b) for b in buckets], dtype=np.int64)]).astype(np.int64)
    join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
    return fit(Rows(begins, join(buckets, np.int64).astype(np.int64), join(values, np.float32), dense), found["label"].to_numpy())


def score(docs: DataFrame, machine: Machine, key: str = "doc_id") -> DataFrame:
    """(``key``, ``held_out``, ``score``, ``predicted``), one row per document, each from its whole text.

    A null text is an empty one; a null character count is a feature of its own.  Other columns, the key,
    language, source and labels among them, are not read for the score.  Repeated rows are scored each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_chars = _counted(batch)
            for begin, texts in pieces(batch["text"]):
                found = machine.scores(features(texts, n_chars[begin : begin + len(texts)]))
                yield pa.RecordBatch.from_arrays([batch["key_"].slice(begin, len(texts)), pa.array(found)], ["key_", "score"])

    rows = docs.select(F.col(key).alias("key_"), F.col("n_chars").cast("long").alias("n_chars"), F.coalesce("text", F.lit("")).alias("text"))
    scored = rows.mapInArrow(work, f"key_ {rows.schema['key_'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("key_").alias(key),
        (_remainder(F.col("key_")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a machine learned from labelled documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
