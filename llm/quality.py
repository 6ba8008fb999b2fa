"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from llm.hashing import U64, mix, pieces, raw, shingle_hashes, span_hash, word_bounds
from llm.tables import stored, table

_FLAG = np.zeros((5, 256), bool)
_FLAG[0, 0x80:0xC0] = True  # bytes that continue a code point
_FLAG[1, list(b"[#*$%&|<>]"[1:-1])] = True
_FLAG[2, list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_FLAG[3, list(b"abcdefghijklmnopqrstuvwxyz")] = True
_FLAG[4, list(b".!?:;\"')")] = True

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bangs", "n_unique_words", "n_symbol_words"]
STATS_TYPE = StructType([StructField(name, LongType()) for name in STATS])


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags stand in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])


def _equal_before(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per element: an equal one stands before it in its text; an equal one stands anywhere else in it."""
    key = mix(hashes ^ mix(owner.astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    before, twice = np.empty(len(key), bool), np.empty(len(key), bool)
    before[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return before, twice


def _stats(texts: pa.Array) -> list[np.ndarray]:
    body, at = raw(texts)
    starts, ends, first = word_bounds(body, at)
    n_words = np.diff(first)
    docs = np.arange(len(at) - 1)
    words = span_hash(body, starts, ends)
    owner = np.repeat(docs, n_words)
    letters = np.concatenate([[0], np.cumsum(~_FLAG[0][body], dtype=np.int64)])
    word_chars = np.add.reduceat(np.append(letters[ends] - letters[starts], 0), first[:-1]) * (n_words > 0) if len(docs) else n_words

    # Lines with a word: between the breaks, and texts begin lines as well.
    breaks = np.flatnonzero(body == 10)
    line_start = np.unique(np.concatenate([at[:-1][np.diff(at) > 0], breaks + 1]))
    line_start = line_start[line_start < len(body)]
    line_end = np.append(line_start[1:], len(body))
    line_end = line_end - (body[line_end - 1] == 10) if len(line_start) else line_end
    holds = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[holds], line_end[holds]
    line_owner = np.searchsorted(at, line_start, "right") - 1
    n_lines = np.bincount(line_owner, minlength=len(docs))
    again, _ = _equal_before(span_hash(body, line_start, line_end), line_owner)

    runs, run_at = shingle_hashes(words, first, 3)
    run_owner = np.repeat(docs, np.diff(run_at))
    whole = n_words[run_owner] >= 3  # a shorter text has no window of three words
    _, twice = _equal_before(runs, run_owner)
    begin = (np.arange(len(runs)) - run_at[run_owner] + first[run_owner])[twice & whole]
    covered = np.zeros(len(words) + 2, bool)
    for k in range(3):
        covered[begin + k] = True
    seen, _ = _equal_before(words, owner)

    per_word = lambda flags: np.bincount(owner[flags], minlength=len(docs))
    return [
        n_words,
        word_chars,
        _per_text(_FLAG[1][body], at),
        np.bincount(line_owner[again], minlength=len(docs)),
        per_word(covered[: len(words)]),
        n_lines,
        _per_text(_FLAG[2][body], at),
        _per_text(_FLAG[3][body], at),
        per_word((body[ends - 1] == 33) & (body[np.maximum(ends - 2, 0)] == 33)) if len(words) else n_words * 0,
        n_words - per_word(seen),
        per_word(_FLAG[1][body[starts]] | _FLAG[1][body[ends - 1]]),
    ]


@arrow_udf(STATS_TYPE)
def text_stats(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The counts in STATS for each text; a null text counts as empty."""
    for batch in texts:
        parts = [_stats(part) for _, part in pieces(batch)]
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*parts)] or [np.zeros(0, np.int64)] * len(STATS)
        yield pa.StructArray.from_arrays([pa.array(c) for c in columns], names=STATS)


#: Rule -> (the text is bad, the text is good); neither is an abstention.  Bounds are shares.
#: n: STATS columns, all integers; products instead of ratios keep the votes exact.
RULES = {
    "length": ("n_words < 50", "n_words >= 100"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 15 * n_words", "word_chars between 3 * n_words and 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "symbol_share": ("20 * n_symbols > word_chars", "200 * n_symbols <= word_chars"),
    "marked_words": ("5 * n_symbol_words > n_words", "50 * n_symbol_words <= n_words"),
    "duplicate_lines": ("2 * n_dup_lines > n_lines", "n_dup_lines = 0 and n_lines > 1"),
    "repeated_words": ("100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    "capitals": ("2 * n_upper > n_lower", "10 * n_upper <= n_lower"),
    "shouting": ("10 * n_bangs > n_words", "100 * n_bangs <= n_words"),
    "vocabulary": ("n_words >= 100 and 5 * n_unique_words < n_words", "4 * n_unique_words >= n_words"),
}
#: The rule every document has to pass besides (``base_failed``).
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def votes(stats: str) -> Column:
    """One character per rule: ``-`` bad, ``+`` good, ``0`` abstains; ``stats`` is a struct column."""
    one = "case when {} then '-' when {} then '+' else '0' end"
    prefixed = lambda rule: _prefix(rule, stats)
    return F.concat(*[F.expr(one.format(prefixed(bad), prefixed(good))) for bad, good in RULES.values()])


def _prefix(rule: str, stats: str) -> str:
    return " ".join(f"{stats}.{word}" if word in STATS else word for word in rule.split())


@dataclass(frozen=True)
class VoteModel:
    """Log-odds of good quality: ``bias`` plus one weight per rule and vote, in the order bad, abstain, good."""

    bias: float
    weights: list[list[float]]

    def posterior(self, pattern: str) -> float:
        odds = self.bias + sum(w["-0+".index(v)] for w, v in zip(self.weights, pattern))
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def learn(patterns: dict[str, int], rounds: int = 200) -> VoteModel:
    """Weigh the rules by expectation-maximisation over the counts of vote patterns.

    Two classes; given the class, rules vote independently with class-wise rates of bad, abstain and
    good, smoothed by one vote each.  Starts from all-must-pass at 0.9, which the estimates then replace.
    There are at most
    ``3 ** len(RULES)`` patterns whatever the number of documents.
    """
    keys = sorted(patterns)
    cast = np.array([["-0+".index(v) for v in key] for key in keys], np.int64).reshape(len(keys), len(RULES))
    weight = np.array([patterns[k] for k in keys], float)
    one_hot = (cast[:, :, None] == np.arange(3)).astype(float)
    margin = (cast - 1).sum(1)
    good = np.where((cast == 0).any(1), 0.1, 0.9)
    for _ in range(rounds):
        prior, rates = [], []
        for share in (1 - good, good):
            rate = np.einsum("p,prv->rv", weight * share, one_hot) + 1
            rates.append(np.log(rate / rate.sum(1, keepdims=True)))
            prior.append(math.log((weight * share).sum() + 1))
        bias, weights = prior[1] - prior[0], rates[1] - rates[0]
        new = 1 / (1 + np.exp(-np.clip(bias + np.einsum("prv,rv->p", one_hot, weights), -500, 500)))
        moved, good = np.abs(new - good).max(initial=0), new
        if moved < 1e-9:
            break
    # Classes have no names of their own: the good one is the one with more good votes.
    mean = [np.average(margin, weights=weight * share) if (weight * share).sum() > 0 else 0 for share in (1 - good, good)]
    sign = -1 if mean[1] < mean[0] else 1
    return VoteModel(sign * bias, (sign * weights).tolist())


def fit(stats: DataFrame, column: str = "stats") -> VoteModel:
    """The model from the votes of all rows; the driver gets the counts of patterns only."""
    rows = stats.groupBy(votes(column).alias("votes")).count().collect()
    return learn({r["votes"]: r["count"] for r in rows})


def quality(model: VoteModel, column: str = "stats") -> Column:
    """Posterior probability of good quality given a row's votes."""
    odds = F.lit(model.bias)
    for (bad, good), (w_bad, w_none, w_good) in zip(RULES.values(), model.weights):
        odds = odds + F.when(F.expr(_prefix(bad, column)), w_bad).when(F.expr(_prefix(good, column)), w_good).otherwise(w_none)
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, ``stats``, ``votes``, ``base_failed``, ``quality``, ``kept`` for each row.

    Null and empty texts have no words and fail the base rule.  Repeated rows are judged alike, each
    on its own.  An empty table gives an empty result.
    """
    if set(keys) & {"stats", "votes", "base_failed", "quality", "kept"}:
        raise ValueError("a key has the name of a result column; rename it")
    stats = stored(docs.select(*keys, text_stats(text).alias("stats")))
    good = quality(fit(stats))
    failed = F.expr(_prefix(BASE_FAILED, "stats"))
    return stats.select(*keys, "stats", votes("stats").alias("votes"), failed.alias("base_failed"), good.alias("quality"), (~failed & (good >= 0.5)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass; the votes are counted in one pass and applied in a second, without a shuffle of texts."""
    name = "stats__"
    while name in docs.columns:
        name += "_"
    with_stats = docs.withColumn(name, text_stats(text))
    model = fit(with_stats.select(name), name)
    return with_stats.where(~F.expr(_prefix(BASE_FAILED, name)) & (quality(model, name) >= 0.5)).drop(name)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, the base rule and the verdict for all documents."""
    found = judged(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", *[F.col("stats")[s].alias(s) for s in STATS[:5]], "base_failed", "kept", "quality", "votes")
