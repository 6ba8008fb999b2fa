"""Packing of token sequences by bin completion, branch and bound over the histogram of piece lengths, from a best-fit incumbent."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from llm.hashing import pieces
from llm.pretokens import ChunkEncoder
from llm.tables import bucket_count, ranked, set_aside, stored, table

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
#: Steps of one bin's completion search; the best filling found so far is used beyond it.
SEARCH_STEPS = 20_000
#: Steps of the search across bins, and of the fillings of one bin in it; the best packing so far is used beyond the first.
BRANCH_STEPS, FILLING_STEPS = 200_000, 1_000


@cache
def _encoder(vocabulary: str) -> ChunkEncoder:
    """Texts -> little-endian ids.

    The same vocabulary read by tiktoken: equal ids (tested over all code points), six times faster.
    Chunks that white space does not end are encoded in one string, cut again by the tokens' bytes.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = list(map(len, ranks))

    def encode(texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        joined = []
        for i, text in enumerate(texts):
            if text[:1] == " " and not text[-1:].isspace():
                joined.append(i)
            else:
                out[i] = np.array(encoding.encode_ordinary(text), "<u4").tobytes()
        ids = np.array(encoding.encode_ordinary("".join([texts[i] for i in joined])), "<u4")
        ends = np.searchsorted(np.cumsum(sizes[ids]), np.cumsum([len(texts[i].encode()) for i in joined]), "left") + 1
        data, at = ids.tobytes(), 0
        for i, end in zip(joined, (4 * ends).tolist()):
            out[i] = data[at:end]
            at = end
        return out

    return ChunkEncoder(encode)


def token_pieces(docs: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: the keys, ``piece``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit).

    A text's ids are those of the tokenizer and then ``end_id``; a null text is empty.  Only sequences
    longer than ``capacity`` are cut; the first piece takes what full pieces leave over.
    """
    schema = StructType([docs.schema[k] for k in keys] + [StructField(n, t) for n, t in (("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids", BinaryType()))])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in batches:
            for first, texts in pieces(batch.column(len(keys))):
                rows, out = [], []
                for i, ids in enumerate(encode([t or "" for t in texts.to_pylist()])):
                    ids += end
                    count = len(ids) // 4
                    at = [0, *range(count % capacity or capacity, count, capacity), count]
                    for piece, (a, b) in enumerate(zip(at, at[1:])):
                        rows.append(first + i)
                        out.append((piece, a, b - a, ids[4 * a : 4 * b]))
                taken = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(keys))]
                columns = zip(*out) if out else ([], [], [], [])
                made = [pa.array(list(c), t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(taken + made, names=[f.name for f in schema])

    return docs.select(*keys, text).mapInArrow(cut, schema)


def best_fit(room: int, counts: np.ndarray) -> list[int]:
    """The largest length that fits, again and again."""
    taken = []
    for n in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        copies = min(int(counts[n]), room // n)
        taken += [n] * copies
        room -= copies * n
    return taken


def complete(room: int, counts: np.ndarray, steps: int = SEARCH_STEPS) -> list[int]:
    """Lengths, largest first, that fill ``room`` with the least waste out of what ``counts`` holds.

    Branch and bound from the best-fit filling as the incumbent: larger items and more copies first, so
    of equal fillings the one with larger items, which dominates, is met first.  A branch is left when
    all it can still hold would not beat the incumbent; no waste ends the search, as do ``steps`` tries.
    """
    best = best_fit(room, counts)
    best_sum, taken = sum(best), []
    have = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    held = [n * int(counts[n]) for n in have]
    rest = np.concatenate([np.cumsum(held[::-1])[::-1], [0]]).tolist()

    def search(index: int, room: int, total: int) -> None:
        nonlocal best, best_sum, steps
        if total > best_sum:
            best, best_sum = list(taken), total
        for k in range(index, len(have)):
            n = have[k]
            for copies in range(min(int(counts[n]), room // n), 0, -1):
                if total + min(room, rest[k]) <= best_sum or steps <= 0:
                    return
                steps -= 1
                taken.extend([n] * copies)
                search(k + 1, room - copies * n, total + copies * n)
                del taken[len(taken) - copies :]

    if best_sum < room:
        search(0, room, 0)
    return best


def completions(histogram: dict[int, int], capacity: int = CAPACITY, search: bool = True) -> list[tuple[list[int], int]]:
    """Patterns (lengths, largest first) and how many sequences use each.

    The sequence around the largest piece left is completed, and the pattern is used as often as the
    counts allow, so every pattern exhausts a length: there are at most ``capacity`` steps whatever the
    number of pieces.  ``search=False`` gives plain best fit.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out = []
    for largest in range(capacity, 0, -1):
        while counts[largest]:
            counts[largest] -= 1
            room = capacity - largest
            pattern = [largest, *(complete(room, counts) if search else best_fit(room, counts))]
            counts[largest] += 1
            need = np.bincount(pattern, minlength=capacity + 1)
            used = np.flatnonzero(need)
            times = int((counts[used] // need[used]).min())
            counts -= need * times
            out.append((pattern, times))
    return out


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound: all tokens over the capacity, or what pieces over half of it leave for those of at least k tokens."""
    n = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * n)
    half, bound = capacity // 2, -(-int(total[-1]) // capacity)
    for k in range(1, half + 1):
        over, fits = int(number[-1] - number[half]), int(number[capacity - k] - number[half])
        free = fits * capacity - int(total[capacity - k] - total[half])
        small = int(total[half] - total[k - 1])
        bound = max(bound, over + max(0, -(-(small - free) // capacity)))
    return bound


def _dominated(filling: list[int], waste: int, counts: np.ndarray) -> bool:
    """Whether one piece left over is longer than up to three of the filling, or as long as two or three, and fits for them."""
    left = counts.copy()
    np.subtract.at(left, filling, 1)
    for size in range(min(3, len(filling)) + 1):
        for some in set(combinations(filling, size)):
            total = sum(some)
            if left[total + (size < 2) : total + waste + 1].any():
                return True
    return False


def fillings(room: int, counts: np.ndarray, waste: int, steps: int = FILLING_STEPS) -> tuple[list[list[int]], int]:
    """Undominated fillings of ``room`` that waste at most ``waste``, least waste first, and the steps taken."""
    have = np.flatnonzero(counts[: room + 1])[::-1].tolist()
    held = [n * int(counts[n]) for n in have]
    rest = np.concatenate([np.cumsum(held[::-1])[::-1], [0]]).tolist()
    found, used, taken = [], 0, []

    def search(index: int, room: int) -> None:
        nonlocal used
        if room <= waste:
            found.append((room, list(taken)))
        for k in range(index, len(have)):
            n = have[k]
            for copies in range(min(int(counts[n]), room // n), 0, -1):
                if room - min(room, rest[k]) > waste or used >= steps:
                    return
                used += 1
                taken.extend([n] * copies)
                search(k + 1, room - copies * n)
                del taken[len(taken) - copies :]

    search(0, room)
    found.sort(key=lambda f: f[0])
    return [f for w, f in found if not _dominated(f, w, counts)], used + 1


def branch(histogram: dict[int, int], incumbent: list[tuple[list[int], int]], capacity: int = CAPACITY, steps: int = BRANCH_STEPS) -> list[tuple[list[int], int]]:
    """The incumbent or a packing of fewer sequences: bin completion, branch and bound across bins.

    The bin of the largest piece left branches over its undominated fillings, each used as often as the counts allow and
    then fewer times.  A branch is left when its waste so far, with what is left packed without any, does not beat the
    incumbent.  Branches with few departures from the first choice come first; the bound met, nothing
    left to try, or ``steps`` end the search.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    best, best_bins = incumbent, sum(times for _, times in incumbent)
    bound, total = least_sequences(counts, capacity), int((counts * np.arange(capacity + 1)).sum())

    def choices(counts: np.ndarray, spare: int) -> Iterator[tuple[list[int], int, np.ndarray]]:
        nonlocal steps
        largest = int(np.flatnonzero(counts)[-1])
        counts[largest] -= 1
        found, used = fillings(capacity - largest, counts, min(spare, capacity - largest), min(FILLING_STEPS, steps))
        counts[largest] += 1
        steps -= used
        uses = []
        for filling in found:
            need = np.bincount([largest, *filling], minlength=capacity + 1)
            at = np.flatnonzero(need)
            uses.append(([largest, *filling], need, int((counts[at] // need[at]).min())))
        yield from ((pattern, most, need) for pattern, need, most in uses)
        for less in range(1, max((most for _, _, most in uses), default=0)):
            yield from ((pattern, most - less, need) for pattern, need, most in uses if most > less)

    turns = 0
    while best_bins > bound and steps > 0:
        # One level a bin pattern: counts left, waste so far, turns left, choices not yet tried.
        seen: dict[bytes, list[tuple[int, int]]] = {}
        cut = False
        path: list[tuple[list[int], int]] = []
        level = [(counts, 0, turns, choices(counts, (best_bins - 1) * capacity - total))]
        ranks = [0]
        while level and best_bins > bound and steps > 0:
            left, waste, more, rest = level[-1]
            chosen = next(rest, None)
            if chosen is not None and ranks[-1] > more:
                cut, chosen = True, None
            if chosen is None:
                level.pop()
                ranks.pop()
                if path:
                    path.pop()
                continue
            pattern, times, need = chosen
            more_, ranks[-1], steps = more - ranks[-1], ranks[-1] + 1, steps - 1
            wasted = waste + times * (capacity - sum(pattern))
            spare = (best_bins - 1) * capacity - total - wasted
            if spare < 0:
                continue
            after = left - need * times
            if not after.any():
                best, best_bins = [*path, (pattern, times)], sum(t for _, t in path) + times
                continue
            key = hashlib.md5(after.tobytes()).digest()
            if any(w <= wasted and m >= more_ for w, m in seen.get(key, [])):
                continue
            seen.setdefault(key, []).append((wasted, more_))
            path.append((pattern, times))
            level.append((after, wasted, more_, choices(after, spare)))
            ranks.append(0)
        if not cut:
            break
        turns = 2 * turns + 1
    return best


def best_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bin completion by branch and bound; its incumbent is the better of least waste bin by bin and plain best fit."""
    found = [completions(histogram, capacity, search) for search in (True, False)]
    return branch(histogram, min(found, key=lambda patterns: sum(times for _, times in patterns)), capacity)


#: Names that ``pack`` uses on its way; columns of the caller that have one keep it.
_OWN = ["length_p", "from_", "to_", "each_", "first_", "offset_", "rank", "rank_of"]


def pack(piece_rows: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces with ``length``.

    The driver sees the histogram of lengths only (``capacity`` rows at most).  Pieces of a length are
    ranked in the cluster and meet the places the patterns have for that length; a pattern has at most
    ``sqrt(2 * capacity)`` different lengths, so the broadcast table of places has a bounded number of rows.
    """
    spark = piece_rows.sparkSession
    piece_rows, renamed = set_aside(piece_rows, _OWN)
    keys = [renamed.get(k, k) for k in keys]
    histogram = {r["length"]: r["count"] for r in piece_rows.groupBy("length").count().collect()}
    places, first_sequence, used = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in best_patterns(histogram, capacity):
        offset = 0
        for length in dict.fromkeys(pattern):
            each = pattern.count(length)
            places.append((length, used[length], used[length] + each * times, each, first_sequence, offset))
            used[length] += each * times
            offset += each * length
        first_sequence += times
    place = spark.createDataFrame(places, "length_p long, from_ long, to_ long, each_ long, first_ long, offset_ long")
    buckets = bucket_count(sum(histogram.values()))
    order = [F.col(c) for c in keys]
    by_length = ranked(piece_rows, ["length"], F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"), order)
    inside = F.col("rank") - F.col("from_")
    return (
        by_length.join(F.broadcast(place), (F.col("length") == F.col("length_p")) & (F.col("rank") >= F.col("from_")) & (F.col("rank") < F.col("to_")))
        .withColumn("sequence_id", F.col("first_") + F.floor(inside / F.col("each_")))
        .withColumn("offset", F.col("offset_") + F.pmod(inside, F.col("each_")) * F.col("length"))
        .drop("length_p", "from_", "to_", "each_", "first_", "offset_", "rank", "rank_of")
        .withColumnsRenamed({new: old for old, new in renamed.items()})
    )


def packed_documents(docs: DataFrame) -> DataFrame:
    """Documents as placed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The pieces with their ids are stored once; placing reads their narrow columns only.  Rows with equal
    doc_id are separate documents, told apart by the checksum of their ids.  Null ids are kept.
    """
    made = stored(token_pieces(docs))
    narrow = stored(made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return pack(narrow, ["doc_id", "piece", "ids_crc32"])


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))
