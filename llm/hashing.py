"""Words of a column of texts as 64-bit hashes, one numpy pass per piece of text.

A word is a run of bytes other than space and 0x09-0x0D.  The functions work on
the bytes Arrow holds, so no Python object is made per word.  Two different
words have the same hash with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(salt))


def pieces(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of consecutive slices of about ``most`` bytes; a longer text is a slice of its own."""
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        yield first, texts.slice(first, last - first)
        first = last


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins (with the end); a null is empty."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = texts.buffers()[2]
    size = int(at[-1] - at[0])
    body = np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8)
    return body, at - at[0]


def word_bounds(body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and for each text the number of its first word (with the end)."""
    n = len(body)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~_SPACE[body]
    begins, ends = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begins[cuts] = solid[1:-1][cuts]
    ends[cuts - 1] = solid[1:-1][cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def span_hash(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of each span of bytes, eight bytes of all spans at a time."""
    size = ends - starts
    out = mix(size.astype(U64) + U64(salt + 1))
    if not len(starts):
        return out
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(body) + 1,), "<u8", padded.data, strides=(1,))
    out = mix(out ^ (eights[starts] & _MASK[np.minimum(size, 8)]))
    left = np.flatnonzero(size > 8)
    done = 8
    while len(left):
        part = eights[starts[left] + done] & _MASK[np.minimum(size[left] - done, 8)]
        out[left] = mix(out[left] * U64(0x9E3779B97F4A7C15) + part)
        done += 8
        left = left[size[left] > done]
    return out


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and for each text the number of its first word (with the end)."""
    body, at = raw(texts)
    if lower:
        body = _LOWER[body]
    starts, ends, first = word_bounds(body, at)
    return span_hash(body, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text; a text with fewer words gives its whole sequence.

    Returns the hashes and for each text the number of its first one (with the end).
    """
    count = np.diff(first)
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(made)])
    if not at[-1]:
        return np.zeros(0, U64), at
    owner = np.repeat(np.arange(len(count)), made)
    begin = np.arange(at[-1]) - at[owner] + first[owner]
    length = np.minimum(count, size)[owner]
    out = mix(length.astype(U64))
    last = len(words) - 1
    for k in range(size):
        step = mix(out * U64(0x9E3779B97F4A7C15) + words[np.minimum(begin + k, last)])
        out = step if k == 0 else np.where(k < length, step, out)
    return out, at
