"""Byte-level BPE in SQL: a recursive DuckDB query per batch of a partition merges token-position rows.

A text is cut by the tokenizer's pattern; each different word becomes rows (word, pos, tok).  A round joins
neighbours with the merge table and contracts each word's leftmost pair of minimum rank, until no pair
is left.  Decoding joins ids with their bytes and aggregates in order.
"""

from __future__ import annotations

import base64
import tempfile
from array import array
from collections.abc import Iterator
from functools import cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from llm.hashing import pieces
from llm.pretokens import ChunkEncoder
from llm.tables import table

VOCABULARY = "byte_bpe_multi_50k"
#: Words of a query, and what is remembered from one batch to the next; both bound memory only.
WORDS, KNOWN = 10_000, 200_000
#: Bytes of long words of a query; a longer word is a query of its own.
LONG_BYTES = 200_000
#: Bytes from which a word's equal pairs are contracted together.
LONG = 64

#: A word is one list; a round unfolds it into token-position rows, joins them with the merge table, and
#: contracts the leftmost pair of minimum rank.  ``key`` is that rank * 65536, so one minimum finds rank and place.
_SHORT = """
WITH RECURSIVE step AS (
  SELECT 0::SMALLINT AS round, word, list(tok ORDER BY pos) AS toks FROM start GROUP BY word
  UNION ALL
  SELECT s.round + 1, s.word, list_concat(list_append(list_slice(s.toks, 1, p.at - 1), p.merged), list_slice(s.toks, p.at + 2, len(s.toks)))
  FROM step s JOIN (
    SELECT word, (min(key) & 65535)::INT AS at, (min(key) >> 16)::INT AS merged FROM (
      SELECT n.word, m.key + n.pos AS key FROM (
        SELECT word, unnest(list_slice(toks, 1, len(toks) - 1)) AS tok, unnest(list_slice(toks, 2, len(toks))) AS next_tok, unnest(range(1, len(toks))) AS pos
        FROM step WHERE len(toks) > 1
      ) n JOIN merges m ON m.pair = n.tok::BIGINT * 65536 + n.next_tok
    ) GROUP BY word
  ) p ON p.word = s.word
)
SELECT word, arg_max(toks, round) AS ids FROM step GROUP BY word ORDER BY word
"""
#: The same for long words, whose states would add up: rows are kept by position and replaced.
_LONG = """
WITH RECURSIVE step(word, pos, tok, round) USING KEY (word, pos) AS (
  SELECT word, pos, tok, 0 FROM start
  UNION
  {contract}
)
SELECT word, list(tok ORDER BY pos) AS ids FROM step WHERE tok >= 0 GROUP BY word ORDER BY word
"""
_NEIGHBOURS = """
SELECT n.word, n.pos, n.tok, n.round, m.merged, safe,
  merged < least(coalesce(g.rank, 65536), coalesce(made_g.rank, 65536), coalesce(made_h.rank, 65536))
    AND merged <= coalesce(h.rank, 65536) AS local
FROM (
  SELECT word, pos, tok, round, lag(tok) OVER w AS prev_tok, lead(tok) OVER w AS next_tok, lead(tok, 2) OVER w AS third_tok
  FROM step WHERE tok >= 0 WINDOW w AS (PARTITION BY word ORDER BY pos)
) n
LEFT JOIN merges m ON m.pair = n.tok::BIGINT * 65536 + n.next_tok
LEFT JOIN safe ON safe.id = m.merged
LEFT JOIN guard_left g ON g.pair = n.prev_tok::BIGINT * 65536 + n.tok
LEFT JOIN guard_right h ON h.pair = n.next_tok::BIGINT * 65536 + n.third_tok
LEFT JOIN guard_left made_g ON made_g.pair = n.prev_tok::BIGINT * 65536 + m.merged
LEFT JOIN guard_right made_h ON made_h.pair = m.merged::BIGINT * 65536 + n.third_tok
"""
#: All pairs of minimum rank that do not overlap, from the left, and all pairs elsewhere that nothing can beat.
#: A merged token from which no pair of lower rank can come (``safe``) leaves the other pairs of its rank next in
#: turn.  If no token that could still grow up to a pair's left or right would merge with one of its two, or
#: with what they make, at a lower rank (``local``; the guards hold those least ranks), the pair is contracted sooner or
#: later, and doing so now changes no step before that: every such step has a lower rank, or an equal one, and touches
#: neither token.  Two such pairs never overlap.  So the result is the same, in few rounds for most words.
_ALL = f"""
SELECT word, pos, CASE WHEN hit THEN merged WHEN lag(hit) OVER (PARTITION BY word ORDER BY pos) THEN -1 ELSE tok END, round + 1 FROM (
  SELECT *, coalesce(local, false) OR (coalesce(merged = low, false) AND CASE WHEN safe THEN in_island % 2 = 1 ELSE nth = 1 END) AS hit FROM (
    SELECT *, row_number() OVER (PARTITION BY word, merged = low, island ORDER BY pos) AS in_island FROM (
      SELECT *, place - nth AS island FROM (
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY pos) AS place, row_number() OVER (PARTITION BY word, merged = low ORDER BY pos) AS nth FROM (
          SELECT *, min(merged) OVER (PARTITION BY word) AS low FROM ({_NEIGHBOURS})
        )
      )
    )
  ) WHERE low IS NOT NULL
)
"""


class Tokenizer:
    """One in-memory database with the vocabulary and its merges."""

    def __init__(self, vocabulary: str):
        import public_tokenizers

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        ranks, self.pattern = self.ranks, regex.compile(public_tokenizers.PATTERN)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(ranks[w[:i]], ranks[w[i:]], r) for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
        unsafe = {part for a, b, r in merges for part in (a, b) if part > r}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "150MB", "temp_directory": tempfile.gettempdir()})
        left, right, merged = (np.array(c, np.int64) for c in zip(*merges))
        self._table("merges", pa.table({"pair": left << 16 | right, "merged": merged.astype(np.int32), "key": merged << 16}))
        self._table("vocabulary", pa.table({"id": pa.array(ranks.values(), pa.int32()), "chars": [w.decode("latin-1") for w in ranks]}))
        self._table("safe", pa.table({"id": pa.array(ranks.values(), pa.int32()), "safe": [r not in unsafe for r in ranks.values()]}))
        self.guarded = False
        self.encode = ChunkEncoder(self._encode_chunks, KNOWN)
        self.words = {}

    def _guard(self) -> None:
        """The least rank at which a token b merges with one that ends in a (left), or begins with a (right), by pair.

        Long words alone need it, so it is made with the first of them.
        """
        ranks, left, right = self.ranks, (array("q"), array("i")), (array("q"), array("i"))
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                if (one := ranks.get(word[:i])) is None or (two := ranks.get(word[i:])) is None:
                    continue
                for k in range(i):
                    if (end := ranks.get(word[k:i])) is not None:
                        left[0].append(end << 16 | two)
                        left[1].append(rank)
                for k in range(i + 1, len(word) + 1):
                    if (start := ranks.get(word[i:k])) is not None:
                        right[0].append(one << 16 | start)
                        right[1].append(rank)
        for name, (pairs, least) in (("guard_left", left), ("guard_right", right)):
            pairs, least = np.frombuffer(pairs, np.int64), np.frombuffer(least, np.int32)
            order = np.lexsort((least, pairs))
            first = order[np.flatnonzero(np.diff(pairs[order], prepend=-1))]
            self._table(name, pa.table({"pair": pairs[first], "rank": least[first]}))
        self.guarded = True

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("arrow_rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM arrow_rows")
        self.db.unregister("arrow_rows")

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def _merge(self, words: list[bytes], sql: str) -> list[bytes]:
        sizes = np.array([len(w) for w in words])
        body = np.frombuffer(b"".join(words), np.uint8)
        pos = np.arange(len(body)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos.astype(np.int32), "tok": self.byte[body]})
        lists = self._query("start", rows, sql)["ids"].combine_chunks()
        ends = 4 * lists.offsets.to_numpy()
        data = lists.values.to_numpy().astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are no tokens themselves."""
        short = [w for w in words if len(w) < LONG]
        found = {}
        for k in range(0, len(short), WORDS):
            part = short[k : k + WORDS]
            found.update(zip(part, self._merge(part, _SHORT)))
        part, size = [], 0
        for word in [*(w for w in words if len(w) >= LONG), None]:
            if part and (word is None or size + len(word) > LONG_BYTES):
                if not self.guarded:
                    self._guard()
                found.update(zip(part, self._merge(part, _LONG.format(contract=_ALL))))
                part, size = [], 0
            if word is not None:
                part.append(word)
                size += len(word)
        return [found[w] for w in words]

    def _encode_chunks(self, texts: list[str]) -> list[bytes]:
        find = self.pattern.findall
        # A space and ASCII letters, or letters alone, are one match.
        cut = [None if text.isascii() and text[1:].isalpha() and (text[0] == " " or text[0].isalpha()) else find(text) for text in texts]
        if len(self.words) > KNOWN:
            self.words.clear()
        known = self.words
        new = set().union(*[words for words in cut if words is not None], [text for text, words in zip(texts, cut) if words is None]) - known.keys()
        rest = []
        for word in new:
            rank = self.ranks.get(raw := word.encode())
            if rank is None:
                rest.append((word, raw))
            else:
                known[word] = rank.to_bytes(4, "little")
        known.update(zip([word for word, _ in rest], self.merge([raw for _, raw in rest])))
        return [known[text] if words is None else b"".join([known[w] for w in words]) for text, words in zip(texts, cut)]

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts -> their bytes; byte b is kept as the character of code point b."""
        sizes = np.array([len(ids) // 4 for ids in texts], np.int64)
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int32)
        rows = pa.table({"text": np.repeat(np.arange(len(texts), dtype=np.int32), sizes), "pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        # One thread aggregates the sorted rows in their order.
        sql = "SELECT text, string_agg(chars, '') AS chars FROM (SELECT text, chars FROM encoded JOIN vocabulary USING (id) ORDER BY pos) GROUP BY text"
        found = self._query("encoded", rows, sql)
        out = [b""] * len(texts)
        for text, chars in zip(found["text"].to_pylist(), found["chars"].to_pylist()):
            out[text] = chars.encode("latin-1")
        return out


@cache
def _tokenizer(vocabulary: str) -> Tokenizer:
    return Tokenizer(vocabulary)


def encode(docs: DataFrame, keys: list[str], text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """keys and ``ids`` (little-endian unsigned 32-bit); a null or empty text has none.

    Row by row: repeated rows and null keys are rows like any other, an empty table gives none.
    """
    schema = StructType([docs.schema[k] for k in keys] + [StructField("ids", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            for first, texts in pieces(batch.column(len(keys)), 2 << 20):
                ids = tokenizer.encode([t or "" for t in texts.to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(first, len(texts)) for k in range(len(keys))] + [pa.array(ids, pa.binary())], names=schema.names)

    return docs.select(*keys, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns and ``decoded``, the bytes; null ids are null."""
    schema = StructType(encoded.schema.fields + [StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                given = part.column(schema.names.index(ids)).to_pylist()
                texts = tokenizer.decode([x or b"" for x in given])
                made = pa.array([None if x is None else t for x, t in zip(given, texts)], pa.binary())
                yield pa.RecordBatch.from_arrays(part.columns + [made], names=schema.names)

    return encoded.mapInArrow(run, schema)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and what they decode to, as digests."""
    coded = decode(encode(table(spark, sf_dir, "documents"), ["doc_id"]))
    return coded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
