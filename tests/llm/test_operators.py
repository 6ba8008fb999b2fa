"""The operators of ``llm`` against brute force on small fixtures, with the awkward rows the docstrings define."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from llm import ann, bpe, chat, licenses, linedup, lm, neardup, packing, quality, sharding
from llm.components import components
from llm.tables import stored

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: Names that an operator might use inside.
CLASH = ["row", "class", "bucket", "rank", "gone", "stats__", "k", "h", "i", "shard", "component", "piece"]


def prose(seed: int, words: int = 80) -> str:
    draw = random.Random(seed)
    text = [draw.choice("abcdefgh") + draw.choice("xyz") + str(draw.randrange(300)) for _ in range(words)]
    return "\n".join(" ".join(text[k : k + 9]) for k in range(0, words, 9))


def near(seed: int, change: int) -> str:
    text = prose(seed, 200).split(" ")
    for k in range(change):
        text[(37 * k + 5) % len(text)] = f"new{k}"
    return " ".join(text)


TEXTS = [
    None, "", " \n\t ", "one", "two words", prose(1), prose(1), prose(1).upper(), prose(2, 400), prose(3, 4000), near(7, 0), near(7, 2), near(7, 5),
    near(7, 40), "x" * 30_000, "é " * 500, "\x00 nul", "a b c " * 60, prose(9) + "\n" + prose(1), "漢字 かな 😀", "don't  stop\r\n\n",
]


@pytest.fixture(scope="module")
def docs(spark):
    made = [(i, t, "en", "hot" if i % 3 else None, 0) for i, t in enumerate(TEXTS)]
    made += [(None, prose(1), None, None, None), (None, None, None, None, None), (5, prose(1), "en", "hot", 0)]
    return stored(spark.createDataFrame(made, SCHEMA))


@pytest.fixture(scope="module")
def none(spark):
    return stored(spark.createDataFrame([], SCHEMA))


def wide(docs):
    return stored(docs.select("*", *[F.lit(7).alias(c) for c in CLASH]))


def words_of(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


# -- 1 -------------------------------------------------------------------------


def brute_lines(records, least):
    """Texts after deletion, by maximal repeated runs found pair by pair."""
    seqs = []
    for key, text in records:
        lines = (text or "").split("\n")
        seqs.append((key, text, lines, [n for n, x in enumerate(lines) if WORD.search(x)]))
    seqs.sort(key=lambda s: (s[0] is not None, s[0] or 0))
    gone = {n: set() for n in range(len(seqs))}
    spots = [(d, i) for d, s in enumerate(seqs) for i in range(len(s[3]))]
    line = lambda d, i: seqs[d][2][seqs[d][3][i]]
    for b, (d2, j) in enumerate(spots):
        for d1, i in spots[:b]:
            n = 0
            while i + n < len(seqs[d1][3]) and j + n < len(seqs[d2][3]) and line(d1, i + n) == line(d2, j + n):
                n += 1
            if sum(len(WORD.findall(line(d2, j + k))) for k in range(n)) >= least:
                gone[d2].update(range(j, j + n))
    out = []
    for d, (key, text, lines, worded) in enumerate(seqs):
        drop = {worded[i] for i in gone[d]}
        for i in gone[d]:
            if i + 1 in gone[d]:
                drop.update(range(worded[i], worded[i + 1]))
        out.append((key, None if text is None else "\n".join(x for n, x in enumerate(lines) if n not in drop)))
    return out


def test_line_dedup_is_brute_force(spark):
    draw = random.Random(4)
    records = [(n, "\n".join(draw.choice(["a", "b b", "c c c", "", "d", "e f"]) for _ in range(draw.randrange(14)))) for n in range(25)] + [(99, None)]
    df = stored(spark.createDataFrame(records, "doc_id BIGINT, text STRING"))
    for least in (1, 4, 7):
        out = linedup.without_repeats(df, min_words=least)
        assert rows(out, "doc_id", "text") == sorted(brute_lines(records, least), key=lambda t: (t[0], t[1] is None, t[1] or ""))


def test_line_dedup_of_awkward_rows(docs, none):
    out = linedup.without_repeats(wide(docs))
    assert out.columns == [c for c in wide(docs).columns if c != "gone"] + ["gone"]
    assert out.count() == docs.count()
    left = {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] is not None}
    assert left[0] is None and left[1] == "" and left[6] == "", "the null key has the first copy"
    assert left[18] == prose(9) and left[3] == "one"
    assert linedup.without_repeats(none).count() == 0


# -- 2 -------------------------------------------------------------------------


#: The second gives a tree of three levels that joins two askers at a time, over blocks of one text or a few.
@pytest.mark.parametrize("sizes", [lm.Sizes(), lm.Sizes(4_000, 1_000, 1)])
def test_scores_are_the_formula(docs, none, sizes):
    learn = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    out = lm.score(wide(docs), learn, strengths=(3.0, 2.0), min_seen=2, sizes=sizes).collect()
    known = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    learns = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    tokens = lambda t: [*words_of(t), None]
    train = [tokens(r["text"]) for r in docs.collect() if learns(r["doc_id"])]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["start", *t], t))
    total, types = sum(one.values()), len(one)
    state = Counter(one) + Counter({"start": len(train)})
    three = Counter(p for t in train for p in zip(["start", *t], t, t[1:]) if two[p[:2]] > 1 and two[p[1:]] > 1)
    context = Counter()
    for (u, v, _), n in three.items():
        context[u, v] += n
    low = lambda w: (one[w] + 1) / (total + types + 1)
    middle = lambda v, w: (two[v, w] + 3 * low(w)) / (state[v] + 3)
    high = lambda u, v, w: (three[u, v, w] + 2 * middle(v, w)) / (context[u, v] + 2)
    for u, v in [*context][:5]:
        assert sum(high(u, v, w) for w in one) + 2 / (context[u, v] + 2) * (1 - sum(middle(v, w) for w in one)) == pytest.approx(1), "arcs and failure arc share out one"
    assert len(out) == docs.count() and three
    for r in out:
        if r["doc_id"] is None:
            continue
        t = tokens(known[r["doc_id"]])
        score = math.log10(middle("start", t[0])) + sum(math.log10(high(*p)) for p in zip(["start", *t], t, t[1:]))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not learns(r["doc_id"]), len(t), sum(w in one for w in t), total)
        assert r["base_score"] == pytest.approx(sum(map(math.log10, map(low, t)))) and r["score"] == pytest.approx(score)
    assert lm.score(none, F.lit(True)).count() == 0


# -- 3 -------------------------------------------------------------------------


def library(name: str):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n: int) -> list[str]:
    draw = random.Random(5)
    return ["".join(draw.choice("ab \n\t.é漢1'sX \u0301\x85") for _ in range(draw.randrange(60))) for _ in range(n)]


def test_bpe_is_the_library(docs, none):
    out = bpe.decode(bpe.encode(docs.select("*", F.lit(1).alias("ids")), ["doc_id"])).collect()
    encoding = library("byte_bpe_multi_50k.tiktoken")
    ids = lambda t: np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in out) == Counter((r["doc_id"], ids(r["text"]), (r["text"] or "").encode()) for r in docs.collect())
    texts = odd_texts(800) + ["".join(random.Random(n).choice("etaoinsh") for _ in range(500)) for n in range(3)] + ["=" * 5_000, "ab" * 900]
    assert bpe._tokenizer("byte_bpe_multi_50k").encode(texts) == [ids(t) for t in texts]
    draw = random.Random(11)
    of = lambda parts, n: "".join(draw.choice(parts) for _ in range(n))
    han = [chr(0x4E00 + i) for i in range(3_000)]
    long = [of(han, 20_000), "，".join(of(han, 30) for _ in range(300)), of("abcdefghijklmnopqrstuvwxyz", 1_500), *(of("aab", 500) for _ in range(20))]
    long += [of(["the", "ing", "tion", "er", "a", "re", "s", "é"], 100) for _ in range(100)]
    assert bpe._tokenizer("byte_bpe_multi_50k").encode(long) == [ids(t) for t in long]
    assert bpe.encode(none, ["doc_id"]).count() == 0


# -- 4 -------------------------------------------------------------------------


def test_shards_match_the_mixture(spark, none):
    made = [(i if i % 50 else None, None, "en", f"s{min(i % 10, 3)}" if i % 7 else None, 0) for i in range(1000)]
    out = sharding.interleave(stored(spark.createDataFrame(made, SCHEMA)), "source", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).collect()
    size, mixture = Counter(r["shard"] for r in out), Counter(r["source"] for r in out)
    assert len(out) == 1000 and set(size.values()) == {125}
    for (source, _), n in Counter((r["source"], r["shard"]) for r in out).items():
        assert abs(n - mixture[source] / 8) <= 2
    for shard in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(size[shard]))
    assert sharding.interleave(none, "source", F.lit("")).count() == 0


# -- 5 -------------------------------------------------------------------------


def test_events_fold_to_final_messages(spark):
    log = [
        (1, 1, 1, "delta", "user", "hel"), (1, 2, 1, "delta", None, "lo"), (1, 3, 2, "delta", "assistant", "old"), (1, 4, 3, "delta", "user", "gone"),
        (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", "assistant", "ne"), (1, 7, 2, "delta", None, "w"), (1, 8, 1, "edit", None, "bye"), (1, 9, 1, "delta", None, "!"),
        (None, 1, 1, None, None, None),
    ]
    df = spark.createDataFrame(log, "conv BIGINT, seq BIGINT, turn BIGINT, kind STRING, role STRING, text STRING")
    assert rows(chat.fold(df)) == [(1, 1, "user", "bye!"), (1, 2, "assistant", "new"), (None, 1, "", "")]
    assert chat.render(chat.fold(df.limit(0))).count() == 0


def test_chat_reads_back(spark):
    hard = ["", "\\### Assistant: </turn> ok", "\\h\\\\l<#>", "a:\nb", "</turn>\n### user:\n", "x" * 20_000, "😀é", None]
    said = [(c, t, ["user", "assistant", "odd: role\n#", None][t % 4], hard[(c + t) % len(hard)]) for c in range(9) for t in range(c)] + [(8, 3, "assistant", "tie")]
    df = spark.createDataFrame(said, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    done = chat.render(chat.fold(chat.conversation_events(df, 7)))
    got = done.select("conv", chat.parse(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("mask")).alias("loss")).collect()
    for r in got:
        want = sorted((t, role or "", text or "") for c, t, role, text in said if c == r["conv"])
        assert [(x["role"], x["text"]) for x in r["turns"]] == [w[1:] for w in want]
        assert r["loss"] == "".join(text for _, role, text in want if role == "assistant")
    assert len(got) == 8


# -- 6 -------------------------------------------------------------------------


def brute_components(records, size, percent):
    sets, parent = {}, {}
    for n, (_, text) in enumerate(records):
        w = words_of(text)
        sets[n] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
        parent[n] = n

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    lowest = {}
    for n, (key, _) in enumerate(records):
        if key is not None:
            lowest[root(n)] = min(lowest.get(root(n), key), key)
    return Counter((key, len(sets[n]), lowest.get(root(n)), key == lowest.get(root(n))) for n, (key, _) in enumerate(records))


def test_near_duplicates_are_brute_force(spark, docs, none):
    assert Counter(map(tuple, neardup.near_duplicates(wide(docs)).collect())) == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], 3, 85)
    family = [(n, near(n % 3, n % 23)) for n in range(150)]
    df = stored(spark.createDataFrame(family, "doc_id BIGINT, text STRING"))
    assert Counter(map(tuple, neardup.near_duplicates(df).collect())) == brute_components(family, 3, 85)
    assert neardup.near_duplicates(none).count() == 0


def test_small_cells_find_the_same(spark, monkeypatch):
    family = [(n, near(1, 3 * n % 40)) for n in range(60)]
    df = stored(spark.createDataFrame(family, "doc_id BIGINT, text STRING"))
    monkeypatch.setattr(neardup, "CELL", 7)
    monkeypatch.setattr(neardup, "STARS", 1)
    assert Counter(map(tuple, neardup.near_duplicates(df).collect())) == brute_components(family, 3, 85)


def test_one_document_of_each_group_stays(docs, none):
    kept = neardup.one_of_each(wide(docs))
    assert kept.columns == wide(docs).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 6 not in ids and {0, 1, 2, 3, 10, 13} <= set(ids) and 11 not in ids
    assert neardup.one_of_each(none).count() == 0


def test_rows_keep_their_numbers_when_splits_change(spark, monkeypatch):
    """The first step scans with one core, the later ones with six."""
    texts = [near(n % 10, 0 if n < 10 else 2) for n in range(30)]
    df = stored(spark.createDataFrame(enumerate(texts), "doc_id BIGINT, text STRING").repartition(3))

    def moved(rows):
        out = stored(rows)
        spark.conf.set("spark.sql.files.minPartitionNum", "6")
        return out

    monkeypatch.setattr(neardup, "stored", moved)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert rows(neardup.one_of_each(df), "doc_id", "text") == [(n, texts[n]) for n in range(10)]
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_registers_merge_by_maximum():
    a, b = np.arange(1, 400, dtype=np.uint64) ** 3, np.arange(300, 900, dtype=np.uint64) ** 3
    assert (neardup.registers(np.union1d(a, b)) == np.maximum(neardup.registers(a), neardup.registers(b))).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 90)] + [(7, 7), (201, 200), (200, 201)]
    found = dict(rows(components(spark.createDataFrame(links, "a BIGINT, b BIGINT"), "a", "b")))
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 190), 100), 200: 200, 201: 200}


# -- 7 -------------------------------------------------------------------------


def test_counts_are_brute_force(docs, none):
    for r in quality.judged(wide(docs), ["doc_id", "text"]).collect():
        text = r["text"] or ""
        w = WORD.findall(text)
        runs = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if runs[x] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        s = r["stats"]
        assert (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert quality.judged(none, ["doc_id"]).count() == 0 and quality.keep_good(none).columns == none.columns


def test_rules_find_the_classes():
    draw = random.Random(2)
    patterns = Counter()
    for _ in range(5000):
        good = draw.random() < 0.8
        right = lambda p: draw.random() < p
        patterns["".join("0" if right(0.2) else ("+" if good == right(0.9) else "-") for _ in quality.RULES)] += 1
    model = quality.learn(patterns)
    plain = lambda p: p.count("+") > p.count("-")
    assert sum(n for p, n in patterns.items() if (model.posterior(p) >= 0.5) == plain(p)) > 0.95 * 5000
    assert quality.learn({}).posterior("0" * len(quality.RULES)) == pytest.approx(0.5)


def test_verdicts_agree_with_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.judged(spark.read.parquet(f"{sf}/documents.parquet"), ["doc_id"]).where("not base_failed")
    both = found.select("doc_id", "kept").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = both.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert got > 0.97


# -- 8 -------------------------------------------------------------------------


def test_nearest_against_brute_force(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1500, 24))
    x[700:1000] = x[5]
    made = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    bad = [(2000, None), (2020, []), (2040, [0.0] * 24), (2060, [float("nan")] * 24), (2080, [float("inf"), 1.0]), (2100, [None, 1.0]), (None, [1.0] * 24), (0, made[0][1])]
    df = spark.createDataFrame(made + bad, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    out = ann.search(df.withColumn("rank", F.lit(1)), F.col("vec_id") % 20 == 0).toPandas()
    hit = 0
    for q in range(0, 1500, 20):
        score = x @ x[q]
        score[q] = -np.inf
        want = np.lexsort((np.arange(1500), -score))[:20]
        mine = out[out.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, score[mine.vec_id])
        hit += len(set(want) & set(mine.vec_id))
        if q in (720, 980):
            assert list(mine.vec_id) == [5, *range(700, 720)][:20]
    assert out.query_id.nunique() == 75 and hit / 1500 >= 0.9


def test_few_vectors_give_all_candidates(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0, -float(i)]) for i in range(0, 60, 10)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    out = ann.search(df, F.col("vec_id") % 20 == 0)
    assert out.count() == 3 * 5 and ann.search(df.limit(0), F.lit(True)).count() == 0
    assert ann.search(df.limit(1), F.lit(True)).count() == 0


@pytest.mark.parametrize("norms", ["lognormal", "outlier"])
def test_nearest_of_different_norms(spark, norms):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(60, 64))[draw.integers(0, 60, 9000)] + 0.7 * draw.normal(size=(9000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms == "lognormal":
        x *= np.exp(0.6 * draw.normal(size=9000))[:, None]
    else:
        x[7] *= 5
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    out = ann.search(df, F.col("vec_id") % 100 == 0).toPandas()
    hit = 0
    for q in range(0, 9000, 100):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(set(np.argsort(-score)[:20]) & set(out[out.query_id == q].vec_id))
    assert hit / 1800 >= 0.97


# -- 9 -------------------------------------------------------------------------


def test_licenses_inherit_from_the_nearest_directory(spark):
    files = [
        ("LICENSE", licenses.TEMPLATES["MIT"][0]), ("a/COPYING.txt", "x y z\n" + licenses.TEMPLATES["GPL-3.0"][0].upper()), ("a/b/f.txt", None), ("a/g.txt", "text"),
        ("h.txt", ""), ("a/own.txt", "some words\n" + licenses.TEMPLATES["Apache-2.0"][0] + "\nmore"), (None, "text"), ("a/g.txt", "text"), ("c/far/LICENSE", "no notice"), ("c/far/x", "the license is under a"),
    ]
    df = spark.createDataFrame(files, "path STRING, text STRING").withColumn("license", F.lit("clash"))
    got = {r["path"]: (r["license"], r["directory"]) for r in licenses.licenses(df.select("path", "text")).collect()}
    assert got == {
        "LICENSE": ("MIT", None), "a/COPYING.txt": ("GPL-3.0", None), "a/b/f.txt": ("GPL-3.0", "a"), "a/g.txt": ("GPL-3.0", "a"), "h.txt": ("MIT", ""),
        "a/own.txt": ("Apache-2.0", None), None: (None, None), "c/far/LICENSE": ("MIT", ""), "c/far/x": ("MIT", ""),
    }
    assert licenses.licenses(df.limit(0)).count() == 0


# -- 10 ------------------------------------------------------------------------


def test_packing_ids_are_the_library(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = odd_texts(500) + TEXTS[1:] + ["".join(f"a{c}1{c} {c}" for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert packing._encoder("byte_bpe_50k")(texts) == want


def test_packing_places_every_piece_once(docs, none):
    out = packing.packed_documents(wide(docs)).toPandas()
    end, encode = np.array([2], "<u4").tobytes(), packing._encoder("byte_bpe_50k")
    want = Counter()
    for r in docs.collect():
        ids = encode([r["text"] or ""])[0] + end
        n = len(ids) // 4
        at = [0, *range(n % 1024 or 1024, n, 1024), n]
        want.update((r["doc_id"] if r["doc_id"] is not None else -1, p, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for p, (a, b) in enumerate(zip(at, at[1:])))
    got = out.fillna({"doc_id": -1})
    assert Counter(zip(got.doc_id.astype(int), got.piece, got.start, got.length, got.ids_crc32)) == want
    for _, sequence in out.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert list(sequence.offset) == [0, *np.cumsum(sequence.length)[:-1]] and sequence.length.sum() <= 1024
    assert packing.packed_documents(none).count() == 0


def test_completion_beats_or_equals_best_fit():
    draw = np.random.default_rng(8)
    for low in (1, 200, 350):
        lengths = Counter(draw.integers(low, 1025, 4000).tolist())
        patterns = packing.best_patterns(dict(lengths))
        used = Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= 1024
            used.update({n: c * times for n, c in Counter(pattern).items()})
        assert used == lengths and len(patterns) <= 2048
        assert sum(t for _, t in patterns) <= sum(t for _, t in packing.completions(dict(lengths), search=False))
    assert packing.best_patterns({}) == [] and packing.best_patterns({600: 1, 424: 2, 400: 1, 24: 1}) == [([600, 424], 1), ([424, 400, 24], 1)]


@pytest.mark.parametrize("unit", [
    {448: 2, 384: 4, 192: 2, 128: 2},
    {512: 1, 448: 1, 384: 1, 320: 4, 192: 1, 128: 2},
])
def test_packing_meets_the_bound(unit):
    histogram = {n: 60 * c for n, c in unit.items()}
    patterns = packing.best_patterns(histogram)
    used = Counter()
    for pattern, times in patterns:
        assert sum(pattern) <= 1024
        used.update({n: c * times for n, c in Counter(pattern).items()})
    assert used == histogram and sum(t for _, t in patterns) == math.ceil(sum(n * c for n, c in histogram.items()) / 1024) == 180


def test_digest_of_a_text_round_trips(docs):
    coded = bpe.decode(bpe.encode(docs, ["doc_id", "text"])).collect()
    assert all(hashlib.sha256(bytes(r["decoded"])).digest() == hashlib.sha256((r["text"] or "").encode()).digest() for r in coded)
