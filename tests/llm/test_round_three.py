"""Operators 11 to 13 against brute force, SQL on awkward rows, and held-out labels."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from llm import divergence, fmquality, veccodes
from llm.tables import stored, table

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


# -- 11 ------------------------------------------------------------------------


def brute_audit(records, top):
    tokens = [((r[2] or ""), (r[3] or ""), TERM.findall((r[1] or "").translate(LOWER))) for r in records]
    seen, counts, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in tokens:
        counts[lang, source].update(words)
        seen[lang].update(set(words))
        total[lang].update(words)
    out = []
    share = lambda n, of, v: 1 + 10**9 * (n + 1) // (of + v)
    for lang, source in counts:
        kept = [w for w, n in seen[lang].items() if n >= 3]
        size = lambda c: sum(c[w] for w in kept)
        mine, whole = counts[lang, source], total[lang]
        p = {w: share(mine[w], size(mine), len(kept)) for w in kept}
        q = {w: share(whole[w], size(whole), len(kept)) for w in kept}
        pairs = []
        for other, item in counts:
            if other == lang and item != source:
                theirs = counts[other, item]
                r = {w: share(theirs[w], size(theirs), len(kept)) for w in kept}
                pairs.append((item, sum((p[w] - r[w]) ** 2 // r[w] for w in kept)))
        terms = [(w, (p[w] - q[w]) ** 2 // q[w]) for w in kept if mine[w] and p[w] > q[w]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def spoken(seed, words, vocabulary):
    draw = random.Random(seed)
    return " ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}" for n in (int(draw.paretovariate(0.6)) % vocabulary for _ in range(words)))


def audit_rows():
    made = [(k, spoken(k, 60, 400), "en", f"s{k % 5}" if k % 3 else "hot", 0) for k in range(60)]
    made += [(100 + k, spoken(k, 40, 90), None, f"s{k % 2}", 0) for k in range(12)]
    made += [(1, None, "en", None, None), (None, "", "xx", "a", 0), (2, "lone words here", "yy", "a", 0), (3, "other", "yy", "b", 0)]
    made += [(4, "Été ÉTÉ été don't x1y2\x00z 漢字 ß", "fr", "a", 0)] * 4 + [(5, "漢字 été", "fr", "b", 0)] * 3
    return made + [(6, "long " * 50_000 + spoken(3, 2000, 400), "en", "s1", 0)]


def test_audit(spark):
    made = audit_rows()
    docs = stored(spark.createDataFrame(made, DOCS).repartition(5).select("*", *[F.lit(7).alias(c) for c in ("term", "n", "id", "block", "p", "chunk")]))
    assert rows(divergence.audit(docs, top=20)) == brute_audit(made, 20)


def test_audit_over_several_blocks_and_chunk_sizes(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_BLOCK", 2)
    monkeypatch.setattr(divergence, "_HEAD", 128)
    made = audit_rows()
    docs = stored(spark.createDataFrame(made, DOCS))
    # Constants are read by the tasks as well, so the cells are computed here, from the rows the tasks would get.
    real = divergence._joint_cells
    sent = spark.sparkContext.broadcast((2, 128))

    def cells(key: tuple, rows: pa.Table) -> pa.Table:
        from llm import divergence as there

        there._BLOCK, there._HEAD = sent.value
        return there._joint_cells(key, rows)

    monkeypatch.setattr(divergence, "_joint_cells", cells)
    try:
        assert rows(divergence.audit(docs, top=20)) == brute_audit(made, 20)
    finally:
        monkeypatch.setattr(divergence, "_joint_cells", real)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_shares_beyond_64_bits(spark):
    got = spark.range(1).select(divergence._share(F.lit(10**13).cast("long"), F.lit(3 * 10**13).cast("long"), F.lit(7).cast("long")).alias("p"))
    assert got.first()["p"] == 1 + 10**9 * (10**13 + 1) // (3 * 10**13 + 7)


# -- 12 ------------------------------------------------------------------------


def brute_codes(vectors, parts, entries, rounds, scale):
    ints = [np.floor(np.array(v, float) * scale).astype(np.int64).astype(object).reshape(parts, -1) for v in vectors]
    books = [[x[p] for x in ints[:entries]] for p in range(parts)]

    def assign():
        out = []
        for x in ints:
            best = [min((int(((x[p] - c) ** 2).sum()), e) for e, c in enumerate(books[p])) for p in range(parts)]
            out.append(([e for _, e in best], sum(d for d, _ in best)))
        return out

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[p] for x, (c, _) in zip(ints, codes) if c[p] == e]
                if mine:
                    books[p][e] = sum(mine) // len(mine)
    return assign(), books


@pytest.mark.parametrize("scale,spread", [(1024, 0.2), (8, 0.2), (1024, 2500.0)])
def test_codes(spark, scale, spread):
    draw = np.random.default_rng(3)
    vectors = draw.normal(0, spread, (240, 12)).astype(np.float32)
    vectors[40:60] = vectors[3]
    vectors[60:70] = 0
    kept = [(k, v.tolist(), None if k % 7 == 0 else k % 3) for k, v in enumerate(vectors)]
    bad = [(900, None, 1), (901, [None] + [0.0] * 11, 1), (902, [float("nan")] * 12, None), (903, [float("inf")] + [0.0] * 11, 2), (904, [0.5], 2)]
    df = spark.createDataFrame(kept + bad, "vec_id long, embedding array<float>, label int").repartition(6)
    df = df.select("*", *[F.lit(7).alias(c) for c in ("key_", "codes_", "error_", "name_", "part", "entry")])
    coded, books = veccodes.compress(df, "vec_id", "embedding", "label", entries=32, scale=scale)
    want, want_books = brute_codes(vectors, 4, 32, 4, scale)
    got = {r["vec_id"]: r for r in veccodes.with_label_error(stored(coded), "label").collect()}
    assert books.tolist() == [[list(map(int, c)) for c in b] for b in want_books]
    assert {k: (list(r["codes_"]), r["error_"]) for k, r in got.items()} == dict(enumerate(want))
    by_label = Counter()
    for k, _, label in kept:
        by_label[label] += want[k][1]
    assert all(r["label_error_"] == by_label[kept[k][2]] for k, r in got.items())


def test_balls_give_what_comparing_all_gives():
    draw = np.random.default_rng(5)
    for spread in (3, 40, 4000, 1 << 23):
        x, book = draw.integers(-spread, spread, (500, 6)), draw.integers(-spread, spread, (40, 6))
        book[17], book[30] = book[4], x[0]
        for got, want in zip(veccodes.nearest_from(x, book, draw.integers(0, 40, 500)), veccodes.nearest(x, book)):
            assert (got == want).all()


def test_codes_of_little(spark):
    schema = "vec_id long, embedding array<float>, label int"
    coded, books = veccodes.compress(spark.createDataFrame([], schema), "vec_id", "embedding", "label")
    assert coded.count() == 0 and books.size == 0
    coded, books = veccodes.compress(spark.createDataFrame([(None, [0.1, -0.1, 0.0, 1.0], None)] * 3, schema), "vec_id", "embedding", "label")
    assert [(r["codes_"][3], r["error_"]) for r in coded.collect()] == [(0, 0)] * 3 and books.shape == (4, 3, 1)
    with pytest.raises(Exception, match="exceeds"):
        veccodes.compress(spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0], None)], schema), "vec_id", "embedding", "label")


# -- 13 ------------------------------------------------------------------------


def test_machine_adds_all_pairs():
    draw = np.random.default_rng(1)
    x = fmquality.features(pa.array(["a b b c", "", None, "Ü x\ny x y x y"]), np.array([7, 0, np.nan, 9.0]))
    size = fmquality.WORDS + fmquality.STATISTICS
    made = fmquality.Machine(0.3, draw.normal(size=size), draw.normal(size=(size, 3)), np.zeros(fmquality.STATISTICS), np.ones(fmquality.STATISTICS))
    for r, got in enumerate(made.scores(x)):
        whole = np.zeros(size)
        whole[x.buckets[x.begins[r] : x.begins[r + 1]]] = x.values[x.begins[r] : x.begins[r + 1]]
        whole[fmquality.WORDS :] = made.standard(x.dense[r])
        used = np.flatnonzero(whole)
        pairs = sum(made.factors[i] @ made.factors[j] * whole[i] * whole[j] for n, i in enumerate(used) for j in used[:n])
        logit = np.clip(made.bias + made.weights @ whole + pairs, -30, 30)
        assert got == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_scores_do_not_depend_on_the_batch():
    texts = ["one two two", "", "x" * 5000, "many words " * 300, "# $ % !!"]
    apart = [fmquality.features(pa.array([t]), np.array([1.0])).dense[0] for t in texts]
    assert np.allclose(fmquality.features(pa.array(texts), np.ones(5)).dense, apart, rtol=0, atol=1e-12)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    scored = fmquality.op13_quality_classifier(spark, folder)
    known = table(spark, folder, "labels").select(F.col("doc_id").alias("of"), "quality")
    joined = scored.filter("held_out").join(known, F.col("doc_id") == F.col("of")).select("quality", "predicted", "score").collect()
    right = sum(r["quality"] == r["predicted"] for r in joined)
    assert right >= 0.98 * len(joined) and all(0 <= r["score"] <= 1 for r in joined)


def test_labels_of_the_held_out_fold_and_keys_change_nothing(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = stored(table(spark, folder, "documents")), table(spark, folder, "labels")
    flipped = labels.withColumn("quality", F.when(fmquality._remainder(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = fmquality.learn(docs, labels), fmquality.learn(docs, flipped)
    assert (one.factors == other.factors).all() and one.bias == other.bias
    renamed = docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "label": F.lit(3), "score": F.lit(1)})
    assert rows(fmquality.score(docs, one)) == rows(fmquality.score(renamed, one))


def test_classifier_on_awkward_rows(spark):
    docs = stored(spark.createDataFrame([(1, None, "en", "a", None), (None, "", None, None, 3), (1, "x " * 40_000, "en", "a", 0), (2, "ok", None, None, 1)] * 2, DOCS))
    labels = lambda made: spark.createDataFrame(made, "doc_id long, quality int, toxic int")
    for made in ([], [(1, 1, 0)], [(1, 1, 0), (2, 0, 0), (2, None, 0), (None, 1, 0), (77, 1, 0)]):
        scored = fmquality.score(docs, fmquality.learn(docs, labels(made))).collect()
        assert len(scored) == 8 and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in scored)
    none = spark.createDataFrame([], DOCS)
    assert fmquality.score(none, fmquality.learn(none, labels([]))).count() == 0


# -- 5 -------------------------------------------------------------------------


def test_the_derived_log_has_all_events_on_every_conversation(spark):
    from llm import chat

    made = [(1, 0, "user", "hello there"), (1, 1, "assistant", "x" * 450), (1, 2, "user", None), (2, 0, "assistant", ""), (2, 0, None, "é<#\\"), (None, None, "user", "a")]
    events = chat.conversation_events(spark.createDataFrame(made, "conv_id BIGINT, turn INT, role STRING, text STRING"))
    kinds = {r["kind"]: r["n"] for r in events.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"regenerate": 2, "edit": 4, "delta": 6 + 2 + 4}
    folded = rows(chat.fold(events), "conv", "role", "text")
    assert folded == sorted(((c, r or "", t or "") for c, _, r, t in made), key=lambda t: [(x is None, x) for x in t])
    # Without what edits and regenerations drop, the drafts would stand in the messages.
    kept = rows(chat.fold(events.where("kind = 'delta'")), "text")
    assert any("ereht olleh" in t for (t,) in kept)


# -- clashing names ------------------------------------------------------------


def test_columns_named_like_helpers_are_kept(spark):
    from llm import neardup, packing, quality

    text = " ".join(f"word{k}" for k in range(60))
    docs = stored(spark.createDataFrame([(1, text, 70), (2, text, 71), (3, "other " + text[:200], 72)], "doc_id BIGINT, text STRING, row__ INT"))
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and {r["row__"] for r in kept.collect()} == {70, 72}
    pieces = stored(spark.createDataFrame([(1, 600, 7, 8), (2, 400, 9, 10)], "doc_id BIGINT, length BIGINT, rank INT, first_ INT"))
    packed = packing.pack(pieces, ["doc_id", "rank"])
    assert rows(packed, "doc_id", "rank", "first_") == [(1, 7, 8), (2, 9, 10)] and {"sequence_id", "offset"} <= set(packed.columns)
    with pytest.raises(ValueError, match="result column"):
        quality.judged(docs.withColumn("stats", F.lit(1)), ["doc_id", "stats"])


# -- 9 -------------------------------------------------------------------------

STATED = {
    "MIT License": "MIT", "The MIT License (MIT)": "MIT", "# SPDX-License-Identifier: MIT": "MIT", "GNU GENERAL PUBLIC LICENSE": "GPL",
    "BSD 3-Clause License": "BSD-3-Clause", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007": "GPL-3.0",
    "// Licensed under the Apache License,\n// Version 2.0 (the \"License\");\n// you may not use this file except in\n// compliance with the License.": "Apache-2.0",
    "x = 1\nPermission is hereby granted, free of charge, to any person obtaining a copy of this\nsoftware and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including": "MIT",
    "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0", "Mozilla Public License Version 2.0": "MPL-2.0", "GNU Affero General Public License version 3": "AGPL-3.0",
    "GNU Lesser General Public License version 3": "LGPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
    "a license to drive": None, "the public was free to use this version of the software": None, "mit der Zeit": None, "": None, "\n\n\n": None,
}


def test_licenses_as_their_publishers_word_them(spark):
    from llm import licenses

    files = [(f"{k}/f", "some words here\n\n" + text + "\n\nand some after") for k, text in enumerate(STATED)]
    files += [("long/f", "line of words\n" * 30_000 + "MIT License\n" + "more\n" * 10_000), ("none/f", None)]
    got = {r["path"]: r["license"] for r in licenses.notices(spark.createDataFrame(files, "path STRING, text STRING")).collect()}
    assert {text: got.get(f"{k}/f") for k, text in enumerate(STATED)} == STATED
    assert got["long/f"] == "MIT" and "none/f" not in got
