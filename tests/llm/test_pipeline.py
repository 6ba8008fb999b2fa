"""The pipeline against brute force, stage by stage, on a small folder of tables."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
from conftest import rows
from test_operators import SCHEMA, brute_components, brute_lines, near, prose

import corpus_pipeline
from llm import packing, quality


def test_stages_are_brute_force(spark, tmp_path):
    made = [(i, near(i % 12, 5 * (i // 24)), "en", f"s{i % 3}", 1) for i in range(60)]
    made += [(100 + i, prose(50 + i) + "\n" + prose(1), "en", "s0", 1) for i in range(8)]
    made += [(300 + i, near(40, i).replace("\n", " "), "en", "s0", 1) for i in range(5)]
    made += [(200, None, "en", "s0", 0), (201, "a b c " * 100, "en", "s0", 600), (202, "few words", None, None, None), (203, "x### y$$$ " * 60, "en", "s1", 9)]
    folder = str(tmp_path)
    spark.createDataFrame(made, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs, states = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        states.append(stage(spark, docs, folder))
        if name != "best_fit_packing":
            assert states[-1].columns == docs.columns
        states[-1].write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        states[-1] = docs
    texts = {r[0]: r[1] for r in made}
    verdict = quality.judged(spark.read.parquet(f"{folder}/documents.parquet"), ["doc_id"]).where("kept")
    good = {r["doc_id"] for r in verdict.collect()}
    assert rows(states[0], "doc_id") == sorted((i,) for i in good) and len(good) >= 40 and not good & {200, 201, 202}

    lines = [(i, t) for i, t in brute_lines([(i, texts[i]) for i in good], 50) if t.strip()]
    assert rows(states[1], "doc_id", "text", "n_chars") == sorted((i, t, len(t) if t != texts[i] else 1) for i, t in lines)

    kept = {key for key, _, _, first in brute_components(lines, 5, 80) if first}
    assert rows(states[2], "doc_id") == sorted((i,) for i in kept) and len(kept) < len(lines)

    encode, end, want = packing._encoder("byte_bpe_50k"), np.array([2], "<u4").tobytes(), Counter()
    for i, text in lines:
        if i in kept:
            ids = encode([text])[0] + end
            at = [0, *range(len(ids) // 4 % 1024 or 1024, len(ids) // 4, 1024), len(ids) // 4]
            want.update((i, p, zlib.crc32(ids[4 * a : 4 * b])) for p, (a, b) in enumerate(zip(at, at[1:])))
    assert Counter(map(tuple, states[3].select("doc_id", "piece", "ids_crc32").collect())) == want

    assert corpus_pipeline.run(spark, folder).count() == states[3].count()


def test_an_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
