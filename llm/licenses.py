"""License scan: sparse TF-IDF cosine of lines to license texts, then inheritance from the nearest directory.

DataFrame functions only.  Terms are runs of ASCII letters and digits, lower case, but for a few common words.  A license has several
templates: its title, its identifier, notices and the beginning of its text.  Weights are tf * ln(1 + N / df) over the
N templates; a term of no template weighs as if one template had it.  What is compared is every run of up to
``RUN`` lines, so a notice that is broken over lines is found, and the whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.tables import stored, table

#: Titles, identifiers, notices and first sentences of licenses, as their publishers word them.
TEMPLATES = {
    "AGPL-3.0": [
        "GNU Affero General Public License",
        "GNU Affero General Public License version 3",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Apache License Version 2.0",
        "Apache License Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "BSD-2-Clause": ["BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "BSD-3-Clause": [
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "SPDX-License-Identifier: CC0-1.0"],
    "GPL": ["GNU General Public License", "Licensed under the GNU GPL"],
    "GPL-2.0": [
        "GNU General Public License version 2",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License version 3",
        "GNU General Public License Version 3, 29 June 2007",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "ISC": [
        "ISC License",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL-2.1": ["GNU Lesser General Public License version 2.1", "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "LGPL-3.0": ["GNU Lesser General Public License version 3", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "MIT": [
        "Released under the MIT License.",
        "MIT License",
        "The MIT License (MIT)",
        "SPDX-License-Identifier: MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ],
    "MPL-2.0": [
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}
#: Lines that are compared together, at most.
RUN = 5
MIN_COSINE = 0.8
_TERM = "[a-z0-9]+"
#: Words that say nothing about a license and are no terms.
COMMON = "a an and any as at be by for from in into is it may not of on or that the this to with you".split()
_LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"


class _Model:
    """Weights of the templates; small, since they grow with the list of templates only."""

    def __init__(self, templates: dict[str, list[str]], min_cosine: float):
        counts = {(name, k): Counter(t for t in re.findall(_TERM, text.lower()) if t not in COMMON) for name, texts in templates.items() for k, text in enumerate(texts)}
        spread = Counter(term for terms in counts.values() for term in terms)
        self.idf = {term: math.log(1 + len(counts) / n) for term, n in spread.items()}
        self.unknown = math.log(1 + len(counts))
        self.norm = {name: math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in c.items())) for name, c in counts.items()}
        self.counts = counts
        # A line without any of a template's heaviest terms stays below the cosine that the rest can give.
        self.signs: set[str] = set()
        for name, c in counts.items():
            left = self.norm[name] ** 2
            for term in sorted(c, key=lambda t: (c[t] * self.idf[t], len(t), t), reverse=True):
                if left < (min_cosine * self.norm[name]) ** 2:
                    break
                self.signs.add(term)
                left -= (c[term] * self.idf[term]) ** 2


def _literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]))
    return spark.range(1).select(each.alias("r")).select("r.*")


def _runs(lines: Column, signs: str) -> Column:
    """All runs of up to ``RUN`` lines around each line with a sign."""
    number = F.size(lines)
    signed = F.filter(F.sequence(F.lit(0), number - 1), lambda i: F.get(lines, i).rlike(signs))

    def around(i: Column) -> Column:
        places = [F.struct((i - back).alias("first"), F.lit(size).alias("size")) for size in range(1, RUN + 1) for back in range(size)]
        whole = F.filter(F.array(*places), lambda w: (w["first"] >= 0) & (w["first"] + w["size"] <= number))
        return F.transform(whole, lambda w: F.array_join(F.slice(lines, F.greatest(w["first"] + 1, F.lit(1)), w["size"]), "\n"))

    return F.flatten(F.transform(signed, around))


def notices(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """path, license, cosine: the best match of any run of lines, or of the whole text, of each file that has one.

    A match shares two different terms with the template at least.  Ties go to the smaller name.  Rows of
    equal path are one file; null texts have no lines.
    """
    spark, model = files.sparkSession, _Model(templates, min_cosine)
    if not model.signs:
        return files.select("path", F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("cosine")).limit(0)
    signs = f"(?<![a-z0-9])({'|'.join(sorted(model.signs))})(?![a-z0-9])"
    text = F.lower("text")
    # The terms shared with a template bound the cosine, and two at least have to be shared.
    parts = F.array(
        *[
            F.array(*[F.struct(F.lit(t).alias("t"), F.lit((n * model.idf[t] / model.norm[name]) ** 2).alias("w")) for t, n in sorted(c.items())])
            for name, c in sorted(model.counts.items())
        ]
    )
    shared = lambda own: F.filter(own, lambda x: F.array_contains("terms", x["t"]))
    weight = lambda own: F.aggregate(shared(own), F.lit(0.0), lambda total, x: total + x["w"])
    possible = F.exists(parts, lambda own: (weight(own) >= (min_cosine - 1e-9) ** 2) & (F.size(shared(own)) >= 2))
    # As the output of a generator the lines of a text, and the terms of a run, are found once, not once for each use.
    common = F.array(*[F.lit(w) for w in COMMON])
    words_of = lambda c: F.filter(F.regexp_extract_all(c, F.lit(f"({_TERM})")), lambda t: ~F.array_contains(common, t))
    vocabulary = F.array(*[F.lit(t) for t in sorted(model.idf)])
    known = lambda c: F.explode(F.array(F.array_intersect(F.regexp_extract_all(c, F.lit(f"({_TERM})")), vocabulary))).alias("terms")
    cut = files.where("text is not null").select("path", text.alias("text"), known(text))
    # A file without two terms of one template, or without enough of its weight, has no run that matches.
    cut = cut.where(possible).select("path", "text", F.explode(F.array(F.split("text", "\n", -1))).alias("lines"))
    runs = F.explode(F.array_distinct(F.concat(_runs(F.col("lines"), signs), F.array("text"))))
    found = cut.select("path", runs.alias("line")).select("path", "line", known("line"))
    near = found.where(possible)
    near = stored(near.select("path", F.xxhash64("line").alias("unit"), "line").dropDuplicates(["path", "unit"]))
    each = near.select("path", "unit", F.explode(words_of("line")).alias("term"))
    counted = each.groupBy("path", "unit", "term").agg(F.count("*").alias("tf"))
    idf = F.broadcast(_literal_rows(spark, sorted(model.idf.items()), ["term", "idf"]))
    weighed = counted.join(idf, "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(model.unknown)))
    norms = weighed.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = [(name, k, term, n * model.idf[term] / model.norm[name, k]) for (name, k), c in model.counts.items() for term, n in c.items()]
    template = F.broadcast(_literal_rows(spark, sorted(weights), ["license", "template", "term", "share"]))
    dots = weighed.join(template, "term").groupBy("path", "unit", "license", "template").agg(
        F.sum(F.col("w") * F.col("share")).alias("dot"), F.count("*").alias("shared")
    ).where("shared >= 2")
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    scored = dots.join(norms, ["path", "unit"]).select("path", "license", cosine.alias("cosine")).where(F.col("cosine") >= min_cosine)
    best = F.max_by("license", F.struct("cosine", *_descending(F.col("license"))))
    return stored(scored.groupBy("path").agg(best.alias("license"), F.max("cosine").alias("cosine")))


def _descending(name: Column) -> list[Column]:
    """Sorts the other way round than the name (code points below 128)."""
    return [F.translate(name, "".join(map(chr, range(32, 127))), "".join(map(chr, range(126, 31, -1))))]


def license_files(files: DataFrame) -> DataFrame:
    """path, directory: files whose name says that they state the license of their directory."""
    return files.where(F.col("path").rlike(_LICENSE_FILE)).select("path", _directory(F.col("path")).alias("directory")).distinct()


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def licenses(files: DataFrame, covers: DataFrame | None = None, templates: dict[str, list[str]] = TEMPLATES, min_cosine: float = MIN_COSINE) -> DataFrame:
    """path, license, cosine, directory: for each file its own notice, else what the nearest directory above has.

    ``covers`` (path, directory) names the files that state a directory's license (default: by file name).  A directory
    with several takes the highest cosine, then the smaller name.  ``directory`` is null for a file's own
    notice; license is null where none is found.  Rows of equal path are one file, a null path is a file
    of its own without directories; an empty table gives an empty result.
    """
    own = notices(files, templates, min_cosine)
    paths = files.select("path").distinct()
    covers = license_files(files) if covers is None else covers
    stated = covers.join(own, "path").groupBy("directory").agg(F.max_by("license", F.struct("cosine", *_descending(F.col("license")))).alias("stated"))
    # Directories are few next to files, so the search upwards is done for each once.
    placed = paths.withColumn("inside", _directory(F.col("path")))
    parts = F.split("inside", "/")
    upward = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("directory")))
    above = placed.select("inside").where("inside is not null").distinct().select("inside", F.explode(upward).alias("u")).select("inside", "u.depth", "u.directory")
    nearest = above.join(stated, "directory").groupBy("inside").agg(F.max_by(F.struct("stated", "directory"), "depth").alias("near"))
    joined = placed.join(own.withColumnRenamed("path", "path_"), F.col("path").eqNullSafe(F.col("path_")), "left").join(nearest, "inside", "left")
    inherited = F.col("license").isNull()
    return joined.select(
        "path",
        F.coalesce("license", "near.stated").alias("license"),
        "cosine",
        F.when(inherited, F.col("near.directory")).alias("directory"),
    )


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents as files ``source/lang/<doc_id div 1000>/<doc_id>``.

    The file of the smallest doc_id in a directory (a source, a source's language, a thousand) states its license.
    """
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    thousand = F.expr("coalesce(cast(doc_id div 1000 as string), '')")
    levels = [part("source"), F.concat_ws("/", part("source"), part("lang")), F.concat_ws("/", part("source"), part("lang"), thousand)]
    path = F.concat_ws("/", levels[-1], F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    files = docs.select(path.alias("path"), "text")
    each = docs.select(path.alias("path"), "doc_id", F.explode(F.array(*levels)).alias("directory"))
    covers = each.groupBy("directory").agg(F.min_by("path", "doc_id").alias("path")).where("path is not null")
    return licenses(files, covers).select("path", F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "license", "cosine", "directory")


def _oracle() -> str:
    values = ", ".join(f"('{name}', {k}, '{text}')" for name, texts in sorted(TEMPLATES.items()) for k, text in enumerate(texts))
    return f"""
WITH templates(license, template, notice) AS (VALUES {values}),
tpl AS (
  SELECT license, template, term, count(*) AS tf
  FROM (SELECT license, template, unnest(regexp_extract_all(lower(notice), '{_TERM}')) AS term FROM templates) WHERE term NOT IN ({', '.join(repr(w) for w in COMMON)}) GROUP BY ALL),
idf AS (SELECT term, ln(1 + (SELECT count(*) FROM templates) / count(*)) AS idf FROM tpl GROUP BY term),
tw AS (SELECT license, template, term, tf * idf AS w, sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY license, template)) AS norm FROM tpl JOIN idf USING (term)),
files AS (
  SELECT doc_id, lower(text) AS text, source, source || '/' || lang AS d2, source || '/' || lang || '/' || (doc_id // 1000) AS d3,
    source || '/' || lang || '/' || (doc_id // 1000) || '/' || doc_id AS path FROM documents
),
runs AS (
  SELECT path, array_to_string(lines[i : i + size - 1], chr(10)) AS line
  FROM (SELECT path, lines, size, unnest(range(1, len(lines) - size + 2)) AS i
        FROM (SELECT path, string_split(text, chr(10)) AS lines FROM files), range(1, {RUN + 1}) r(size))),
units AS (SELECT DISTINCT path, line FROM (FROM runs UNION ALL SELECT path, text FROM files)),
terms AS (SELECT path, line, term, count(*) AS tf FROM (SELECT path, line, unnest(regexp_extract_all(line, '{_TERM}')) AS term FROM units) WHERE term NOT IN ({', '.join(repr(w) for w in COMMON)}) GROUP BY ALL),
weighed AS (SELECT path, line, t.term, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM templates))) AS w FROM terms t LEFT JOIN idf USING (term)),
norms AS (SELECT path, line, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL),
scored AS (
  SELECT path, license, round(sum(weighed.w * tw.w / tw.norm) / any_value(norms.norm), 6) AS cosine
  FROM weighed JOIN tw USING (term) JOIN norms USING (path, line) GROUP BY path, line, license, template HAVING count(DISTINCT term) >= 2
),
own AS (SELECT path, license, cosine FROM scored WHERE cosine >= {MIN_COSINE} QUALIFY row_number() OVER (PARTITION BY path ORDER BY cosine DESC, license) = 1),
levels AS (SELECT source AS directory, 1 AS depth, path, doc_id FROM files UNION ALL SELECT d2, 2, path, doc_id FROM files UNION ALL SELECT d3, 3, path, doc_id FROM files),
covers AS (SELECT directory, min_by(path, doc_id) AS path FROM levels GROUP BY directory),
stated AS (SELECT directory, license AS stated FROM covers JOIN own USING (path)),
near AS (SELECT path, stated, directory FROM levels JOIN stated USING (directory) QUALIFY row_number() OVER (PARTITION BY levels.path ORDER BY depth DESC) = 1)
SELECT f.path, f.doc_id, coalesce(own.license, near.stated) AS license, cosine, CASE WHEN own.license IS NULL THEN near.directory END AS directory
FROM files f LEFT JOIN own USING (path) LEFT JOIN near USING (path)
"""


ORACLE = _oracle()
