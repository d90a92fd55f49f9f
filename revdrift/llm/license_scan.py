"""License scans in DataFrame functions: MinHash bands over overlapping windows.

Words are lower-cased runs of letters and digits, shingles are five of them; a
template of fewer words is one shingle, and is sought among shingles of as many
words.  A template of t shingles is sought in windows of s shingles that begin
every s / 2, where s is the least power of two that is at least 2 t: every place
of the template lies whole in a window, and a window that holds 0.75 of it has a
Jaccard similarity of 0.17 or more with it.  Window and template meet if they agree in one of 64 bands of one
MinHash each, which such a pair misses with probability 0.83**64 = 6e-6.  Exact
containment of the template's shingles in the window then decides.

A MinHash can only agree on a shingle that a template has, so windows without
any are passed over before their signatures are made; that loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, BANDS = 5, 64

#: Statements of well-known licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights",
}

#: What parts words.
GAPS = r"[^\p{L}\p{N}]+"


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    """[template, text]"""
    return spark.createDataFrame(sorted((TEMPLATES if templates is None else templates).items()), "template string, text string")


def words(text: Column | str) -> Column:
    parts = F.split(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), GAPS)
    return F.filter(parts, lambda w: w != "")


def _shingle(at, i, width) -> Column:
    """Hash of ``width`` words (``SHINGLE`` at most) from i on; what is null adds nothing."""
    return F.xxhash64(*[F.when(width > k, F.get(at, i + k)) for k in range(SHINGLE)])


def _shingles(at: str, width: str) -> Column:
    """Distinct shingle hashes of an array of at least ``width`` words."""
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(at) - F.col(width)), lambda i: _shingle(F.col(at), i, F.col(width))))


def _bands(shingles: str) -> Column:
    """An array of [band, the least rank of the shingles in it]."""
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda b: F.struct(
        b.alias("band"), F.array_min(F.transform(F.col(shingles), lambda h: F.xxhash64(h, b))).alias("least")))


def license_scan(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 percent: int = 75) -> DataFrame:
    """[doc_id, template, shared, shingles, word]: the templates that documents hold.

    One row for each id and template of which some window holds at least
    ``percent`` of the distinct shingles: the number it holds, the template's
    number, and the first word (from 0) of the first of the fullest windows.
    Null, empty and wordless texts hold nothing; templates without words are
    never found.  Rows with equal ids (or null ids) are scanned one by one and
    reported together.  Other columns are ignored; an empty table gives no
    rows.  ``templates`` [template, text] is a list that the driver could hold:
    it is broadcast.
    """
    t = (templates.select("template", words("text").alias("w")).filter(F.size("w") > 0)
         .withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
         .select("template", "width", _shingles("w", "width").alias("ts")).withColumn("n", F.size("ts"))
         .withColumn("span", F.pow(F.lit(2), F.ceil(F.log2(F.col("n") * 2.0))).cast("int")))
    sought = t.select(F.explode("ts").alias("h"), "span", "width").distinct()

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(text_col).alias("w"))
    places = (d.select("doc_id", "w", F.posexplode("w").alias("i", "first"))
              .join(F.broadcast(t.select("width").distinct()), F.col("i") + F.col("width") <= F.size("w"))
              .withColumn("h", _shingle(F.col("w"), F.col("i"), F.col("width")))
              .join(F.broadcast(sought), ["h", "width"]))
    half = (F.col("span") / 2).cast("int")
    last = F.floor(F.col("i") / half).cast("int")
    windows = (places.select("doc_id", "w", "span", "width", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)).alias("k"))
               .withColumn("word", F.col("k") * half)
               .select("doc_id", "span", "width", "word", F.slice("w", F.col("word") + 1, F.col("span") + F.col("width") - 1).alias("part"))
               .distinct()
               .withColumn("ws", _shingles("part", "width")))
    met = (windows.select("doc_id", "span", "width", "word", "ws", F.inline(_bands("ws")))
           .join(F.broadcast(t.select("template", "ts", "n", "span", "width", F.inline(_bands("ts")))), ["span", "width", "band", "least"])
           .select("doc_id", "template", "word", "n", F.size(F.array_intersect("ws", "ts")).alias("shared"))
           .filter(F.col("shared") * 100 >= F.col("n") * percent))
    best = met.groupBy("doc_id", "template").agg(F.max(F.struct("shared", (-F.col("word")).alias("back"), "n")).alias("b"))
    return best.select("doc_id", "template", F.col("b.shared").cast("long").alias("shared"), F.col("b.n").cast("long").alias("shingles"),
                       (-F.col("b.back")).cast("long").alias("word"))


def oracle_sql(percent: int = 75) -> str:
    """The same by counting shared shingles of all windows, in DuckDB SQL."""
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(TEMPLATES.items()))
    gaps = GAPS.replace("'", "''")
    return f"""
        WITH t0 AS (SELECT template, list_filter(regexp_split_to_array(lower(text), '{gaps}'), lambda x: x <> '') AS w
                    FROM (VALUES {rows}) v(template, text)),
        t1 AS (SELECT DISTINCT template, least(len(w), {SHINGLE}) AS width, array_to_string(w[i + 1:i + {SHINGLE}], ' ') AS h
               FROM t0, range(greatest(len(w) - {SHINGLE - 1}, 1)) r(i)),
        t AS (SELECT template, width, h, count(*) OVER (PARTITION BY template) AS n FROM t1),
        s AS (SELECT template, width, h, n, (2 ** ceil(log2(2 * n)))::INT AS span FROM t),
        d0 AS (SELECT doc_id, row_number() OVER () AS r,
                      list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{gaps}'), lambda x: x <> '') AS w FROM documents),
        d AS (SELECT doc_id, r, i, width, array_to_string(w[i + 1:i + width], ' ') AS h
              FROM d0, (SELECT DISTINCT width FROM t1) v, LATERAL (SELECT unnest(range(len(w) - width + 1)) AS i)),
        hits AS (SELECT doc_id, r, i, template, d.h, n, span FROM d JOIN s ON d.h = s.h AND d.width = s.width),
        held AS (SELECT doc_id, r, template, n, k * span // 2 AS word, count(DISTINCT h) AS shared
                 FROM hits, LATERAL (SELECT unnest(range(greatest(i // (span // 2) - 1, 0), i // (span // 2) + 1)) AS k)
                 GROUP BY ALL HAVING count(DISTINCT h) * 100 >= n * {percent})
        SELECT doc_id, template, max(shared) AS shared, any_value(n) AS shingles,
               -max(struct_pack(a := shared, b := -word)).b AS word
        FROM held GROUP BY doc_id, template"""
