"""The query registry: Spark plans and their DuckDB oracle SQL.

Every query reads whole driver tables (or corpora Spark derives from them);
column names and types are aliased identically on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.html import html_to_text
from ..functions.labels import lambda_display, lambda_k, lambda_label, safe_name
from ..functions.text import encode_tokens, shingle_hashes, tokenize
from ..operators import bitmaps, compare, longform, report, revisions, runs, runtime
from ..operators.shingle import n_distinct, parse_lambdas, shingle, sketch
from ..session import scratch_path, work_partitions
from ..sources import api, buckets, cells
from ..sources import dumps as dumps_src
from ..sources import sinks
from . import fixtures as fx
from . import jobs
from .oracle import WS, grid_values, jaccard_select, shingle_ctes, tokens_expr

# The reference's parameter grid.
WS_GRID = (25, 50)
LAMBDAS = ("8", "16", "32", "64", "inf")
FINITE = ("8", "16", "32", "64")

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return fx.read_table(spark, sf, "documents")


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Texts dealt evenly to the hash-heavy stage behind, whatever the files' splits."""
    return df.repartition(work_partitions(df.sparkSession), key)


# ---------------------------------------------------------------- Spark side

def q_tokenize_docs(spark, sf):
    d = _docs(spark, sf).select("doc_id", tokenize("text").alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"),
                    F.try_element_at("t", F.lit(1)).alias("first_token"),
                    F.try_element_at("t", F.lit(-1)).alias("last_token"))


def q_shingle_hash_w2(spark, sf):
    d = _spread(_docs(spark, sf), "doc_id").select(
        "doc_id", encode_tokens(tokenize("text")).alias("e"))
    return d.select("doc_id", F.posexplode(shingle_hashes("e", 2)).alias("pos", "shingle")) \
            .select("doc_id", (F.col("pos") + 1).alias("pos"), "shingle")


def q_shingles_sorted(spark, sf):
    sh = shingle(_spread(_docs(spark, sf), "doc_id"), WS_GRID, keys=("doc_id",))
    return sh.select("doc_id", "w", "n_tokens",
                     F.size("shingles").alias("n_shingles"),
                     F.size(F.array_distinct("shingles")).alias("n_distinct"),
                     F.try_element_at("shingles", F.lit(1)).alias("min_hash"),
                     F.try_element_at("shingles", F.lit(-1)).alias("max_hash"),
                     F.md5(F.array_join("shingles", ",")).alias("list_md5"))


def q_sketch_top_lambda(spark, sf):
    """Finite-lambda sketches of every document as rows (long form, W4):
    [doc_id, w, lambda, rank, shingle]."""
    docs = _spread(_docs(spark, sf).select("doc_id", "text"), "doc_id")
    top = longform.bottom_k(docs, WS_GRID, max(int(x) for x in FINITE), keys=("doc_id",))
    grid = F.array(*[F.struct(F.lit(x).alias("lambda"), F.lit(int(x)).alias("k")) for x in FINITE])
    return top.select("doc_id", "w", "rank", "shingle", F.inline(grid)).filter(
        F.col("rank") <= F.col("k")).select("doc_id", "w", "lambda", "rank", "shingle")


def q_shingle_runs(spark, sf):
    """Whole shingle lists in runs by digest range, written and read back run by run."""
    docs = _spread(_docs(spark, sf).select("doc_id", "text"), "doc_id")
    path = _scratch(spark, "shingle-runs")
    sinks.write_runs(runs.sorted_runs(docs, WS_GRID, keys=("doc_id",), run_digests=256), path, "doc_id long")
    return runs.list_stats(sinks.read_runs(spark, path, "doc_id long"), keys=("doc_id",))


def _chain(spark, sf):
    return fx.revision_chain(_docs(spark, sf))


def q_sketch_sizes(spark, sf):
    sk = sketch(shingle(_chain(spark, sf), WS_GRID, repeats=True), LAMBDAS)
    return sk.select("page", "version", "w", "lambda",
                     F.size("sketch").alias("n_sketch"),
                     n_distinct("sketch", "repeats").alias("n_distinct"),
                     F.md5(F.array_join("sketch", ",")).alias("sketch_md5"))


def _sim(spark, sf):
    return compare.compare_texts(_chain(spark, sf), WS_GRID, LAMBDAS, prepartitioned=True)


def q_jaccard_to_baseline(spark, sf):
    return _sim(spark, sf).select("page", "w", "lambda", "version", "intersection",
                                  "union_size", "jaccard")


def _masks(spark, sf):
    return bitmaps.version_masks(_chain(spark, sf), WS_GRID, unique=True)


def q_jaccard_by_masks(spark, sf):
    """Similarity over all shingles from version masks (long form, U2 and U3)."""
    return bitmaps.jaccard_from_masks(_masks(spark, sf))


def q_version_set_sizes(spark, sf):
    """Shingles that all versions of a page share, and that any holds."""
    return bitmaps.set_sizes(_masks(spark, sf))


def q_jaccard_rendered(spark, sf):
    return report.render(_sim(spark, sf)).select("page", "w", "lambda", "version", "jaccard_6dp")


def q_lambda_mae(spark, sf):
    return report.lambda_mae(_sim(spark, sf), FINITE)


def q_best_lambda(spark, sf):
    return report.best_lambda(report.lambda_mae(_sim(spark, sf), FINITE))


def q_detailed(spark, sf):
    return report.detailed(_sim(spark, sf))


def q_similarity_series(spark, sf):
    return report.series_summary(_sim(spark, sf))


def q_similarity_curves_wide(spark, sf):
    return report.curves_wide(_sim(spark, sf), LAMBDAS)


def q_corpus_catalog(spark, sf):
    return revisions.catalog_summary(fx.editions(_docs(spark, sf)))


def q_skipped_pages(spark, sf):
    return compare.skipped_pages(fx.editions(_docs(spark, sf)))


def q_missing_sketches(spark, sf):
    """What a stored sketch table lacks: it was written without the lambda-16
    sketches of version 63 and without the pages that end in 7, and lambda 32
    was never computed."""
    chain = _chain(spark, sf).filter(compare.needed_versions("version"))
    gone = F.col("page").endswith("7") | ((F.col("version") == 63) & (F.col("lambda") == "16"))
    path = _scratch(spark, "sketches")
    sinks.write_sketches(sketch(shingle(chain, (25,), least=16), ("8", "16")).filter(~gone), path)
    grid = F.array(*[F.struct(F.lit(25).alias("w"), F.lit(x).alias("lambda")) for x in ("8", "16", "32")])
    required = chain.select("page", "version", F.inline(grid))
    return compare.missing_sketches(required, sinks.read_sketches(spark, path))


def q_page_version_jaccard_w2(spark, sf):
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    sim = compare.compare_texts(f2, (2,), LAMBDAS)
    return sim.select("page", "w", "lambda", "version", "intersection", "union_size", "jaccard")


def q_revision_sampling(spark, sf):
    revs = fx.event_revisions(fx.read_table(spark, sf, "events"))
    return revisions.sample_revisions(revs, step=3, max_back=30).select("page", "revid", "offset")


def q_concat_versions(spark, sf):
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    sampled = f2.filter(F.col("version") % 3 == 0)
    cat = revisions.concat_versions(sampled)
    return cat.select("page", "n_parts", F.md5("text").alias("text_md5"),
                      F.length("text").alias("text_length"))


def q_concat_parts(spark, sf):
    """Concatenated pages in parts of 16 versions, a file each, written and read back."""
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    path = _scratch(spark, "concat-parts")
    sinks.write_concatenated(revisions.concat_parts(f2.filter(F.col("version") % 3 == 0), versions_per_part=16), path)
    return sinks.read_concatenated_pages(spark, path).select(
        "page", "part_no", F.md5("text").alias("text_md5"), F.length("text").alias("text_length"))


def q_similarity_bucketed(spark, sf):
    """Similarity from a stored sketch table that is bucketed by page: no exchange behind its scan."""
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    needed = f2.filter(compare.needed_versions("version"))
    path = _scratch(spark, "sketches-bucketed")
    name = f"sketches_bucketed_{uuid.uuid4().hex}"
    stored = buckets.write_bucketed(jobs.sketch_corpus(needed, (2,), LAMBDAS), name, path, work_partitions(spark))
    return compare.sketch_similarity(stored).select("page", "w", "lambda", "version", "intersection", "union_size", "jaccard")


def q_lambda_labels(spark, sf):
    """lambda values requested per event (props.k, plus 'INF' for error events):
    normalised label, sketch size and display labels; 0 is rejected (NULL)."""
    ev = fx.read_table(spark, sf, "events")
    raw = F.when(F.col("event_type") == "error", F.lit("INF")).otherwise(F.get_json_object("props", "$.k"))
    lab = ev.select("event_id", raw.alias("raw")).withColumn("lambda", lambda_label("raw"))
    return lab.select("event_id", "raw", "lambda", lambda_k("lambda").alias("k"),
                      lambda_display("lambda").alias("series_label"),
                      lambda_display("lambda", "timing").alias("timing_label"))


def q_runtime_summary(spark, sf):
    runs = fx.runs_from_events(fx.read_table(spark, sf, "events"))
    return runtime.runtime_summary(runs)


def q_runtime_runs_wide(spark, sf):
    runs = fx.runs_from_events(fx.read_table(spark, sf, "events"))
    return runtime.runs_wide(runs, keys=("w", "lambda", "session"))


def q_api_json_ingest(spark, sf):
    """Revision metadata landed as API JSON pages (50 revisions per response,
    the newest ``max_back + 1`` per page as the collector requests them,
    built from the events log), parsed back and given offsets."""
    max_count = compare.MAX_BACK + 1
    revs = fx.event_revisions(fx.read_table(spark, sf, "events"))
    order = Window.partitionBy("page").orderBy(F.desc("timestamp"), F.desc("revid"))
    # rank alone first so the limit becomes a WindowGroupLimit below the shuffle;
    # one extra row keeps the parent id of the oldest kept revision.
    top = revs.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= max_count + 1)
    ranked = top.withColumn("parentid", F.lead("revid").over(order)).filter(F.col("_rn") <= max_count)
    batched = ranked.withColumn("_batch", F.floor((F.col("_rn") - 1) / 50))
    entry = F.struct("_rn", "revid", "parentid", "timestamp", "user", "size", "comment")
    responses = batched.groupBy("page", "_batch").agg(F.to_json(F.struct(F.struct(F.array(F.struct(
        F.col("page").alias("title"),
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e.dropFields("_rn")).alias("revisions"),
    )).alias("pages")).alias("query"))).alias("body"))
    parsed = api.revisions_from_responses(responses).withColumnRenamed("title", "page")
    with_offsets = revisions.revision_offsets(parsed, max_count=max_count)
    return with_offsets.select("page", "revid", "parentid", "user", "size", "offset")


def q_file_key_parse(spark, sf):
    """Dump file names (from documents) mixed with other files (page URLs)."""
    d = _docs(spark, sf).select("doc_id", "lang", tokenize("text").alias("t"))
    dumps = d.select(F.concat(safe_name(F.try_element_at("t", F.lit(1))), F.lit("_"), F.upper("lang"),
                              F.lit("_C-"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    others = fx.read_table(spark, sf, "pages").select(F.regexp_extract("url", "[^/]+$", 0).alias("name"))
    names = dumps.unionByName(others).filter(F.col("name").isNotNull())
    parsed = names.select("name", *dumps_src.parse_dump_name("name"))
    return parsed.select("name", "city", "state", "page", "version",
                         F.col("version").isNotNull().alias("ok"),
                         F.size(F.split("page", "_")).alias("key_parts"))


def q_html_to_text(spark, sf):
    """Parse responses (built from pages) -> parse.text -> article text."""
    pages = _spread(fx.read_table(spark, sf, "pages"), "page_id")
    responses = pages.select("page_id", F.to_json(F.struct(F.struct(F.col("html").alias("text")).alias("parse"))).alias("body"))
    ok, _ = api.split_parse_responses(responses)
    txt = ok.select("page_id", html_to_text("html", (".mw-parser-output", "article")).alias("text"))
    return txt.select("page_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"), "text")


def _small_sim(spark, sf):
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    return report.render(compare.compare_texts(f2, (2,), LAMBDAS))


def q_similarity_csv(spark, sf):
    """The similarity CSV, written and read back."""
    path = _scratch(spark, "similarity-csv")
    sinks.write_jaccard_csv(_small_sim(spark, sf), path)
    return sinks.read_jaccard_csv(spark, path)


def q_similarity_table(spark, sf):
    """Read-through similarity table: two cells first, then the grid around them."""
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    path = _scratch(spark, "similarity")
    jobs.materialize_similarity(spark, f2, path, (2,), ("8", "inf"))
    return jobs.materialize_similarity(spark, f2, path, (2,), LAMBDAS).select(
        "page", "w", "lambda", "version", "intersection", "union_size", "jaccard_6dp")


def q_similarity_cells(spark, sf):
    """Cells of two read-through tables as their manifests have them: pages with
    targets, and baselines alone, whose cells are there without rows."""
    f2 = fx.sources_as_pages_upto(_docs(spark, sf), compare.MAX_BACK)
    out = None
    for pages, texts in (("all", f2), ("baselines", f2.filter("version = 0"))):
        path = _scratch(spark, f"similarity-cells-{pages}")
        for lambdas in (("8",), LAMBDAS):
            jobs.materialize_similarity(spark, texts, path, (2,), lambdas)
        counts = cells.cell_counts(spark, path).select(F.lit(pages).alias("pages"), "w", "lambda", "n_rows")
        out = counts if out is None else out.unionByName(counts)
    return out


def q_summary_csv(spark, sf):
    """The summary CSV, written and read back; window size 3 has no pairs."""
    path = _scratch(spark, "summary-csv")
    sinks.write_csv(report.lambda_mae(_small_sim(spark, sf), FINITE, ws=(2, 3)), path, sinks.SUMMARY_COLUMNS)
    back = spark.read.schema("w int, `lambda` string, mae_vs_infty double").option("header", True).csv(path)
    return back.select("w", "lambda", F.when(~F.isnan("mae_vs_infty"), F.col("mae_vs_infty")).alias("mae_vs_infty"))


def q_timing_csv(spark, sf):
    """The timing CSV of all sessions, written and read back."""
    runs = fx.runs_from_events(fx.read_table(spark, sf, "events"))
    path = _scratch(spark, "timing-csv")
    sinks.write_csv(runtime.runs_wide(runs, keys=("w", "lambda", "session")), path, ("session", *sinks.TIMING_COLUMNS))
    columns = ", ".join(f"`{c}` double" for c in sinks.TIMING_COLUMNS[2:])
    return spark.read.schema(f"session int, w int, `lambda` string, {columns}").option("header", True).csv(path)


def q_sketch_lines(spark, sf):
    """The line export of sketches, written and read back (short documents: empty sketches)."""
    docs = _spread(_docs(spark, sf), "doc_id").select(F.col("doc_id").cast("string").alias("page"), F.lit(0).alias("version"), "text")
    path = _scratch(spark, "sketch-lines")
    sinks.export_sketch_lines(sketch(shingle(docs, (25,)), ("8", "16")), path)
    return sinks.import_sketch_lines(spark, path).select(
        "page", "w", F.col("lambda").cast("string").alias("lambda"), F.size("sketch").alias("n_sketch"),
        F.md5(F.array_join("sketch", ",")).alias("sketch_md5"))


def q_page_listing(spark, sf):
    return revisions.page_listing(fx.editions(_docs(spark, sf)))


def q_grid_axes(spark, sf):
    ws, lams = runtime.grid_axes(fx.runs_from_events(fx.read_table(spark, sf, "events")))
    return ws.select(F.lit("w").alias("axis"), F.col("w").cast("string").alias("value")).unionByName(
        lams.select(F.lit("lambda").alias("axis"), F.col("lambda").alias("value")))


def q_page_key_split(spark, sf):
    """City and state of page keys; a key that does not split in two has neither."""
    docs = _docs(spark, sf).select("doc_id", F.concat_ws("_", F.try_element_at(tokenize("text"), F.lit(1)), F.upper("lang")).alias("key"))
    return docs.select("doc_id", "key", *revisions.split_page_key("key"))


def q_revision_corpus(spark, sf):
    """The events log as revisions with rendered HTML, to sampled texts, written and read back."""
    events = fx.read_table(spark, sf, "events")
    rendered = events.select(F.col("event_id").alias("revid"), F.concat(
        F.lit('<div class="mw-parser-output"><h2>'), F.col("event_type"), F.lit("</h2><table><tr><td>no</td></tr></table><ul><li>"),
        F.col("user_id").cast("string"), F.lit("</li></ul></div>")).alias("html"))
    path = _scratch(spark, "versions")
    sinks.write_versions(jobs.revision_corpus(fx.event_revisions(events), rendered, 3, compare.MAX_BACK), path)
    return spark.read.parquet(path)


def queries() -> dict[str, Query]:
    return {
        "similarity_csv": q_similarity_csv,
        "similarity_table": q_similarity_table,
        "similarity_cells": q_similarity_cells,
        "summary_csv": q_summary_csv,
        "timing_csv": q_timing_csv,
        "sketch_lines": q_sketch_lines,
        "page_listing": q_page_listing,
        "grid_axes": q_grid_axes,
        "page_key_split": q_page_key_split,
        "revision_corpus": q_revision_corpus,
        "tokenize_docs": q_tokenize_docs,
        "shingle_hash_w2": q_shingle_hash_w2,
        "shingles_sorted": q_shingles_sorted,
        "shingle_runs": q_shingle_runs,
        "sketch_sizes": q_sketch_sizes,
        "sketch_top_lambda": q_sketch_top_lambda,
        "jaccard_to_baseline": q_jaccard_to_baseline,
        "jaccard_by_masks": q_jaccard_by_masks,
        "version_set_sizes": q_version_set_sizes,
        "jaccard_rendered": q_jaccard_rendered,
        "lambda_mae": q_lambda_mae,
        "best_lambda": q_best_lambda,
        "detailed": q_detailed,
        "similarity_series": q_similarity_series,
        "similarity_curves_wide": q_similarity_curves_wide,
        "corpus_catalog": q_corpus_catalog,
        "skipped_pages": q_skipped_pages,
        "missing_sketches": q_missing_sketches,
        "page_version_jaccard_w2": q_page_version_jaccard_w2,
        "revision_sampling": q_revision_sampling,
        "similarity_bucketed": q_similarity_bucketed,
        "concat_versions": q_concat_versions,
        "concat_parts": q_concat_parts,
        "lambda_labels": q_lambda_labels,
        "runtime_summary": q_runtime_summary,
        "runtime_runs_wide": q_runtime_runs_wide,
        "api_json_ingest": q_api_json_ingest,
        "file_key_parse": q_file_key_parse,
        "html_to_text": q_html_to_text,
    }


# ---------------------------------------------------------------- SQL side

_GRID = grid_values(parse_lambdas(LAMBDAS))
_CHAIN_VERSIONS = ", ".join(str(v) for v in fx.CHAIN_VERSIONS)

_F1 = f"""f1_tok AS (
  SELECT CAST(doc_id AS VARCHAR) AS page, {tokens_expr()} AS t FROM documents),
f1 AS (
  SELECT page, CAST(v AS INTEGER) AS version, array_to_string(t[v + 1:], ' ') AS text
  FROM f1_tok CROSS JOIN (SELECT unnest([{_CHAIN_VERSIONS}]) AS v) vs)"""

_TARGET = "version % 3 = 0 AND version <> 0 AND version <= 147"
# Dump file-name pattern.
_DUMP_RE = r"^(.+?)_(\w{2})_C-(\d+)\.txt$"


#: Python's white space, as a DuckDB string.
_SPACES = " || ".join(f"chr({c})" for c in range(0x3001) if chr(c).isspace())


def _sim_sql(src: str, ws: tuple[int, ...]) -> str:
    """CTE ``sim`` (page, w, "lambda", k, version, intersection, union_size, jaccard)."""
    return f"""{shingle_ctes(src + "_needed", ["page", "version"], list(ws))},
base AS (SELECT page, w, shingles FROM sh_list WHERE version = 0),
tgt AS (SELECT page, w, version, shingles FROM sh_list WHERE {_TARGET}),
grid AS (SELECT * FROM (VALUES {_GRID}) g("lambda", k)),
sim0 AS (
  SELECT t.page, t.w, g."lambda", g.k, t.version,
         {jaccard_select("b.shingles", "t.shingles", "g.k")}
  FROM tgt t JOIN base b ON t.page = b.page AND t.w = b.w CROSS JOIN grid g),
sim AS (
  SELECT page, CAST(w AS INTEGER) AS w, "lambda", CAST(k AS INTEGER) AS k, version,
         CAST(intersection AS INTEGER) AS intersection, CAST(union_size AS INTEGER) AS union_size,
         CASE WHEN union_size = 0 THEN 1.0 ELSE intersection::DOUBLE / union_size::DOUBLE END AS jaccard
  FROM sim0)"""


_F1_SIM = f"""WITH {_F1},
f1_needed AS (SELECT page, version, text FROM f1 WHERE version = 0 OR ({_TARGET})),
{_sim_sql("f1", WS_GRID)}"""

_RENDERED = """rendered AS (
  SELECT page, w, "lambda", version, jaccard, printf('%.6f', jaccard) AS jaccard_6dp,
         CAST(round(CAST(printf('%.6f', jaccard) AS DOUBLE) * 1000000) AS BIGINT) AS jm
  FROM sim)"""

_MAE = f"""{_RENDERED},
per_pair AS (
  SELECT w, page, version,
         max(jm) FILTER (WHERE "lambda" = 'inf') AS j_inf,
         max(jm) FILTER (WHERE "lambda" = '8') AS l8, max(jm) FILTER (WHERE "lambda" = '16') AS l16,
         max(jm) FILTER (WHERE "lambda" = '32') AS l32, max(jm) FILTER (WHERE "lambda" = '64') AS l64
  FROM rendered GROUP BY w, page, version),
errs AS (
  SELECT w, '8' AS "lambda", abs(l8 - j_inf) AS err FROM per_pair UNION ALL
  SELECT w, '16', abs(l16 - j_inf) FROM per_pair UNION ALL
  SELECT w, '32', abs(l32 - j_inf) FROM per_pair UNION ALL
  SELECT w, '64', abs(l64 - j_inf) FROM per_pair),
mae AS (
  SELECT w, "lambda", CAST(count(err) AS BIGINT) AS n_pairs,
         CASE WHEN count(err) = 0 THEN 'NaN'::DOUBLE
              ELSE CAST(sum(err) AS BIGINT)::DOUBLE / count(err) / 1e6 END AS mae_vs_infty
  FROM errs GROUP BY w, "lambda")"""


def oracle_sql() -> dict[str, str]:
    sh_docs = shingle_ctes("documents", ["doc_id"], list(WS_GRID))
    f1_rows = f"""WITH {_F1},
f1_needed AS (SELECT page, version, text FROM f1 WHERE version = 0 OR ({_TARGET})),
{shingle_ctes("f1_needed", ["page", "version"], list(WS_GRID), "m")},
d AS (SELECT DISTINCT page, version, w, h FROM m_win)"""
    sh_w2 = shingle_ctes("documents", ["doc_id"], [2])
    sh_chain = shingle_ctes("f1", ["page", "version"], list(WS_GRID))
    f2_upto = """f2 AS (
  SELECT page, version, doc_id, text FROM (
    SELECT source AS page, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS version,
           doc_id, text FROM documents) WHERE version <= 147)"""
    editions = """ed AS (
  SELECT concat_ws('/', source, lang) AS page,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS INTEGER) AS version
  FROM documents)"""
    runs = """runs AS (
  SELECT w, "lambda", CAST(rn // 4 AS INTEGER) AS session, CAST(rn % 4 AS INTEGER) AS run, rn % 4 = 0 AS is_warmup, seconds FROM (
    SELECT w, "lambda", seconds, row_number() OVER (PARTITION BY w, "lambda" ORDER BY event_id) - 1 AS rn
    FROM (SELECT CASE WHEN event_id % 2 = 0 THEN 25 ELSE 50 END AS w,
                 CASE event_type WHEN 'click' THEN '8' WHEN 'view' THEN '16' WHEN 'purchase' THEN '32'
                      WHEN 'signup' THEN '64' WHEN 'error' THEN 'inf' END AS "lambda",
                 event_id, value AS seconds FROM events)))"""
    f2_sim = f"""WITH {f2_upto},
f2_needed AS (SELECT page, version, text FROM f2 WHERE version = 0 OR ({_TARGET})),
{_sim_sql("f2", (2,))}"""
    pieces = "array_to_string(list_filter(list_transform(regexp_split_to_array({}, '<[^>]*>'), " \
             "lambda s: trim(replace(replace(s, '&quot;', '\"'), '&amp;', '&'), " + _SPACES + ")), lambda s: s <> ''), ' ')"
    return {
        "html_to_text": f"""
WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<article><h1>(.*?)</h1>', 1) AS h,
                  regexp_extract(html, '(?s)</h1>(.*)</article>', 1) AS b FROM pages),
-- the first paragraph is never closed, so all that follows the heading is one block
t AS (SELECT page_id, regexp_replace({pieces.format("h")} || chr(10) || chr(10) || {pieces.format("b")}, '[ \t]{{2,}}', ' ', 'g') AS text FROM p)
SELECT page_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5, text FROM t""",
        "similarity_csv": f"""{f2_sim}
SELECT page AS city, w, "lambda", version, CAST(printf('%.6f', jaccard) AS DOUBLE) AS jaccard FROM sim""",
        "similarity_table": f"""{f2_sim}
SELECT page, w, "lambda", version, intersection, union_size, printf('%.6f', jaccard) AS jaccard_6dp FROM sim""",
        "similarity_cells": f"""{f2_sim}
SELECT 'all' AS pages, w, "lambda", count(*) AS n_rows FROM sim GROUP BY w, "lambda" UNION ALL
SELECT DISTINCT 'baselines', w, "lambda", 0 FROM sim""",
        "summary_csv": f"""{f2_sim},
{_MAE}
SELECT w, "lambda", mae_vs_infty FROM mae UNION ALL
SELECT 3, unnest(['8', '16', '32', '64']), NULL""",
        "timing_csv": f"""WITH {runs}
SELECT session, CAST(w AS INTEGER) AS w, CASE WHEN "lambda" = 'inf' THEN '∞' ELSE "lambda" END AS "lambda",
       max(seconds) FILTER (WHERE run = 1) AS run1, max(seconds) FILTER (WHERE run = 2) AS run2,
       max(seconds) FILTER (WHERE run = 3) AS run3,
       round(avg(seconds), 9) AS mean, round(stddev_pop(seconds), 9) AS std, min(seconds) AS "min", max(seconds) AS "max"
FROM runs WHERE NOT is_warmup GROUP BY w, "lambda", session""",
        "sketch_lines": f"""WITH {shingle_ctes("documents", ["doc_id"], [25])},
grid AS (SELECT * FROM (VALUES ('8', 8), ('16', 16)) g("lambda", k))
SELECT CAST(doc_id AS VARCHAR) AS page, CAST(w AS INTEGER) AS w, "lambda",
       CAST(len(shingles[1:k]) AS INTEGER) AS n_sketch, md5(array_to_string(shingles[1:k], ',')) AS sketch_md5
FROM sh_list CROSS JOIN grid""",
        "page_listing": f"""WITH {editions} SELECT DISTINCT page FROM ed""",
        "grid_axes": f"""WITH {runs}
SELECT DISTINCT 'w' AS axis, CAST(w AS VARCHAR) AS "value" FROM runs
UNION ALL SELECT DISTINCT 'lambda', "lambda" FROM runs WHERE "lambda" <> 'inf'""",
        "page_key_split": f"""
SELECT doc_id, "key", CASE WHEN len(p) = 2 THEN p[1] END AS city, CASE WHEN len(p) = 2 THEN p[2] END AS state
FROM (SELECT doc_id, "key", string_split("key", '_') AS p FROM (
  SELECT doc_id, concat_ws('_', t[1], upper(lang)) AS "key" FROM (SELECT doc_id, lang, {tokens_expr()} AS t FROM documents)))""",
        "revision_corpus": """
SELECT page, CAST(rn - 1 AS INTEGER) AS version, event_type || chr(10) || chr(10) || '- ' || page AS text FROM (
  SELECT CAST(user_id AS VARCHAR) AS page, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 148 AND (rn - 1) % 3 = 0""",
        "tokenize_docs": f"""
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, t[1] AS first_token, t[-1] AS last_token
FROM (SELECT doc_id, {tokens_expr()} AS t FROM documents)""",
        "shingle_hash_w2": f"""WITH {sh_w2}
SELECT doc_id, CAST(i AS INTEGER) AS pos, h AS shingle FROM sh_win""",
        "shingles_sorted": f"""WITH {sh_docs}
SELECT doc_id, CAST(w AS INTEGER) AS w, CAST(n_tokens AS INTEGER) AS n_tokens,
       CAST(len(shingles) AS INTEGER) AS n_shingles,
       CAST(len(list_distinct(shingles)) AS INTEGER) AS n_distinct,
       shingles[1] AS min_hash, shingles[-1] AS max_hash,
       md5(array_to_string(shingles, ',')) AS list_md5
FROM sh_list""",
        "shingle_runs": f"""WITH {sh_docs}
SELECT doc_id, CAST(w AS INTEGER) AS w, CAST(n_tokens AS BIGINT) AS n_tokens,
       CAST(greatest(ceil(len(shingles) / 256.0), 1) AS INTEGER) AS n_runs, CAST(len(shingles) AS BIGINT) AS n_shingles,
       CAST(len(list_distinct(shingles)) AS BIGINT) AS n_distinct, shingles[1] AS min_hash, shingles[-1] AS max_hash,
       md5(array_to_string(shingles, ',')) AS list_md5
FROM sh_list""",
        "sketch_sizes": f"""WITH {_F1},
{sh_chain},
grid AS (SELECT * FROM (VALUES {_GRID}) g("lambda", k))
SELECT page, version, CAST(w AS INTEGER) AS w, "lambda",
       CAST(len(shingles[1:k]) AS INTEGER) AS n_sketch,
       CAST(len(list_distinct(shingles[1:k])) AS INTEGER) AS n_distinct,
       md5(array_to_string(shingles[1:k], ',')) AS sketch_md5
FROM sh_list CROSS JOIN grid""",
        "sketch_top_lambda": f"""WITH {sh_docs},
r AS (SELECT doc_id, w, i, h, row_number() OVER (PARTITION BY doc_id, w ORDER BY h, i) AS rnk FROM sh_win),
grid AS (SELECT * FROM (VALUES ('8', 8), ('16', 16), ('32', 32), ('64', 64)) g("lambda", k))
SELECT doc_id, CAST(w AS INTEGER) AS w, g."lambda", CAST(rnk AS INTEGER) AS "rank", h AS shingle
FROM r JOIN grid g ON r.rnk <= g.k""",
        "jaccard_to_baseline": f"""{_F1_SIM}
SELECT page, w, "lambda", version, intersection, union_size, jaccard FROM sim""",
        "jaccard_by_masks": f"""{f1_rows},
n AS (SELECT page, version, w, count(*) AS c FROM d GROUP BY ALL),
i AS (SELECT b.page, b.w, b.version, count(*) AS c FROM d a JOIN d b ON a.page = b.page AND a.w = b.w AND a.h = b.h
      WHERE a.version = 0 AND b.version <> 0 GROUP BY ALL),
s AS (SELECT f.page, g.w, f.version, coalesce(i.c, 0) AS x, coalesce(n0.c, 0) + coalesce(n.c, 0) - coalesce(i.c, 0) AS u
      FROM f1_needed f CROSS JOIN (SELECT unnest({list(WS_GRID)}) AS w) g
      JOIN (SELECT page FROM f1_needed WHERE version = 0) z ON z.page = f.page
      LEFT JOIN n n0 ON n0.page = f.page AND n0.w = g.w AND n0.version = 0
      LEFT JOIN n ON n.page = f.page AND n.w = g.w AND n.version = f.version
      LEFT JOIN i ON i.page = f.page AND i.w = g.w AND i.version = f.version WHERE f.version <> 0)
SELECT page, CAST(w AS INTEGER) AS w, version, CAST(x AS INTEGER) AS intersection, CAST(u AS INTEGER) AS union_size,
       CASE WHEN u = 0 THEN 1.0 ELSE x::DOUBLE / u END::DOUBLE AS jaccard FROM s""",
        "version_set_sizes": f"""{f1_rows},
v AS (SELECT page, count(*) AS n_versions FROM f1_needed GROUP BY page),
c AS (SELECT page, w, h, count(*) AS c FROM d GROUP BY ALL),
s AS (SELECT c.page, w, count(*) FILTER (WHERE c = n_versions) AS n_shared, count(*) AS n_union
      FROM c JOIN v ON v.page = c.page GROUP BY ALL)
SELECT v.page, CAST(g.w AS INTEGER) AS w, CAST(n_versions AS INTEGER) AS n_versions,
       coalesce(n_shared, 0)::BIGINT AS n_shared, coalesce(n_union, 0)::BIGINT AS n_union
FROM v CROSS JOIN (SELECT unnest({list(WS_GRID)}) AS w) g LEFT JOIN s ON s.page = v.page AND s.w = g.w""",
        "jaccard_rendered": f"""{_F1_SIM},
{_RENDERED}
SELECT page, w, "lambda", version, jaccard_6dp FROM rendered""",
        "lambda_mae": f"""{_F1_SIM},
{_MAE}
SELECT w, "lambda", n_pairs, mae_vs_infty FROM mae""",
        "best_lambda": f"""{_F1_SIM},
{_MAE},
best AS (
  SELECT w, arg_min("lambda", (mae_vs_infty, k)) AS best_lambda, min(mae_vs_infty) AS best_mae
  FROM (SELECT *, CAST("lambda" AS INTEGER) AS k FROM mae WHERE NOT isnan(mae_vs_infty))
  GROUP BY w)
SELECT ww.w, b.best_lambda, b.best_mae
FROM (SELECT DISTINCT w FROM mae) ww LEFT JOIN best b ON b.w = ww.w""",
        "detailed": f"""{_F1_SIM},
{_RENDERED}
SELECT page, w, "lambda", version, CAST(jaccard_6dp AS DOUBLE) AS jaccard FROM rendered""",
        "similarity_series": f"""{_F1_SIM},
{_RENDERED}
SELECT page, w, "lambda",
       CAST(CASE WHEN "lambda" = 'inf' THEN 2147483647 ELSE CAST("lambda" AS INTEGER) END AS INTEGER) AS lambda_order,
       CAST(count(*) AS INTEGER) AS n_points,
       arg_min(version, version) AS first_version,
       CAST(arg_min(jaccard_6dp, version) AS DOUBLE) AS first_jaccard,
       arg_max(version, version) AS last_version,
       CAST(arg_max(jaccard_6dp, version) AS DOUBLE) AS last_jaccard
FROM rendered GROUP BY page, w, "lambda"
""",
        "similarity_curves_wide": f"""{_F1_SIM},
{_RENDERED}
SELECT page, w, version,
       max(CAST(jaccard_6dp AS DOUBLE)) FILTER (WHERE "lambda" = '8') AS lam_8,
       max(CAST(jaccard_6dp AS DOUBLE)) FILTER (WHERE "lambda" = '16') AS lam_16,
       max(CAST(jaccard_6dp AS DOUBLE)) FILTER (WHERE "lambda" = '32') AS lam_32,
       max(CAST(jaccard_6dp AS DOUBLE)) FILTER (WHERE "lambda" = '64') AS lam_64,
       max(CAST(jaccard_6dp AS DOUBLE)) FILTER (WHERE "lambda" = 'inf') AS lam_inf
FROM rendered GROUP BY page, w, version""",
        "corpus_catalog": f"""WITH {editions}
SELECT page, CAST(count(DISTINCT version) AS BIGINT) AS n_versions,
       min(version) AS min_version, max(version) AS max_version,
       CAST(count(DISTINCT version) FILTER (WHERE {_TARGET}) AS BIGINT) AS n_targets,
       bool_or(version = 0) AS has_baseline
FROM ed GROUP BY page""",
        "skipped_pages": f"""WITH {editions},
pp AS (SELECT page, bool_or(version = 0) AS hb, bool_or({_TARGET}) AS ht FROM ed GROUP BY page)
SELECT page, CASE WHEN NOT hb THEN 'missing version 0' ELSE 'no target versions' END AS reason
FROM pp WHERE NOT hb OR NOT ht""",
        "missing_sketches": f"""WITH {_F1},
f1n AS (SELECT page, version FROM f1 WHERE version = 0 OR ({_TARGET}))
SELECT page, version, 25 AS w, "lambda"
FROM f1n CROSS JOIN (SELECT unnest(['8', '16', '32']) AS "lambda") l
WHERE "lambda" = '32' OR page LIKE '%7' OR (version = 63 AND "lambda" = '16')""",
        "page_version_jaccard_w2": f"""WITH {f2_upto},
f2_needed AS (SELECT page, version, text FROM f2 WHERE version = 0 OR ({_TARGET})),
{_sim_sql("f2", (2,))}
SELECT page, w, "lambda", version, intersection, union_size, jaccard FROM sim""",
        "similarity_bucketed": f"""{f2_sim}
SELECT page, w, "lambda", version, intersection, union_size, jaccard FROM sim""",
        "revision_sampling": """
SELECT page, revid, CAST(rn - 1 AS INTEGER) AS "offset" FROM (
  SELECT CAST(user_id AS VARCHAR) AS page, event_id AS revid,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn <= 31 AND (rn - 1) % 3 = 0""",
        "concat_versions": f"""WITH {f2_upto},
parts AS (SELECT page, version, text FROM f2 WHERE version % 3 = 0),
cat AS (
  SELECT page, CAST(count(*) AS BIGINT) AS n_parts,
         string_agg(text || chr(10) || repeat('=', 80) || chr(10) || chr(10), '' ORDER BY version) AS raw
  FROM parts GROUP BY page)
SELECT page, n_parts, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS text_length
FROM (SELECT page, n_parts, regexp_replace(raw, '{WS}$', '') || chr(10) AS t FROM cat)""",
        "concat_parts": f"""WITH {f2_upto},
parts AS (SELECT page, text, row_number() OVER (PARTITION BY page ORDER BY version) - 1 AS rk FROM f2 WHERE version % 3 = 0),
cat AS (
  SELECT page, CAST(rk // 16 AS INTEGER) AS part_no,
         string_agg(CASE WHEN rk > 0 THEN chr(10) ELSE '' END || text || chr(10) || repeat('=', 80) || chr(10), '' ORDER BY rk) AS t
  FROM parts GROUP BY ALL)
SELECT page, part_no, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS text_length FROM cat""",
        "runtime_summary": f"""WITH {runs}
SELECT w, "lambda",
       CASE WHEN "lambda" = 'inf' THEN '∞' ELSE "lambda" END AS lambda_display,
       CAST(count(*) AS BIGINT) AS n_runs,
       round(avg(seconds), 9) AS mean, round(stddev_pop(seconds), 9) AS std, min(seconds) AS "min", max(seconds) AS "max"
FROM runs WHERE NOT is_warmup GROUP BY w, "lambda"
""",
        "lambda_labels": """
WITH r AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'INF' ELSE json_extract_string(props, '$.k') END AS raw
  FROM events),
l AS (
  SELECT event_id, raw,
         CASE WHEN lower(trim(raw)) IN ('inf', 'infty', 'infinite') THEN 'inf'
              WHEN TRY_CAST(trim(raw) AS INTEGER) > 0 THEN CAST(TRY_CAST(trim(raw) AS INTEGER) AS VARCHAR) END AS "lambda"
  FROM r)
SELECT event_id, raw, "lambda",
       CAST(CASE WHEN "lambda" = 'inf' THEN 2147483647 ELSE TRY_CAST("lambda" AS INTEGER) END AS INTEGER) AS k,
       CASE WHEN "lambda" = 'inf' THEN '∞' ELSE 'λ=' || "lambda" END AS series_label,
       CASE WHEN "lambda" = 'inf' THEN '∞' ELSE "lambda" END AS timing_label
FROM l""",
        "api_json_ingest": """
SELECT page, revid, parentid, "user", size, "offset" FROM (
  SELECT CAST(user_id AS VARCHAR) AS page, event_id AS revid,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS parentid,
         event_type AS "user", CAST(floor(value * 100) AS BIGINT) AS size,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS INTEGER) AS "offset"
  FROM events)
WHERE "offset" < 148""",
        "file_key_parse": f"""WITH d AS (
  SELECT doc_id, lang, {tokens_expr()} AS t FROM documents),
names AS (
  SELECT regexp_replace(t[1], '[^A-Za-z0-9._-]', '-', 'g') || '_' || upper(lang) || '_C-'
         || CAST(doc_id AS VARCHAR) || '.txt' AS name FROM d
  UNION ALL
  SELECT regexp_extract(url, '[^/]+$', 0) AS name FROM pages),
p AS (
  SELECT name, regexp_matches(name, '{_DUMP_RE}') AS ok FROM names WHERE name IS NOT NULL)
SELECT name,
       CASE WHEN ok THEN regexp_extract(name, '{_DUMP_RE}', 1) END AS city,
       CASE WHEN ok THEN regexp_extract(name, '{_DUMP_RE}', 2) END AS state,
       CASE WHEN ok THEN regexp_extract(name, '{_DUMP_RE}', 1) || '_' || regexp_extract(name, '{_DUMP_RE}', 2) END AS page,
       CASE WHEN ok THEN CAST(regexp_extract(name, '{_DUMP_RE}', 3) AS INTEGER) END AS version,
       ok,
       CAST(CASE WHEN ok THEN len(string_split(regexp_extract(name, '{_DUMP_RE}', 1) || '_' || regexp_extract(name, '{_DUMP_RE}', 2), '_')) END AS INTEGER) AS key_parts
FROM p""",
        "runtime_runs_wide": f"""WITH {runs}
SELECT w, CASE WHEN "lambda" = 'inf' THEN '∞' ELSE "lambda" END AS "lambda", session,
       max(seconds) FILTER (WHERE run = 1) AS run1,
       max(seconds) FILTER (WHERE run = 2) AS run2,
       max(seconds) FILTER (WHERE run = 3) AS run3,
       round(avg(seconds), 9) AS mean, round(stddev_pop(seconds), 9) AS std, min(seconds) AS "min", max(seconds) AS "max"
FROM runs WHERE NOT is_warmup GROUP BY w, "lambda", session
""",
    }
