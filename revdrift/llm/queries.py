"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints, language, license_scan, whitening
from .common import crc32_of_id, read
from .embedding_dedup import embedding_dedup
from .exact_dedup import exact_dedup
from .near_dedup import near_dedup
from .packing import pack
from .periodic_runs import periodic_runs
from .prefix_bpe import round_trip_digests
from .quality import QUALITY
from .token_files import read_tokens, with_crc32, write_tokens
from .toxicity import toxicity

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_tokens(read(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)
    return with_crc32(read_tokens(spark, folder))


def op3_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read(spark, sf_dir, "documents"), BYTE_BPE_RANKS, public_tokenizers.PATTERN)


def _scored(classifier, docs: DataFrame, labels: DataFrame) -> DataFrame:
    weights = classifier.fit(docs, labels)
    return classifier.score(docs, weights, "text", "doc_id", classifier.is_held_out().alias("held_out"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(QUALITY, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return _scored(toxicity(docs), docs, read(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), BYTE_BPE, capacity=1024, end_id=2).placed.drop("part", "row")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(read(spark, sf_dir, "documents"), license_scan.template_table(spark))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_of_id() % 4 == 2, F.lit(False))
    return language.predict(docs, language.fit(docs.filter(~held_out)), "doc_id", "text", held_out.alias("held_out"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


def _made_periodic(id_: Column, text: Column) -> Column:
    """Of one id in ten the text whose words repeat the first of their last stretch."""
    h = F.crc32(id_.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")
    words = F.filter(F.split(text, fingerprints.GAPS), lambda w: w != "")
    made = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise("")), F.lit(0))
    return F.when(h % 10 == 0, made).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", _made_periodic(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
        F.floor(F.col("b.length") * 1000 / -F.col("b.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", whitening.quantised(F.col("embedding")).alias("x"))
    return whitening.whiten(rows, whitening.fit(rows))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = fingerprints.with_next(fingerprints.fingerprints(read(spark, sf_dir, "documents")), "text", "fingerprint")
    n = F.length("text").cast("int")
    half = F.floor(n / 2).cast("int")
    edited = own.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", "next_fingerprint",
                        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    both = edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "next_fingerprint",
                         fingerprints.fingerprint(F.col("edited")).alias("edited_fingerprint"))
    return both.select("doc_id", "n_chars", "edited_sha256", F.array_join("fingerprint", "").alias("fingerprint"),
                       F.array_join("edited_fingerprint", "").alias("edited_fingerprint"),
                       fingerprints.containment(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       fingerprints.containment(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # beside the package, at the top of the repository

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_token_files": op2_token_files,
        "op3_prefix_bpe": op3_prefix_bpe,
        "op4_quality": op4_quality,
        "op5_toxicity": op5_toxicity,
        "op6_packing": op6_packing,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_license_scan": op8_license_scan,
        "op9_language": op9_language,
        "op10_embedding_dedup": op10_embedding_dedup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_whitening": op12_whitening,
        "op13_fingerprints": op13_fingerprints,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        # all pairs that share a shingle, and the least id that links reach
        "op1_near_dedup": r"""
            WITH RECURSIVE w AS (
                SELECT doc_id, list_filter(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS t FROM documents),
            s AS (SELECT DISTINCT doc_id, array_to_string(t[i + 1:i + 5], ' ') AS h
                  FROM w, LATERAL (SELECT unnest(range(greatest(len(t) - 4, 1))) AS i) WHERE len(t) > 0),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
            p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id
                  GROUP BY a.doc_id, b.doc_id),
            l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
            r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
            c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
            SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
            FROM documents d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
        "op8_license_scan": license_scan.oracle_sql(),
        # the cosine of doubles; classes of links by the least id that spreads
        "op10_embedding_dedup": """
            WITH RECURSIVE v AS (
                SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                WHERE vec_id IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
            l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
            r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
                  UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
            c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
            n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
            SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
            FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
        # every pair of equal six-word sequences of a document, stretches of one distance, and the smallest
        # distance of those that cover the same words
        "op11_periodic_runs": r"""
            WITH h AS (SELECT doc_id, text, xor(4294967295, list_reduce(
                           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                           lambda c, x: list_reduce([xor(c, x), 1, 1, 1, 1, 1, 1, 1, 1],
                                                    lambda y, k: xor(y >> 1, 3988292384::BIGINT * (y & 1))))) AS h FROM documents),
            w0 AS (SELECT doc_id, h % 10 = 0 AS made, h // 10 AS g,
                          list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM h),
            w1 AS (SELECT doc_id, made, w, len(w) AS n, CASE WHEN made AND len(w) > 0 THEN g % len(w) END AS a, g FROM w0),
            w2 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w1),
            d AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
                      list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM w2),
            s AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM d, LATERAL (SELECT unnest(range(n - 5)) AS i) WHERE n >= 6),
            e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
            k AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS t FROM e),
            c AS (SELECT doc_id, q, min(i) AS b, count(*) + 5 + q AS n FROM k GROUP BY doc_id, q, t
                  HAVING count(*) + 5 + q >= greatest(12, 2 * q)),
            r AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c z WHERE z.doc_id = c.doc_id AND z.q < c.q AND z.b <= c.b
                                                    AND z.b + z.n >= c.b + c.n)),
            o AS (SELECT doc_id, count(*) AS n_runs, max(struct_pack(n := n, b := -b, q := -q)) AS m,
                         string_agg(b || ',' || n || ',' || q || chr(10), '' ORDER BY b, q) AS lines FROM r GROUP BY doc_id),
            x AS (SELECT DISTINCT doc_id, unnest(range(b + q, b + n)) AS i FROM r),
            kept AS (SELECT f.doc_id, string_agg(f.v, ' ' ORDER BY f.i) AS t
                     FROM (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS v FROM d) f ANTI JOIN x ON x.doc_id = f.doc_id AND x.i = f.i
                     GROUP BY f.doc_id)
            SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, -m.b AS start, m.n AS length, -m.q AS period,
                   m.n * 1000 // -m.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
                   sha256(coalesce(t, '')) AS collapsed_sha256
            FROM d LEFT JOIN o ON o.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id""",
        "op13_fingerprints": r"""
            WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                              coalesce(lead(coalesce(text, '')) OVER o, first(coalesce(text, '')) OVER o) AS next
                       FROM documents WINDOW o AS (ORDER BY doc_id DESC NULLS LAST)),
            e AS (SELECT doc_id, text, next, length(text) AS n_chars, substring(text, 1, length(text) - length(text) // 2)
                         || substring(next, 1, length(text) // 2) AS edited FROM t),
            a AS (SELECT doc_id, 1 AS k, text AS x FROM e UNION ALL SELECT doc_id, 2, edited FROM e UNION ALL SELECT doc_id, 3, next FROM e),
            w AS (SELECT doc_id, k, list_filter(regexp_split_to_array(
                      translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM a),
            m AS (SELECT doc_id, k, CASE WHEN len(w) > 0 THEN list_distinct(list_transform(range(greatest(len(w) - 4, 1)),
                      lambda i: substring(md5(array_to_string(w[i + 1:i + 5], ' ')), 1, 12))) ELSE [] END AS h FROM w),
            f AS (SELECT doc_id, k, list_sort(list_filter(h, lambda x: x < '4' OR x = list_min(h))) AS f FROM m),
            g AS (SELECT x.doc_id, x.f AS f, y.f AS e, z.f AS n FROM f x JOIN f y ON x.doc_id = y.doc_id JOIN f z ON x.doc_id = z.doc_id
                  WHERE x.k = 1 AND y.k = 2 AND z.k = 3)
            SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(f, '') AS fingerprint,
                   array_to_string(g.e, '') AS edited_fingerprint,
                   CASE WHEN len(f) > 0 THEN len(list_intersect(f, g.e)) / len(f) WHEN len(g.e) > 0 THEN 0 ELSE 1 END::DOUBLE AS near_edited,
                   CASE WHEN len(f) > 0 THEN len(list_intersect(f, n)) / len(f) WHEN len(n) > 0 THEN 0 ELSE 1 END::DOUBLE AS near_next
            FROM e JOIN g ON g.doc_id = e.doc_id""",
        "op7_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER g AS keep_id,
                   count(*) OVER g AS group_size,
                   doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    }
