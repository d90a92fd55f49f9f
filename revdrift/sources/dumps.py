"""Versioned text dumps: ``<root>/<City>_<ST>/<City>_<ST>_C-<v>.txt``.

Identity lives in the file name.  Spark's readers pass over files of zero
bytes, but an empty dump is a valid (empty) version, so the names of those
files alone are added from the file system's listing.  Texts are read once and
never shuffled; bytes that are not UTF-8 fail the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Dump file-name pattern (Unicode \w, as in Python's ``re``).
DUMP_NAME = r"(?U)^(.+?)_(\w{2})_C-(\d+)\.txt$"


def parse_dump_name(name: Column | str) -> list[Column]:
    """[city, state, page, version]; version NULL when the name does not match."""
    n = F.col(name) if isinstance(name, str) else name
    ok = n.rlike(DUMP_NAME)
    city = F.when(ok, F.regexp_extract(n, DUMP_NAME, 1))
    state = F.when(ok, F.regexp_extract(n, DUMP_NAME, 2))
    version = F.when(ok, F.regexp_extract(n, DUMP_NAME, 3).try_cast("int"))
    return [city.alias("city"), state.alias("state"),
            F.when(ok, F.concat_ws("_", city, state)).alias("page"), version.alias("version")]


def decoded(uri: Column | str) -> Column:
    """A path or name as the file system has it, from its percent-encoded form."""
    return F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def empty_files(spark: SparkSession, root: str, suffix: str = ".txt") -> DataFrame:
    """[path, name] of the files of zero bytes under ``root``.

    The listing streams through the driver as Spark's own file index does; only
    the names of empty files are held."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(base, True)
    rows = []
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0 and status.getPath().getName().endswith(suffix):
            rows.append((status.getPath().toString(), status.getPath().getName()))
    return spark.createDataFrame(rows, "path string, name string")


def read_dumps(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(versions[page, city, state, version, text, path], rejects[path, name]).

    Files of zero bytes are empty texts.  A name that does not follow the
    pattern goes to ``rejects``, and so does one with leading zeros in its
    version, which has no place of its own beside the plain number.  Only
    ``.txt`` files count; a corpus without any version is an error, as is a
    text that is not valid UTF-8 (when it is read).
    """
    texts = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
             .select(decoded("_metadata.file_path").alias("path"), decoded("_metadata.file_name").alias("name"),
                     F.validate_utf8("value").alias("text")))
    files = texts.unionByName(empty_files(spark, root).withColumn("text", F.lit("")))
    keyed = files.select("path", "name", "text", *parse_dump_name("name"))
    plain = F.coalesce(F.col("name") == F.concat(F.col("page"), F.lit("_C-"), F.col("version").cast("string"), F.lit(".txt")), F.lit(False))
    versions = keyed.filter(plain).select("page", "city", "state", "version", "text", "path")
    if versions.select("page").isEmpty():
        raise FileNotFoundError(f"no dump under {root} follows <City>_<ST>_C-<version>.txt")
    return versions, keyed.filter(~plain).select("path", "name")


def read_concatenated(spark: SparkSession, root: str) -> DataFrame:
    """[path, text] of concatenated dumps (one file per page)."""
    return (spark.read.text(root, wholetext=True)
            .select(decoded("_metadata.file_path").alias("path"), F.validate_utf8("value").alias("text")))
