"""Quarterly archives (S1-S3): tab-separated members of a zip file to typed silver rows.

Members are unpacked to the shared folder (a stream copy on the driver; a zip member can't be split) and read from there by
the splittable text reader. A header line decides which column is which, so members may order their columns as they like.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronofact.functions.scalar import fact_key, flag, null_tokens, to_day, to_int, to_moment
from chronofact.schema import FACTS, SUBMISSIONS, conform
from chronofact.session import shared_dir
from chronofact.sources.store import hadoop_path

# Columns of the published archive members.
SUB_COLUMNS = ["adsh", "cik", "name", "sic", "countryba", "stprba", "fye", "form", "period", "fy", "fp", "filed", "accepted", "prevrpt", "detail", "instance", "nciks"]
NUM_COLUMNS = ["adsh", "tag", "version", "ddate", "qtrs", "uom", "segments", "coreg", "value", "footnote"]


def unpack(spark: SparkSession, archive: str, members: list[str]) -> dict[str, str]:
    """Paths of the members, unpacked to the shared folder piece by piece; KeyError for a member that isn't there.

    Both ends may lie on any file system that Spark knows; the stream goes through the driver's JVM.
    """
    folder = f"{shared_dir(spark)}/unpacked-{uuid.uuid4().hex}"
    jvm = spark._jvm
    fs, path = hadoop_path(spark, archive)
    out = {}
    stream = jvm.java.util.zip.ZipInputStream(fs.open(path))
    try:
        while (entry := stream.getNextEntry()) is not None:
            name = entry.getName()
            if name in members:
                to_fs, to = hadoop_path(spark, f"{folder}/{name}")
                sink = to_fs.create(to, True)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, sink, 1 << 20, False)
                finally:
                    sink.close()
                out[name] = f"{folder}/{name}"
    finally:
        stream.close()
    if missing := [m for m in members if m not in out]:
        raise KeyError(f"{archive} has no {', '.join(missing)}")
    return out


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a file."""
    fs, p = hadoop_path(spark, path)
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(p), "ISO-8859-1"))
    try:
        return (lines.readLine() or "").split("\t")
    finally:
        lines.close()


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): all columns as text, in the order asked; a column the file lacks is null; lines with
    another number of fields are left out and come as the second frame (_bad). No quoting, latin-1."""
    names = header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names] + [T.StructField("_bad", T.StringType())])
    raw = spark.read.schema(schema).option("sep", "\t").option("quote", "").option("encoding", "ISO-8859-1").option("header", "true").option("mode", "PERMISSIVE").option("enforceSchema", "true").option("columnPruning", "false").option("columnNameOfCorruptRecord", "_bad").csv(path)
    # the reader needs a column besides _bad in every query on it
    raw = raw.where(F.length(F.coalesce(F.col(names[0]), F.lit(""))) >= 0)
    good = raw.where("_bad is null").select(*(null_tokens(F.col(c)).alias(c) if c in names else F.lit(None).cast("string").alias(c) for c in columns))
    return good, raw.where("_bad is not null").select("_bad")


def read_archive(spark: SparkSession, archive: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Text rows of the two members, and their malformed lines (member, _bad)."""
    paths = unpack(spark, archive, ["sub.txt", "num.txt"])
    sub, bad_sub = read_tsv(spark, paths["sub.txt"], SUB_COLUMNS)
    num, bad_num = read_tsv(spark, paths["num.txt"], NUM_COLUMNS)
    bad = bad_sub.withColumn("member", F.lit("sub.txt")).unionByName(bad_num.withColumn("member", F.lit("num.txt")))
    return sub, num, bad.select("member", "_bad")


def malformed_lines(bad: DataFrame) -> dict[str, int]:
    """Q11: how many malformed lines each member has."""
    return {"sub.txt": 0, "num.txt": 0} | {r["member"]: r["count"] for r in bad.groupBy("member").count().collect()}


def typed_rows(sub: DataFrame, num: DataFrame, quarter: str, sha256: str, loaded_at, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(submissions, facts) of a quarter, conforming to their schemas. Facts without a submission are dropped.

    The key takes ddate as written, not the parsed date. Bad numbers and dates raise under ANSI, nulls in required columns
    in conform (check=False leaves that to the caller).
    """
    stamp = {"quarter": F.lit(quarter), "source_sha256": F.lit(sha256), "loaded_at": F.lit(loaded_at).cast("timestamp_ntz")}
    c = F.col
    typed = {x: to_int(c(x)) for x in ("cik", "sic", "fy", "nciks")} | {x: to_day(c(x)) for x in ("period", "filed")} | {x: flag(c(x)) for x in ("prevrpt", "detail")} | {"accepted": to_moment(c("accepted"))}
    submissions = sub.withColumns(typed).withColumns(stamp)
    meta = submissions.select("adsh", "cik", "form", "fy", "fp", c("filed").alias("knowledge_date"))
    joined = num.join(meta, "adsh")
    facts = joined.withColumn("fact_key", fact_key(c("cik"), c("tag"), c("ddate"), to_int(c("qtrs")), c("uom"), c("coreg"), c("segments"))).withColumns(
        {"ddate": to_day(c("ddate")), "qtrs": to_int(c("qtrs")), "value": c("value").cast("double"), "is_dimensional": c("segments").isNotNull()} | stamp
    )
    return conform(submissions, SUBMISSIONS, check), conform(facts, FACTS, check)


def parse_archive(spark: SparkSession, archive: str, quarter: str, sha256: str, loaded_at) -> tuple[DataFrame, DataFrame]:
    """(submissions, facts) of an archive, as typed_rows has them."""
    sub, num, _ = read_archive(spark, archive)
    return typed_rows(sub, num, quarter, sha256, loaded_at)
