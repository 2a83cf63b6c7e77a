"""CSV files in which some lines don't parse: good rows, and the other lines with their place and a reason.

One read of the text for the numbers of lines, one to parse; what was parsed is written once and split afterwards. A record is one
line. Lines are numbered per file over all its splits: a split counts its lines, and a scan over the splits of a file, one
row each, gives what stands before. Empty lines are skipped, but counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.operators.skew import broadcast_if_small
from cartloom.session import cut_lineage

_BAD, _EXTRA = "bad__", "extra__"


@dataclass(frozen=True)
class Parsed:
    rows: DataFrame
    rejected: DataFrame  # file, line, reason, text


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of all lines of the files of ``path``; lines count from 1 in each file."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = cut_lineage(splits.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    placed = lines.join(broadcast_if_small(before), ["file", "block"])
    return placed.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "text")


def _reason(schema: T.StructType, options: dict[str, str]) -> Column:
    """``fields`` if their number is wrong, else the columns whose values are not of their type."""
    plain = ", ".join(f"`{f.name}` string" for f in schema.fields) + f", {_BAD} string"
    texts = F.from_csv("text", plain, options)
    wrong = [F.when(texts[f.name].isNotNull() & texts[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields]
    named = F.array_join(F.array_compact(F.array(*wrong)), ",")
    return F.when(texts[_BAD].isNotNull(), "fields").otherwise(F.concat(F.lit("type:"), named))


def read(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, options: dict[str, str] | None = None) -> Parsed:
    """Parse the CSV files of ``path`` into ``schema``; lines that don't fit it are set apart, with file, number and reason.

    With ``header`` the first line of every file must name the columns in their order, or the read fails: then all lines would be
    wrong. An empty field is NULL, as in other reads.
    """
    options = {**(options or {}), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    lines = numbered_lines(spark, path)
    if header:
        heads = lines.where("line = 1").select(F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(schema))), options).alias("h"), "file")
        wrong = heads.where(~F.array(*[F.col(f"h.c{i}") for i in range(len(schema))]).eqNullSafe(F.array(*[F.lit(f.name) for f in schema.fields]))).first()
        if wrong:
            raise ValueError(f"the first line of {wrong.file} doesn't name the columns {', '.join(schema.names)}")
        lines = lines.where("line > 1")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", {_BAD} string"
    parsed = cut_lineage(lines.where(F.trim("text") != "").select("*", F.from_csv("text", kind, options).alias("row")))
    rows = parsed.where(F.col(f"row.{_BAD}").isNull()).select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields])
    rejected = parsed.where(F.col(f"row.{_BAD}").isNotNull()).select("file", "line", _reason(schema, options).alias("reason"), "text")
    return Parsed(rows, rejected)
