"""Delimited-file ingest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.schemas import BRONZE, SOURCE_FILES

# Comma-separated, double-quoted, one header row; ``\N`` is the loader's null mark.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "mode": "PERMISSIVE",
}


# The whole line as one column: a separator that no line holds, and no quotes.
_LINE_OPTIONS = {"header": "true", "sep": "\x01", "quote": "", "mode": "PERMISSIVE"}
_BROKEN = "_broken"

REJECTS = "file string, reason string, record string"


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


def _converted(schema: T.StructType) -> list[Column]:
    return [
        F.col(f.name).try_cast(f.dataType).alias(f.name)
        if f.dataType != T.StringType()
        else F.col(f.name)
        for f in schema
    ]


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Read a file by column position; the header text does not have to match.

    Values arrive as text and are converted one by one, so a value that does not fit
    its column becomes null and the rest of its row is kept. ``multi_line`` reads quoted
    line ends as part of a value; such a file is read by one task. Without it, files are split,
    and lines may end in a line feed, a carriage return or both.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    return reader.schema(_text_schema(schema)).csv(path).select(_converted(schema))


@dataclass(frozen=True)
class Checked:
    """Rows that fit the contract, and those that do not, whole, with file and reason.

    ``rejected`` has the number of the latter once ``rows`` were written, so a clean source is
    read once only; ``rejects`` is a second pass over the file.
    """

    rows: DataFrame
    rejects: DataFrame
    rejected: Observation


def read_checked(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> Checked:
    """Read a file by column position and set aside the records that do not fit.

    Reasons, the first that holds: ``quote`` (an odd number of quotes, so one stays open),
    ``fields`` (more or fewer than the contract has), ``value: a, b`` (columns whose text is
    not of the column's type). Without ``multi_line`` the record is the line as it stands in
    the file; with it a record that could be cut into fields is given as those.
    """
    text = _text_schema(schema)
    parsed = T.StructType([*text, T.StructField(_BROKEN, T.StringType(), True)])
    options = CSV_OPTIONS | {"columnNameOfCorruptRecord": _BROKEN}
    if multi_line:
        found = spark.read.options(**options).option("multiLine", True).schema(parsed).csv(path)
        names = [F.col(f"`{n}`") for n in text.names]
        fields = F.to_csv(F.struct(*names), {"nullValue": "\\N"})
        found = found.select(
            *names,
            _BROKEN,
            F.coalesce(F.col(_BROKEN), fields).alias("_record"),
            F.col("_metadata.file_path").alias("_file"),
        )
        quotes = F.col(_BROKEN)
    else:
        lines = spark.read.options(**_LINE_OPTIONS).schema("line string").csv(path)
        ddl = ", ".join(f"`{name}` STRING" for name in parsed.names)
        # Through a generator, as a filter is not pushed below one: as a plain column the cut
        # would be repeated in the filter for every field that the reason looks at.
        cut = F.inline(F.array(F.from_csv("line", ddl, options)))
        found = lines.select(
            F.col("line").alias("_record"), F.col("_metadata.file_path").alias("_file"), cut
        )
        quotes = F.col("_record")
    odd = F.length(F.regexp_replace(quotes, '[^"]', "")) % 2 == 1
    unfit = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name)
        for f in schema
        if f.dataType != T.StringType()
    ]
    wrong = F.concat_ws(", ", *unfit) if unfit else F.lit("")
    reason = (
        F.when(odd, "quote")
        .when(F.col(_BROKEN).isNotNull(), "fields")
        .when(wrong != "", F.concat(F.lit("value: "), wrong))
    )
    judged = found.withColumn("_reason", reason)
    counter = Observation(f"rejects of {path}")
    counted = judged.observe(counter, F.count("_reason").alias("rejected"))
    rows = counted.where("_reason IS NULL").select(_converted(schema))
    rejects = judged.where("_reason IS NOT NULL").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record")
    )
    return Checked(rows, rejects, counter)


def source_path(root: str, table: str) -> str:
    """Where one of the six source extracts lies below ``root``."""
    return f"{root.rstrip('/')}/{SOURCE_FILES[table]}"


def read_source_file(
    spark: SparkSession, root: str, table: str, multi_line: bool = False
) -> DataFrame:
    """One of the six source extracts below ``root``."""
    return read_delimited(spark, source_path(root, table), BRONZE[table], multi_line)
