"""CSV event files: a header row of ``Label(code)`` cells, then one event per line.

Lines are split on commas with no quote handling, so quote marks stay part of
the value.  Empty fields are left out of the event.  A line with more fields
than the header is a reject (reason ``csv_long_row``); a shorter line is valid
and simply lacks the trailing fields.

``read_csv_events`` reads files that all have the same header; a file with
another one fails the read.  ``read_mixed_csv_events`` reads every file by its
own header, for which it goes through the lines once more.

Spark's CSV reader takes each line as one column (its separator is a control
character that text does not hold), which leaves it to skip and compare the
files' headers; the line is then split natively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fanwrite.functions.events import fields_to_map
from fanwrite.functions.text import header_code, header_code_column

# Whole lines: no separator, no quotes, nothing trimmed.
WHOLE_LINES = {"header": True, "sep": "\x01", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

SAMPLE_LABELS = {
    "id": "Number",
    "msg": "Text",
    "dt": "Time",
    "rv39": "Tenant",
    "sun": "User",
    "evt": "Kind",
    "sev": "Level",
}


def header_line(spark: SparkSession, path: str) -> str:
    """The header line of a file, or of one file of a folder."""
    return spark.read.options(**WHOLE_LINES, quote="").csv(path).columns[0]


def header_codes(spark: SparkSession, path: str) -> list[str]:
    """Field codes from the header line (reads only the first line)."""
    return codes_of(header_line(spark, path))


def codes_of(header: str) -> list[str]:
    codes = [header_code(label) for label in header.split(",")]
    if len(set(codes)) != len(codes):
        raise ValueError(f"the header names a field twice: {header}")
    return codes


def read_csv_events(spark: SparkSession, path: str) -> DataFrame:
    """``(event, reason, line)``: reason is NULL for a good event, line (the
    whole line) for all but a reject.

    Trailing empty fields do not count toward the field count (a comma split
    drops them), so only a line with a non-empty field past the header is long.
    """
    header = header_line(spark, path)
    codes = codes_of(header)
    schema = T.StructType([T.StructField(header, T.StringType())])
    read = spark.read.schema(schema).options(**WHOLE_LINES, quote="", enforceSchema=False)
    lines = read.csv(path).toDF("line").select("line", F.split("line", ",").alias("parts"))
    long_row = F.size(F.split(F.regexp_replace("line", ",+$", ""), ",")) > F.lit(len(codes))
    fields = {c: F.get("parts", F.lit(i)) for i, c in enumerate(codes)}
    return lines.select(
        F.when(~long_row, fields_to_map(fields)).alias("event"),
        F.when(long_row, F.lit("csv_long_row")).alias("reason"),
        F.when(long_row, F.col("line")).alias("line"),
    )


# Files whose headers are broadcast to the lines; beyond that they are joined by a shuffle.
BROADCAST_FILES = 100_000


def _lines(spark: SparkSession, path: str, header: bool, *columns: Column) -> DataFrame:
    """Whole lines; without the first one of each file if ``header``."""
    read = spark.read.schema("line string").options(**(WHOLE_LINES | {"header": header}), quote="", enforceSchema=True)
    return read.csv(path).select("line", *columns)


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, codes``: the field codes of every file, from its own header line.

    The first line of a file is the first row of the split that starts at its
    first byte; each task keeps one row per file, so little is shuffled.
    """
    first = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")]
    lines = _lines(spark, path, False, *first).where("start = 0")
    header = lines.groupBy("file").agg(F.min_by("line", "at").alias("header"))
    return header.select("file", F.transform(F.split("header", ","), header_code_column).alias("codes"))


def read_mixed_csv_events(spark: SparkSession, path: str) -> DataFrame:
    """``(event, reason, line)`` as :func:`read_csv_events`, of files whose headers
    differ in their fields or the order of these.

    Lines of a file whose header names a field twice are rejects (reason
    ``csv_header``).  The headers are a row per file: they are broadcast if these
    are ``BROADCAST_FILES`` at most, else joined to the lines by a shuffle, in
    which a large file's lines are split (AQE).  A file without lines has no rows.
    """
    headers = file_headers(spark, path)
    if headers.count() <= BROADCAST_FILES:
        headers = F.broadcast(headers)
    lines = _lines(spark, path, True, F.col("_metadata.file_path").alias("file")).join(headers, "file")
    parts = F.split("line", ",")
    long_row = F.size(F.split(F.regexp_replace("line", ",+$", ""), ",")) > F.size("codes")
    reason = F.when(F.size(F.array_distinct("codes")) < F.size("codes"), F.lit("csv_header")).when(long_row, F.lit("csv_long_row"))
    # The parts past the line's end are NULL, those past the header are empty: neither is kept.
    named = F.filter(F.arrays_zip(F.col("codes").alias("code"), parts.alias("value")), lambda f: (f["value"] != F.lit("")) & f["code"].isNotNull())
    judged = lines.select(reason.alias("reason"), "line", named.alias("fields"))
    good = F.col("reason").isNull()
    return judged.select(
        F.when(good, F.map_from_entries("fields")).alias("event"),
        "reason",
        F.when(~good, F.col("line")).alias("line"),
    )


def write_csv_events(df: DataFrame, path: str, codes: list[str], labels: dict[str, str] | None = None, append: bool = False) -> str:
    """Write string columns named by code as a CSV with ``Label(code)`` headers.

    Values are written as they are (no quoting, no trimming), NULL as an empty
    field.  A value with a comma or a line break, which the format can't
    carry, fails the write.  ``append`` adds files to a folder.
    """
    labels = labels or SAMPLE_LABELS
    header = ",".join(f"{labels.get(c, c)}({c})" for c in codes)

    def field(code: str):
        value = F.coalesce(F.col(code).cast("string"), F.lit(""))
        refused = F.raise_error(F.concat(F.lit("not a CSV field: "), value)).cast("string")
        return F.when(value.rlike("[,\r\n\\x01]"), refused).otherwise(value)

    out = df.select(F.concat_ws(",", *(field(c) for c in codes)).alias(header))
    out.write.options(**WHOLE_LINES, quote="\x00", emptyValue="").mode("append" if append else "errorifexists").csv(path)
    return path
