"""Delimited text files: written to and scanned from a shared folder.

A scan splits large files over tasks, drops the header of every file and checks each line
against the schema; a line that doesn't fit (too few or too many fields, a field
of another type) is kept, as it stands, in a table of rejects of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.session import new_subdir

_BAD = "_corrupt_record"


def write_lines(lines: DataFrame, path: str, header: str | None = None, mode: str = "append") -> None:
    """Column ``line`` as text files, one a task; each begins with the header, if there is one."""
    if header is not None:
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        both = F.when(first, F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))
        lines = lines.select(both.alias("both")).select(F.explode("both").alias("line"))
    lines.select("line").write.mode(mode).text(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "append") -> None:
    """Rows as delimited lines; a null is an empty field, nothing is quoted."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    write_lines(df.select(F.concat_ws(sep, *fields).alias("line")), path, sep.join(df.columns) if header else None, mode)


def text_folder(spark: SparkSession, name: str, *parts: tuple[DataFrame, bool], sep: str = ",") -> str:
    """A new shared folder with the given tables as delimited files: (rows, with header?)."""
    path = new_subdir(spark, name)
    for df, header in parts:
        write_delimited(df, path, sep, header)
    return path


def scan_delimited(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True,
                   quote: str = '"') -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited files.

    ``rows`` has the schema's columns, with blanks trimmed; ``rejects`` has ``line`` and
    the fields that could be read.  All columns are parsed for every line, whatever is selected
    later, so a line is rejected or not by its content alone."""
    df = (spark.read.schema(f"{schema}, {_BAD} string")
          .csv(path, sep=sep, header=header, quote=quote, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD,
               ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True))
    # a column that nobody reads isn't parsed; this condition, always true, reads them all
    df = df.where(F.length(F.concat_ws("", *(F.col(c).cast("string") for c in df.columns if c != _BAD))) >= 0)
    return df.where(F.col(_BAD).isNull()).drop(_BAD), df.where(F.col(_BAD).isNotNull()).withColumnRenamed(_BAD, "line")
