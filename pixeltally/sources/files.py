"""CSV and Parquet datasets."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixeltally.operators.cleaning import nullify_na_tokens
from pixeltally.session import hadoop_path, scratch_path

FILE_ORDER = "_file_order"
RECORD = "_record"
SURPLUS = "_surplus"
MARKERS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"  # Hadoop's setting for _SUCCESS files

# A line whose last field opens a quote that the line doesn't close: whole fields, then an open one.
OPEN_FIELD = r'^(?:(?:"(?:[^"]++|"")*+"|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'
# The end of a record that an earlier line began: text, and a quote that closes a field.
CLOSED_FIELD = r'^[^"]*[^",]"(?:,|$)'


def files_with_line_breaks(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files in which some quoted field goes on in the next line: one pass over the text.

    Quotes count where they open or close a field, so an inch mark within one does not.
    """
    lines = spark.read.text(path).filter(F.col("value").rlike(OPEN_FIELD))
    return sorted(unquote(row[0]) for row in lines.select("_metadata.file_path").distinct().collect())


def _options(multi_line: bool) -> dict[str, object]:
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "columnNameOfCorruptRecord": RECORD,
            "columnPruning": False}  # a record is judged whole, whatever columns are asked for


def _broken(schema: T.StructType, multi_line: bool, cut_surplus: bool) -> Column:
    """True, or an error for a record that can't be read as it stands."""
    record = F.col(RECORD)
    # Always true; Spark parses no record for a query that reads nothing but the record's text.
    found = F.length(F.coalesce(F.col(f"`{schema.fieldNames()[0]}`"), F.lit(""))) >= 0
    if not cut_surplus:
        wider = ", ".join(f"`{name}` string" for name in [*schema.fieldNames(), SURPLUS])
        fields = F.from_csv(record, wider, {"quote": '"', "escape": '"'})
        too_many = F.raise_error(F.concat(F.lit("CSV record with more fields than the header: "), record)).cast("boolean")
        found = F.when(record.isNotNull() & fields[SURPLUS].isNotNull(), too_many).otherwise(found)
    if not multi_line:
        split = record.rlike(OPEN_FIELD) | record.rlike(CLOSED_FIELD)
        message = "CSV record with a line break in quotes, read the file with multi_line: "
        found = F.when(record.isNotNull() & split, F.raise_error(F.concat(F.lit(message), record)).cast("boolean")).otherwise(found)
    return found


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multi_line: bool, file_order: bool, cut_surplus: bool) -> DataFrame:
    rows = (
        spark.read.schema(T.StructType([*schema, T.StructField(RECORD, T.StringType())]))
        .options(**_options(multi_line)).option("enforceSchema", False).csv(path)
        .filter(_broken(schema, multi_line, cut_surplus)))
    order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    columns = [F.col(f"`{name}`") for name in schema.fieldNames()]
    return rows.select(*columns, *([order.alias(FILE_ORDER)] if file_order else []))


def read_csv(
    spark: SparkSession, path: str, multi_line: bool | None = False, file_order: bool = False, cut_surplus: bool = False,
) -> DataFrame:
    """A CSV file or folder with headers, all columns as text, missing-value texts as null.

    Reading fails with a message, rather than giving other rows, where a file of the folder has
    another header than the first, where a record has more fields than the header (with
    ``cut_surplus`` the rest is left out), and where a quoted field goes on in the next line.
    Records with fewer fields end in nulls.

    Line breaks in quotes need Spark's multi-line mode, which reads a file in one task: say
    ``multi_line=True`` for all files, or None to find the files that need it in a pass over the
    text; the others are still split. With ``file_order`` a column tells each row's place in the input.
    """
    schema = T.StructType([
        T.StructField(f.name, T.StringType()) for f in spark.read.options(**_options(bool(multi_line))).csv(path).schema])
    if multi_line is None:
        broken = files_with_line_breaks(spark, path)
        every = [unquote(name) for name in spark.read.text(path).inputFiles()]
        known = {_plain(name) for name in broken}
        whole = [name for name in every if _plain(name) not in known]
        parts = [_read_csv(spark, names, schema, mode, file_order, cut_surplus) for names, mode in ((whole, False), (broken, True)) if names]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    else:
        rows = _read_csv(spark, path, schema, multi_line, file_order, cut_surplus)
    return nullify_na_tokens(rows)


def read_parquet(spark: SparkSession, path: str, file_order: bool = False) -> DataFrame:
    rows = spark.read.parquet(path)
    if not file_order:
        return rows
    return rows.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(FILE_ORDER))


def _plain(path: str) -> str:
    """A path as text to compare: one slash after the scheme, none for local files."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path)).removeprefix("file:").rstrip("/")


def refuse_own_input(df: DataFrame, path: str) -> None:
    """Raise if a write to ``path`` would empty what ``df`` still has to read."""
    target, file_system = hadoop_path(df.sparkSession, path)
    root = _plain(file_system.makeQualified(target).toString())
    if any(f"{_plain(name)}/".startswith(f"{root}/") for name in df.inputFiles()):
        raise ValueError(f"{path} is an input of the rows to write there")


def write_parquet(df: DataFrame, path: str) -> None:
    """Write one dataset, in place of what is there. A path that ``df`` itself reads is refused."""
    refuse_own_input(df, path)
    df.write.mode("overwrite").parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    The steps that follow share it, a lost executor costs no recomputation, and
    Spark knows its size when it plans the joins of those steps.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return read_parquet(spark, path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a dataset was written to its end: Spark leaves a marker then."""
    marker, file_system = hadoop_path(spark, f"{path}/_SUCCESS")
    return file_system.exists(marker)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether anything but hidden and temporary entries lies in the folder."""
    folder, file_system = hadoop_path(spark, path)
    if not file_system.exists(folder):
        return False
    return any(not entry.getPath().getName().startswith(("_", ".")) for entry in file_system.listStatus(folder))


def resolve_source(spark: SparkSession, enriched_path: str, csv_path: str, file_order: bool = False) -> DataFrame:
    """The enriched Parquet dataset if there is a complete one, else the raw CSV, else an error.

    An empty folder, or one that a killed write left, is no dataset: where data is there without
    Spark's end marker, a warning says that it is not read. Where the session is set to write no
    markers, nothing tells a whole dataset from a part, and that is an error.
    """
    if is_complete(spark, enriched_path):
        return read_parquet(spark, enriched_path, file_order)
    if _has_files(spark, enriched_path):
        if not spark._jsc.hadoopConfiguration().getBoolean(MARKERS, True):
            raise ValueError(f"{enriched_path} has data, but {MARKERS} is off: whether it is whole can't be told")
        warnings.warn(f"{enriched_path} has data but no _SUCCESS: taken for unfinished, {csv_path} is read", stacklevel=2)
    try:
        return read_csv(spark, csv_path, file_order=file_order)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    raise FileNotFoundError(f"neither {enriched_path} nor {csv_path} exists")
