"""What the operators of this subpackage share: scratch tables and plain column expressions."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.session import scratch_path

# A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# While a scratch table is written: its shuffle files go when it ends, not when the driver collects
# its garbage, and Python workers get long texts in batches of a few MB.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back; its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _settings(spark, _WHILE_WRITING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collected(df: DataFrame) -> pa.Table:
    """``df`` on the driver, computed under the settings of scratch tables."""
    with _settings(df.sparkSession, _WHILE_WRITING):
        return df.toArrow()


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver holds, made of Arrow columns.

    Plain rows would pass through Python workers of their own kind, which stay beside the executor's others.
    """
    fields = [field.split() for field in schema.split(", ")]
    columns = {name: pa.array([row[k] for row in rows], _ARROW[kind]) for k, (name, kind) in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), schema)


Batches = Iterator[pa.RecordBatch]


def freed(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` on Arrow batches, which gives memory that it no longer uses back when a task ends.

    A Python worker lives on beside the executor's heap between tasks and stages; without this the allocators
    keep what the largest batch took.
    """
    def run(batches: Batches) -> Batches:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)
    return run


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Where every character is ASCII the faster built-in does the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def sha256_text(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
