"""A corpus pipeline: stages that each take the documents the one before kept.

Every stage returns the columns of its documents, but for the last, which returns packed pieces.
Stages accept empty tables, null texts and ids, repeated rows and further columns, as the
operators that they call do.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixeltally.llm import language_id, line_dedup, minhash, mixing, packing
from pixeltally.llm.common import WORD, stored
from pixeltally.llm.registry import word_ids_of_few

ROW = "whole_row"


def _with_row(docs: DataFrame, without: str | None = None) -> DataFrame:
    """All columns, but for one that is carried itself, as one more column, so that operators carry them whatever their names."""
    return docs.withColumn(ROW, F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != without]))


def _documents(rows: DataFrame, docs: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of ``docs`` out of carried rows; ``text`` names a new text, whose length is counted."""
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")} if text else {}
    return rows.select(*[
        new[name].alias(name) if name in new else F.col(ROW)[name].alias(name) for name in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or of ambiguous language go; the others stay as they are.

    Where no row has a language to learn from, no text is ambiguous.
    """
    model = language_id.fit(docs.filter(~language_id.held_out()))
    if not model.languages:
        model = language_id.Model(["any"], np.ones((1, 1)), np.zeros((language_id.FEATURES, 1)), np.zeros(1), np.ones(1))
    found = language_id.predict(_with_row(docs, "text"), model, carry=[ROW, "text"])
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(*[F.col("text") if name == "text" else F.col(ROW)[name].alias(name) for name in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays, if only with an empty text."""
    rows = line_dedup.drop_boilerplate(_with_row(docs), carry=[ROW]).withColumnRenamed("text", "kept_text")
    return _documents(rows, docs, "kept_text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles and a similarity of 0.8 or more one of the smallest id stays.

    Rows that repeat an id or have none are told apart by a number of their own.
    """
    if not docs.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1 OR doc_id IS NULL").isEmpty():
        numbered = stored(_with_row(docs).select(F.monotonically_increasing_id().alias("place"), ROW), "numbered")
        rows = numbered.select("place", F.col(ROW)["doc_id"].alias("its_id"), F.col(ROW)["text"].alias("text"))
        groups = minhash.near_groups(rows, doc_id="place").select(F.col("doc_id").alias("place"), "component_id")
        order = F.struct(F.col("its_id").isNull(), "its_id", F.md5(F.col("text").cast("binary")), "place")
        least = rows.join(groups, "place").groupBy("component_id").agg(F.min(order).alias("least"))
        return _documents(numbered.join(stored(least.select("least.place"), "least"), "place", "left_semi"), docs)
    dropped = stored(minhash.near_groups(docs).filter("NOT kept").select("doc_id").distinct(), "near-duplicates")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each time that it takes a document.

    A document that a taken stretch begins or ends in has only the words of that stretch, joined
    by spaces; any other row has its text as it is. Documents without words are in no mix.
    """
    rows = mixing.mix(_with_row(docs), carry=[ROW])
    whole = F.struct(F.lit(0).cast("long").alias("low"), F.col("size").alias("high"))
    stretches = F.concat(
        F.array_repeat(whole, F.col("rounds").cast("int")),
        F.array(F.struct(F.col("first").alias("low"), F.col("last").alias("high")),
                F.struct(F.col("first2").alias("low"), F.col("last2").alias("high"))))
    rows = rows.select(ROW, "size", F.explode(F.filter(stretches, lambda s: s["high"] > s["low"])).alias("part"))
    text, count = F.col(ROW)["text"], F.col("part")["high"] - F.col("part")["low"]
    words = F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), (F.col("part")["low"] + 1).cast("int"), count.cast("int"))
    return _documents(rows.withColumn("kept_text", F.when(count == F.col("size"), text).otherwise(F.array_join(words, " "))), docs, "kept_text")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.packed(docs, word_ids_of_few)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier has no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
