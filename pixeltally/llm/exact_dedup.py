"""Exact de-duplication by most-significant-digit radix partitioning of the texts.

Documents start as one group. Each pass splits the open groups by their next bytes and
closes those that are single or whose texts have ended; what stays together to its last
byte is equal. A digit is a run of bytes, four times as long in each pass, so the number
of passes is the logarithm of the longest text. Bytes decide, not a digest of the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixeltally.llm.common import lower_ascii, stored

FIRST_DIGIT = 256
GROWTH = 4
NO_ID = -(2 ** 63)


def exact_groups(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: Sequence[str] = (), first_digit: int = FIRST_DIGIT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept`` and the columns in ``carry``.

    Texts are compared after lower-casing A-Z; a null text counts as empty. Of equal texts the
    row with the largest id stays. Rows that repeat an id and its text are one document listed
    more than once: all count in ``group_size`` and share ``kept``. A null id is smaller than
    any other; where a group has no other, ``keep_id`` is null and its rows are kept. Further
    columns of ``docs`` are ignored. An empty table gives an empty result.

    Rows are combined per group before a shuffle, and only groups of two or more meet their
    members again, in a join whose large partitions Spark splits or whose small side it
    broadcasts by size.
    """
    normalized = lower_ascii(F.coalesce(F.col(text), F.lit(""))).cast("binary")
    state = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.struct(F.lit(0).alias("no_column"), *carry).alias("carry"),
        F.lit(0).cast("long").alias("grp"), F.lit(0).cast("long").alias("tag"), normalized.alias("rest"))
    closed, width = [], first_digit
    while True:
        state = _pass(state, width)
        closed.append(state.filter("NOT open").select("doc_id", "keep_id", "group_size", "carry"))
        state = state.filter("open").select("doc_id", "carry", "grp", "tag", "rest")
        if state.isEmpty():
            break
        width *= GROWTH
    rows = closed[0]
    for more in closed[1:]:
        rows = rows.unionByName(more)
    return rows.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        *[F.col("carry")[name].alias(name) for name in carry])


def _pass(state: DataFrame, width: int) -> DataFrame:
    """Split each group by the next ``width`` bytes; ``open`` tells rows whose group needs another pass."""
    digit = F.substring("rest", 1, width)
    ended = F.octet_length("rest") <= width
    rows = state.withColumns({"digit": digit, "ended": ended})
    # Ids name the groups; the tag tells groups apart where an id is repeated or missing.
    groups = stored(
        rows.groupBy("grp", "tag", "digit", "ended")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")).filter("n > 1")
        .withColumns({"next_grp": F.coalesce("keep_id", F.lit(NO_ID)), "next_tag": F.xxhash64("grp", "tag", "digit", "ended")}),
        "radix-groups")
    alone = F.col("n").isNull()
    is_open = ~alone & ~F.col("ended")

    def after(column: str) -> Column:
        return F.when(is_open, F.col(column))

    return stored(
        rows.join(groups, ["grp", "tag", "digit", "ended"], "left").select(
            "doc_id", "carry", is_open.alias("open"),
            F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            after("next_grp").alias("grp"), after("next_tag").alias("tag"),
            F.when(is_open, F.expr(f"substring(rest, {width + 1})")).alias("rest")),
        "radix-pass")
