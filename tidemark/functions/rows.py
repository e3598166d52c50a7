"""Row-level helpers that keep a DataFrame's schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One array never holds more than this many repeat markers, so a line with a
# billion copies is unrolled in two bounded steps instead of one huge array.
REPEAT_BLOCK = 4096


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Emit every row ``times`` times and drop the counter column.

    Rows with ``times = 1`` (almost all of them) pass through two one-element
    generators; no exchange is needed.
    """
    keep = [c for c in df.columns if c != times]
    blocks = F.ceil(F.col(times) / F.lit(REPEAT_BLOCK)).cast("int")
    unrolled = df.filter(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(F.lit(1), blocks)))
    left = F.col(times) - (F.col("_block") - 1) * REPEAT_BLOCK
    inside = F.sequence(F.lit(1), F.least(left, F.lit(REPEAT_BLOCK)).cast("int"))
    return unrolled.withColumn("_copy", F.explode(inside)).select(*keep)


def unrolled(weighted: DataFrame, times: str = "copies") -> DataFrame:
    """The rows that a weighted table stands for: every row ``times`` times, without the weight.

    A table with weights is linear in the records it was made from; this is not, so it is for readers that need each
    row. Rows of more than one block are dealt over tasks block by block before they are unrolled, so that neither
    one event's lines nor one heavy line is unrolled in one place.
    """
    keep = [c for c in weighted.columns if c != times]
    blocks = F.ceil(F.col(times) / F.lit(REPEAT_BLOCK)).cast("int")
    dealt = weighted.filter(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(F.lit(1), blocks)))
    dealt = dealt.hint("rebalance")
    left = F.col(times) - (F.col("_block") - 1) * REPEAT_BLOCK
    inside = F.sequence(F.lit(1), F.least(left, F.lit(REPEAT_BLOCK)).cast("int"))
    return dealt.withColumn("_copy", F.explode(inside)).select(*keep)


def loose(lookup: DataFrame) -> DataFrame:
    """Hand a grouped table to a join without its layout.

    Adaptive execution can only split a hot key of a join when both sides come
    straight out of an exchange. A lookup grouped by the join key would be joined
    in place and leave the whole key to one task; redistributing its few columns
    buys the split. It is still broadcast when its measured size allows.
    """
    return lookup.hint("rebalance")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round DOUBLE columns and show timestamps without a zone, for comparisons."""
    out = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        if kind == "double":
            column = F.round(column, digits)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        out.append(column.alias(field.name))
    return df.select(*out)
