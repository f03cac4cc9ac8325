"""Target-site duplications from the flanks of an element, and the corrected place and size that follow from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequence import longest_common, longest_common_long, nearest_occurrence, occurrences, places


def duplications(df: DataFrame, left: str = "fk_l", right: str = "fk_r", least: int = 4, long: bool = False) -> DataFrame:
    """Adds tsd, shift_l and shift_r; rows without a common stretch of ``least`` letters, or with a NULL flank, are left out.

    The stretch is looked for in the right flank and found in the left one, unless the right one is longer, then the other way
    round; the longest counts, the leftmost of equals. The shifts are the bases between the stretch and the element.
    ``long``: the flanks may have thousands of letters; the result is the same.
    """
    there = df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    swap = F.length(right) > F.length(left)
    main, other = F.when(swap, F.col(left)).otherwise(F.col(right)), F.when(swap, F.col(right)).otherwise(F.col(left))
    found = there.withColumn("__m", main).withColumn("__s", other).withColumn("tsd", longest_common_long("__m", "__s", F.lit(least)) if long else longest_common(F.col("__m"), F.col("__s"), least)).filter("tsd is not null")
    i = F.instr("__m", F.col("tsd")) - 1
    k, n = F.length("tsd"), F.length(left)
    found = found.withColumn("__at", places("__s", "tsd") if long else occurrences(F.col("__s"), F.col("tsd")))
    to_left = F.when(swap, n - k - i).otherwise(n - k - F.array_max("__at"))
    to_right = F.when(swap, F.array_min("__at")).otherwise(i)
    return found.withColumn("shift_l", to_left.cast("bigint")).withColumn("shift_r", to_right.cast("bigint")).drop("__m", "__s", "__at")


def place_from_reads(df: DataFrame, empty_left: str, empty_right: str, position: str) -> DataFrame:
    """Adds new_pos: the position moved to the occurrence of the tsd in the empty site that lies nearest to the joint."""
    site = F.concat(F.col(empty_left), F.col(empty_right))
    joint = F.length(empty_left)
    at = nearest_occurrence(site, F.col("tsd"), joint)
    return df.withColumn("new_pos", F.when(at.isNotNull(), F.col(position) + at - joint + F.length("tsd")).otherwise(F.col(position)))


def place_from_genome(df: DataFrame, position: str) -> DataFrame:
    return df.withColumn("new_pos", F.col(position) - F.col("shift_l"))
