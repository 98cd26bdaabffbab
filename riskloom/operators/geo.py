"""Country of a network address: backward as-of join against a table of address ranges."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.network import ip_to_int

log = logging.getLogger(__name__)

# Columns of the range table and the answer for addresses in no range.
LOWER, UPPER, COUNTRY = "lower_bound_ip_address", "upper_bound_ip_address", "country"
UNKNOWN = "Unknown"

# Ranges a broadcast may hold; beyond this the lookup is shuffled.
BROADCAST_RANGES = 1_000_000
# A /16 block with more pieces than this is looked up by /24 instead.
DENSE_BLOCK = 32


def _block(number: Column, bits: int) -> Column:
    """Address block by leading bits; everything beyond 32 bits shares one last block."""
    last = 1 << (32 - bits)
    return F.greatest(F.least(F.shiftright(number, bits), F.lit(last).cast("long")), F.lit(-1).cast("long"))


def disjoint_ranges(ranges: DataFrame, encoding: str = "dotted", small: bool = False) -> DataFrame:
    """Ranges cut so that each address lies in at most one: (lo, hi, country).

    As-of matching looks only at the range with the greatest lower bound, so a range ends
    where the next one starts. Of ranges with the same lower bound the one with the greatest
    upper bound, then the greatest country, is kept. Ranges without a bound are dropped. A
    ``small`` table, of checked size, is prepared in one task and without shuffles.
    """
    if small:
        ranges = ranges.coalesce(1)
    bounds = ranges.select(
        ip_to_int(F.col(LOWER), encoding).alias("lo"),
        ip_to_int(F.col(UPPER), encoding).alias("hi"),
        F.col(COUNTRY).cast("string").alias("country"),
    ).where("lo is not null and hi is not null")
    single = bounds.groupBy("lo").agg(F.max(F.struct("hi", "country")).alias("kept"))
    single = single.select("lo", "kept.hi", "kept.country", _block(F.col("lo"), 16).alias("block"))
    if small:
        cut = single.withColumn("next_lo", F.lead("lo").over(Window.orderBy("lo")))
        return _cut(cut)
    # The next lower bound is in the same /16 block (at most 65,536 distinct bounds), or is the
    # first of the next block in use (at most 65,538 blocks, one row each).
    following = F.lead("lo").over(Window.partitionBy("block").orderBy("lo"))
    firsts = single.groupBy("block").agg(F.min("lo").alias("first_lo"))
    next_first = F.lead("first_lo").over(Window.orderBy("block"))
    firsts = firsts.select("block", next_first.alias("next_block_lo"))
    cut = (
        single.withColumn("following", following)
        .join(firsts, "block")
        .withColumn("next_lo", F.coalesce("following", "next_block_lo"))
    )
    return _cut(cut)


def _cut(cut: DataFrame) -> DataFrame:
    return cut.select(
        "lo", F.least(F.col("hi"), F.col("next_lo") - 1).alias("hi"), "country"
    ).where("hi >= lo")


def _pieces(disjoint: DataFrame) -> DataFrame:
    """One row per range and /16 block it touches, with the number of pieces in the block.

    Disjoint ranges cross each block border at most once, so there are at most 65,538 more
    pieces than ranges.
    """
    blocks = F.sequence(_block(F.col("lo"), 16), _block(F.col("hi"), 16))
    pieces = disjoint.select("lo", "hi", "country", F.explode(blocks).alias("block"))
    # Ranges are disjoint and whole numbers, so a block holds at most 65,536 pieces.
    return pieces.withColumn("pieces", F.count(F.lit(1)).over(Window.partitionBy("block")))


def _match(numbers: DataFrame, number: str, pieces: DataFrame, small: bool, out: str) -> DataFrame:
    """Left lookup: a sparse /16 block directly, a dense one by /24, so few candidates per row."""
    hint = F.broadcast if small else (lambda side: side)
    sparse = pieces.where(F.col("pieces") <= DENSE_BLOCK).select(
        F.col("block").alias("__b16"), F.col("lo").alias("__lo16"), F.col("hi").alias("__hi16"),
        F.coalesce("country", F.lit(UNKNOWN)).alias("__c16"),
    )
    first_24 = F.greatest(_block(F.col("lo"), 8), F.shiftleft("block", 8))
    last_24 = F.when(F.col("block") > 65_535, F.lit(1 << 24).cast("long")).otherwise(F.shiftleft("block", 8) + 255)
    dense = pieces.where(F.col("pieces") > DENSE_BLOCK).select(
        F.explode(F.sequence(first_24, F.greatest(first_24, F.least(_block(F.col("hi"), 8), last_24)))).alias("__b24"),
        F.col("lo").alias("__lo24"), F.col("hi").alias("__hi24"),
        F.coalesce("country", F.lit(UNKNOWN)).alias("__c24"),
    )
    ip = F.col(number)
    in_16 = (_block(ip, 16) == F.col("__b16")) & ip.between(F.col("__lo16"), F.col("__hi16"))
    in_24 = (_block(ip, 8) == F.col("__b24")) & ip.between(F.col("__lo24"), F.col("__hi24"))
    found = numbers.join(hint(sparse), in_16, "left").join(hint(dense), in_24, "left")
    return found.withColumn(out, F.coalesce("__c16", "__c24", F.lit(UNKNOWN))).select(*numbers.columns, out)


def locate_addresses(
    df: DataFrame,
    ranges: DataFrame,
    ip_col: str = "ip_address",
    out: str = COUNTRY,
    encoding: str = "dotted",
    broadcast_ranges: int = BROADCAST_RANGES,
    range_encoding: str | None = None,
) -> DataFrame:
    """Add the country of each row's address, ``Unknown`` where no range holds it.

    Every input row comes out once. A null address is ``Unknown``; an unreadable one counts as
    0.0.0.0. ``encoding`` says how addresses are written, ``range_encoding`` the same of the bounds
    where it differs. An existing ``country`` column is replaced. When a needed column is missing or the
    range table is empty the input is returned as it is.
    """
    if ip_col not in df.columns or not {LOWER, UPPER, COUNTRY} <= set(ranges.columns):
        log.warning("address or range columns are missing; rows are not located")
        return df
    # This count is the check of the broadcast size: disjoint ranges give at most one piece each
    # plus one per block border.
    n_ranges = ranges.count()
    if n_ranges == 0:
        log.warning("the range table is empty; rows are not located")
        return df
    small = n_ranges <= broadcast_ranges
    pieces = _pieces(disjoint_ranges(ranges, range_encoding or encoding, small))
    kept = [c for c in df.columns if c != out]
    numbered = df.select(*kept, ip_to_int(F.col(ip_col), encoding).alias("__ip"))
    if small:
        return _match(numbered, "__ip", pieces, True, out).drop("__ip")
    # Too many ranges to broadcast: look up each distinct address once, then join back. The
    # lookup has one row per address, so AQE can split the rows of a very common address.
    distinct = numbered.select("__ip").where("__ip is not null").distinct()
    located = _match(distinct, "__ip", pieces, False, out)
    # Rows without an address stay out of the join, where they would all meet in one partition.
    unknown = numbered.where("__ip is null").select(*kept, F.lit(UNKNOWN).alias(out))
    known = numbered.where("__ip is not null").join(located, "__ip", "left")
    return known.select(*kept, F.coalesce(out, F.lit(UNKNOWN)).alias(out)).unionByName(unknown)
