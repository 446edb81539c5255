"""Sample blocks with halos.

A long recording may hold a large share of all rows, so no window or kernel may be
partitioned by (recording, channel) alone. Every operator that looks at neighbouring
samples works on fixed-length blocks of the sample clock instead. Rows close to a block
edge are copied into the neighbouring block (the halo), so each block can be processed on
its own and the result equals the unblocked one. One shuffle, `halo / size` extra rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16


def with_blocks(df: DataFrame, t: str = "t", size: int = BLOCK, before: int = 0, after: int = 0, wide: bool = False) -> DataFrame:
    """Add `_block` and `_core`; halo copies have `_core = false`. Only with `wide` may a halo reach over several blocks."""
    if max(before, after) > size and not wide:
        raise ValueError("halo must not exceed the block size")
    own = F.floor(F.col(t) / F.lit(size)).cast("bigint")
    offset = F.col(t) - own * F.lit(size)
    if not before and not after:
        return df.withColumn("_block", own).withColumn("_core", F.lit(True))
    if max(before, after) > size:  # the halo reaches over several blocks
        first, last = (F.floor((F.col(t) + F.lit(d)) / F.lit(size)).cast("bigint") for d in (-after, before))
        return df.withColumn("_block", F.explode(F.sequence(first, last))).withColumn("_core", F.col("_block") == own)
    # most rows keep the one-entry array: no row pays for building and compacting a longer one
    late, early = offset >= F.lit(size - before), offset < F.lit(after)
    targets = F.array(own)
    if after:
        targets = F.when(early, F.array(own, own - 1)).otherwise(targets)
    if before:
        targets = F.when(late, F.array(own, own + 1)).otherwise(targets)
    if before and after:
        targets = F.when(late & early, F.array(own, own + 1, own - 1)).otherwise(targets)
    return df.withColumn("_block", F.explode(targets)).withColumn("_core", F.col("_block") == own)


def pack_blocks(df: DataFrame, keys: list[str], t: str = "t", value: str = "value", size: int = BLOCK) -> DataFrame:
    """Compact form: one row per key and block with its first clock value and the ordered values."""
    block = F.floor(F.col(t) / F.lit(size)).cast("bigint")
    pairs = F.array_sort(F.collect_list(F.struct(F.col(t).alias("t"), F.col(value).alias("v"))))  # at most `size` entries
    packed = df.groupBy(*keys, block.alias("block")).agg(pairs.alias("_p"))
    return packed.select(*keys, "block", F.col("_p")[0]["t"].alias("start"), F.transform("_p", lambda p: p["v"]).alias("values"))


def unpack_blocks(blocks: DataFrame, keys: list[str], t: str = "t", value: str = "value") -> DataFrame:
    """Long form of dense blocks; needs no shuffle."""
    rows = blocks.select(*keys, "start", F.posexplode("values").alias("_i", value))
    return rows.select(*keys, (F.col("start") + F.col("_i")).alias(t), value)


def neighbours(
    df: DataFrame,
    keys: list[str],
    outputs: dict[str, tuple[str, int]],
    t: str = "t",
    size: int = BLOCK,
) -> DataFrame:
    """Add neighbours of a dense sample clock: `outputs[name] = (column, offset)`.

    A negative offset looks back (lag), a positive one forward (lead).
    """
    before = max([0] + [-k for _, k in outputs.values()])
    after = max([0] + [k for _, k in outputs.values()])
    blocked = with_blocks(df, t, size, before, after)
    w = Window.partitionBy(*keys, "_block").orderBy(t)
    for name, (column, k) in outputs.items():
        blocked = blocked.withColumn(name, F.lag(column, -k).over(w) if k < 0 else F.lead(column, k).over(w))
    return blocked.where("_core").drop("_block", "_core")


def rolling(df: DataFrame, keys: list[str], name: str, agg: Column, before: int, after: int,
            t: str = "t", size: int = BLOCK) -> DataFrame:
    """Rolling aggregate over `[t - before, t + after]` on a dense sample clock."""
    w = Window.partitionBy(*keys, "_block").orderBy(t).rowsBetween(-before, after)
    blocked = with_blocks(df, t, size, before, after)
    return blocked.withColumn(name, agg.over(w)).where("_core").drop("_block", "_core")
