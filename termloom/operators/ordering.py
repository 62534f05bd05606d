"""Exact cuts, positions and permutations without a one-partition window over the rows.

Draws are uniform hexadecimal digits. Counting rows per leading digits locates any rank in a few
narrow passes, and gives every row its position from the counts in front of it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from termloom.functions.hashing import DRAW_DIGITS, slot

# Ranges a group is cut into at a time, and the rows from which on a group is cut again.
GROUPS = 65_536
GROUP_ROWS = 1_000_000
# Bytes of a range of shuffled rows.
RANGE_BYTES = 128 << 20
MOST_DOUBLE = 1.7976931348623157e308

# 16**4 = 65,536 counters at most per pass: a fixed bound, whatever the number of rows.
STEP_DIGITS = 4


def _crossing(counts: DataFrame, before: Column, wanted: Column) -> DataFrame:
    """The row of ``(head, rows)`` in which the running count reaches ``wanted``."""
    running = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, 0)
    upto = before + F.sum("rows").over(running)
    return (
        counts.select("head", "rows", upto.alias("upto"), wanted.alias("wanted"))
        .filter("upto - rows < wanted and upto >= wanted")
        .select(
            F.struct(
                "head", "rows", (F.col("upto") - F.col("rows")).alias("before"), "wanted"
            ).alias("at")
        )
    )


def cut_point(df: DataFrame, drawn: str, size: Callable[[Column], Column]) -> DataFrame:
    """One row with ``cut``: the draw of rank ``size(number of rows)``, NULL for size 0.

    ``drawn`` names a column of distinct draws. Three passes read that column only: counts by 4
    digits, counts by 8 digits inside one of the 65,536 groups, and the handful of draws that
    share those 8 digits. No pass moves more than 65,536 counters to one task.
    """
    draws = df.select(F.col(drawn).alias("drawn"))

    def counts(rows: DataFrame, digits: int) -> DataFrame:
        head = F.substring("drawn", 1, digits).alias("head")
        return rows.groupBy(head).agg(F.count("*").alias("rows"))

    total = F.sum("rows").over(Window.partitionBy())
    at = _crossing(
        counts(draws, STEP_DIGITS), F.lit(0), F.least(size(total).cast("bigint"), total)
    )
    for digits in (2 * STEP_DIGITS, DRAW_DIGITS):
        here = at.scalar()
        inside = draws.filter(F.col("drawn").startswith(here["head"]))
        at = _crossing(counts(inside, digits), here["before"], here["wanted"])
    # A cut through equal draws would not give the exact size.
    repeated = F.raise_error("the keys of a sample must not repeat").cast("string")
    last = F.col("at")
    return at.select(F.when(last["rows"] > 1, repeated).otherwise(last["head"]).alias("cut"))


def up_to(df: DataFrame, drawn: str, cut: Column) -> DataFrame:
    """Rows whose draw does not exceed the cut; none for a NULL cut."""
    return df.filter(F.col(drawn) <= cut)


def row_index(df: DataFrame, drawn: str, name: str = "row_index") -> DataFrame:
    """0-based position of every row in the order of its draws, dense over the whole table.

    Rows are spread over the leading digits and ranked there; the counts in front of each group
    are one small table of at most 65,536 rows, so broadcasting it is safe.
    """
    keyed = df.withColumn("_head", F.substring(drawn, 1, STEP_DIGITS))
    running = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_head")
        .agg(F.count("*").alias("_rows"))
        .select("_head", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_head").orderBy(drawn)
    return (
        keyed.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(offsets), "_head")
        .withColumn(name, F.col("_before") + F.col("_rank") - 1)
        .drop("_head", "_before", "_rank")
    )


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the values: texts by their first six bytes."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.StringType, T.BinaryType)):
        start = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(start, 16, 10).cast("double")
    return value.cast("double")


def _finite(number: Column) -> Column:
    return F.when(F.abs(number) <= F.lit(MOST_DOUBLE), number)


def _spot(number: Column, low: Column, high: Column) -> Column:
    """Group of a number between two bounds; NULL, infinities and NaN stand beside the groups."""
    # Halves, as the distance of two doubles may be none.
    share = F.try_divide(number / 2 - low / 2, high / 2 - low / 2) * GROUPS
    inside = F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0))), F.lit(0)), F.lit(GROUPS - 1))
    return (
        F.when(number.isNull(), -2)
        .when(F.isnan(number), GROUPS + 1)
        .when(number > MOST_DOUBLE, GROUPS)
        .when(number < -MOST_DOUBLE, -1)
        .otherwise(inside)
        .cast("int")
    )


def grouped_for_rank(
    df: DataFrame, value: str, key: str, descending: bool = False, group_rows: int = GROUP_ROWS, levels: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Rows with their groups ``_g1`` to ``_g3``, and the groups with the number of rows before each.

    Rows fall into GROUPS equal ranges of the value. A group of more than ``group_rows`` rows is cut again,
    between its own bounds: by value, or by key where all its values are one. So a value that a third
    of the rows share is spread by its keys. What is larger after the last cut stays a group.
    """
    sign = -1 if descending else 1
    rows = df.withColumns({"_v": _number(df, value), "_k": _number(df, key)})
    bounds = [
        F.min(_finite(F.col("_v"))).alias("_v_low"),
        F.max(_finite(F.col("_v"))).alias("_v_high"),
        F.min(_finite(F.col("_k"))).alias("_k_low"),
        F.max(_finite(F.col("_k"))).alias("_k_high"),
    ]
    whole = rows.agg(F.struct(*bounds)).scalar()
    rows = rows.withColumn("_g1", sign * _spot(F.col("_v"), whole["_v_low"], whole["_v_high"]))
    names, sizes, cut = ["_g1"], [], rows
    for level in range(2, levels + 2):
        size = cut.groupBy(*names).agg(F.count("*").alias("_rows"), *bounds)
        sizes.append((list(names), size))
        if level > levels:
            break
        # A group is large for at least group_rows rows, so there are few: at most one per group_rows.
        large = F.broadcast(size.filter(F.col("_rows") > group_rows).drop("_rows").withColumn("_large", F.lit(True)))
        name = f"_g{level}"
        by_value = sign * _spot(F.col("_v"), F.col("_v_low"), F.col("_v_high"))
        by_key = _spot(F.col("_k"), F.col("_k_low"), F.col("_k_high"))
        finer = F.when(F.col("_large"), F.when(F.col("_v_high") > F.col("_v_low"), by_value).otherwise(by_key)).otherwise(0)
        gone = ["_large", "_v_low", "_v_high", "_k_low", "_k_high"]
        rows = rows.join(large, names, "left").withColumn(name, finer).drop(*gone)
        # Only rows of large groups are counted once more.
        cut = cut.join(large, names).withColumn(name, finer).drop(*gone)
        names = [*names, name]

    # Rows before a group: those before the group it was cut from, and those of its elder siblings.
    before = F.lit(0)
    parents: DataFrame | None = None
    leaves = []
    for by, size in sizes:
        here = size.select(*by, "_rows")
        last = by[-1]
        running = Window.partitionBy(*by[:-1]).orderBy(last).rowsBetween(Window.unboundedPreceding, -1)
        placed = here.withColumn("_before", F.coalesce(F.sum("_rows").over(running), F.lit(0)))
        if parents is not None:
            up = parents.select(*by[:-1], F.col("_before").alias("_up"))
            placed = placed.join(up, by[:-1]).withColumn("_before", F.col("_before") + F.col("_up")).drop("_up")
        missing = [F.lit(0).alias(n) for n in names if n not in by]
        final = placed if by == names else placed.filter(F.col("_rows") <= group_rows)
        leaves.append(final.select(*by, *missing, "_before").select(*names, "_before"))
        parents = placed
    return rows.drop("_v", "_k"), reduce(DataFrame.unionAll, leaves)


def rank_by(
    df: DataFrame, value: str, key: str, descending: bool = False, name: str = "position", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """0-based position in the order of ``value``, ties by ``key``, for values that are not uniform.

    Groups in the order of the values are counted and cut further only where they are too large, then ranked
    one by one. The plan is lazy: passes read value and key only, and those for further cuts end at once where no
    group needs them. Repeated (value, key) rows take neighbouring positions.
    """
    rows, leaves = grouped_for_rank(df, value, key, descending, group_rows)
    names = ["_g1", "_g2", "_g3"]
    first = F.col(f"`{value}`").desc() if descending else F.col(f"`{value}`").asc()
    within = Window.partitionBy(*names).orderBy(first, F.col(f"`{key}`"))
    return (
        rows.withColumn("_rank", F.row_number().over(within))
        .join(leaves, names)
        .withColumn(name, F.col("_before") + F.col("_rank") - 1)
        .select(*(F.col(f"`{c}`") for c in df.columns), name)
    )


def top_scores(df: DataFrame, score: str, key: str, count: int) -> DataFrame:
    """The highest scores with their 0-based position; ties go by key."""
    best = df.orderBy(F.col(score).desc(), F.col(key)).limit(count)
    order = Window.orderBy(F.col(score).desc(), F.col(key))
    return best.withColumn("position", F.row_number().over(order).cast("bigint") - 1)


def head(df: DataFrame, *order: Column, count: int = 3) -> DataFrame:
    return df.orderBy(*order).limit(count)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: of its texts, of nested values as JSON, and eight for anything else."""
    sizes = [F.lit(0).cast("bigint")]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(F.struct(column))
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.lit(8))
            continue
        sizes.append(F.coalesce(F.octet_length(column), F.lit(0)))
    return sum(sizes[1:], sizes[0])


def range_count(df: DataFrame, drawn: str, size: Column, range_bytes: int) -> int:
    """The fewest halvings of the range of draws that leave at most ``range_bytes`` in each part.

    Bytes are counted per four leading digits: 65,536 counters at most, which the driver adds up for
    every number of halvings. Only a table that fills more parts than that is counted by six digits, and added up by
    Spark. A part with a single draw cannot be cut, whatever its bytes.
    """

    def counted(digits: int) -> DataFrame:
        head = F.conv(F.substring(drawn, 1, digits), 16, 10).cast("bigint").alias("head")
        return (
            df.select(head, size.alias("size"))
            .groupBy("head")
            .agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
        )

    sizes = np.zeros((16**STEP_DIGITS, 2), np.int64)
    for head, held, rows in counted(STEP_DIGITS).collect():
        sizes[head] = held, rows
    for halvings in range(4 * STEP_DIGITS + 1):
        parts = sizes.reshape(1 << halvings, -1, 2).sum(axis=1)
        if ((parts[:, 0] <= range_bytes) | (parts[:, 1] <= 1)).all():
            return 1 << halvings

    digits = STEP_DIGITS + 2
    deeper = F.sequence(F.lit(4 * STEP_DIGITS + 1), F.lit(4 * digits))
    part = F.expr(f"shiftright(head, {4 * digits} - halvings)").alias("part")
    parts = counted(digits).withColumn("halvings", F.explode(deeper)).groupBy("halvings", part)
    fits = (F.sum("size") <= range_bytes) | (F.sum("rows") <= 1)
    fitting = parts.agg(fits.alias("fits")).groupBy("halvings").agg(F.bool_and("fits").alias("fits"))
    enough = fitting.agg(F.min(F.when(F.col("fits"), F.col("halvings")))).first()[0]
    # Rows of very uneven size: parts of that many bytes on average.
    return 1 << (enough or max(0, -(-int(sizes[:, 0].sum()) // range_bytes) - 1).bit_length())


def shuffle_rows(
    df: DataFrame,
    drawn: str,
    partitions: int | None = None,
    range_bytes: int = RANGE_BYTES,
    size: Column | None = None,
) -> DataFrame:
    """Seeded permutation: rows globally sorted by their draws.

    Draws are uniform, so equal ranges of them are known in advance and rows go straight to
    their range; ``orderBy`` would sample its range bounds from the rows. Without ``partitions`` there are as many
    ranges as it takes to hold at most ``range_bytes`` (of ``size``) each, found from a histogram of the draws. The
    order is the same for any number of ranges.
    """
    if partitions is None:
        partitions = range_count(df, drawn, row_bytes(df) if size is None else size, range_bytes)
    target = slot(F.col(drawn), F.lit(partitions))
    return df.repartitionById(partitions, target).sortWithinPartitions(drawn)
