"""Ordered work without a single-task sort: radix cells, running totals, exact ranks and quantiles.

A global window would send every row to one task.  Here values become integers in the same order (``coded``), whose
high bits cut them into cells.  Cells are only counted; counts give the offset of each, and a cell is cut further, twelve
bits at a time, until a task can sort what is in it or all its values are equal.  All groups are refined together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoints, materialised, shuffle_width

#: How far a code is shifted to give its cell, step by step: sixteen bits first, then twelve more at a time.
SHIFTS = (48, 36, 24, 12, 0)
#: Rows of one cell that a task may sort.
FIT = 1 << 16
#: Lists of cells up to this length are sent to the rows; longer ones are shuffled, but for cells with many rows.
SENT_CELLS, HOT = 1 << 16, 1000


def coded(df: DataFrame, value: str, name: str = "_code") -> DataFrame:
    """Adds a 64-bit integer that sorts as ``value`` does: integers are their own, doubles get sign, exponent and fraction.

    The bits of a double are found by arithmetic that is exact: scaling by powers of two.  NaN comes last, NULL stays.
    """
    kind = df.schema[value].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df.withColumn(name, F.col(value).cast("long"))
    two = F.lit(2.0)
    tiny = F.lit(2.0**-1022)
    out = df.withColumn("_x", F.col(value).cast("double")).withColumn("_a", F.abs("_x"))
    # A logarithm may be off by one at a power of two; the fraction tells.
    plain = (F.col("_a") >= tiny) & (F.col("_a") < F.lit(float("inf")))
    out = out.withColumn("_e", F.when(plain, F.greatest(F.floor(F.log2("_a")), F.lit(-1022)))).withColumn("_f", F.col("_a") / F.pow(two, F.col("_e").cast("double")))
    out = out.withColumn("_e", F.when(F.col("_f") >= 2, F.col("_e") + 1).when(F.col("_f") < 1, F.col("_e") - 1).otherwise(F.col("_e")))
    out = out.withColumn("_f", F.col("_a") / F.pow(two, F.col("_e").cast("double")))
    normal = F.shiftleft(F.col("_e") + 1023, 52) + ((F.col("_f") - 1) * F.lit(2.0**52)).cast("long")
    subnormal = (F.least("_a", tiny) * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    size = F.when(F.col("_x").isNull(), F.lit(None).cast("long")).when(F.isnan("_x"), F.lit((2047 << 52) + 1)).when(F.col("_a") == F.lit(float("inf")), F.lit(2047 << 52))
    size = size.when(F.col("_a") >= tiny, normal).otherwise(subnormal)
    return out.withColumn(name, F.when(F.col("_x") < 0, -size).otherwise(size)).drop("_x", "_a", "_e", "_f")


def bucket_of(value: str | Column, bounds: list[float]) -> Column:
    """Index of the interval: how many of a few fixed bounds lie below the value (binary search as nested CASE)."""
    c = F.col(value) if isinstance(value, str) else value

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(c <= F.lit(bounds[mid]), search(low, mid)).otherwise(search(mid + 1, high))

    return search(0, len(bounds))


def in_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` that lie in ``cells`` (_key, _cell, _c rows each, more columns), with those columns.

    A short list of cells goes to the rows.  Of a long one, only cells with more than one row in ``HOT`` do, which are at
    most ``HOT``; the others can't pile up and are shuffled.
    """
    if cells.count() <= SENT_CELLS:
        return rows.join(F.broadcast(cells), ["_key", "_cell"])
    total = cells.agg(F.sum("_c").alias("n")).first()["n"]
    hot = F.col("_c") * HOT > total
    few = F.broadcast(cells.filter(hot))
    rest = rows.join(few.select("_key", "_cell"), ["_key", "_cell"], "left_anti").join(cells.filter(~hot), ["_key", "_cell"])
    return rest.unionByName(rows.join(few, ["_key", "_cell"]))


def with_quantiles(df: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """One row per group beside its quantiles; NULL meets NULL, and without groups one row meets one row."""
    other = found.select(*[F.col(c) if c not in by else F.col(c).alias(f"_own_{c}") for c in found.columns])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_own_{c}"))
    joined = df.join(other, same, "left") if by else df.join(F.broadcast(other))
    return joined.drop(*[f"_own_{c}" for c in by])


def group_key(by: list[str]) -> Column:
    """Groups as one value, so that NULL is a group like any other."""
    return (F.struct(*[F.col(c) for c in by]) if by else F.lit(0)).alias("_key")


def running_totals(df: DataFrame, value: str, sums: dict[str, str], by: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Inclusive running totals of columns in the order of ``value``.

    ``sums`` maps output name to summed column.  ``value`` must be distinct per
    ``by`` group, so aggregate ties first.  Adds one column per entry.
    """
    names, columns = list(sums), df.columns
    rows = coded(df, value)
    if descending:
        rows = rows.withColumn("_code", F.bitwise_not("_code"))
    rows = rows.select("*", group_key(by or []), F.lit(0).cast("long").alias("_cell"), *[F.lit(0).alias(f"_o_{o}") for o in names])
    done = None
    for shift in SHIFTS:
        rows = rows.withColumnRenamed("_cell", "_cell_above").withColumn("_cell", F.shiftright("_code", shift))
        counts = rows.groupBy("_key", "_cell_above", "_cell").agg(
            F.count(F.lit(1)).alias("_c"), *[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()], *[F.max(f"_o_{o}").alias(f"_o_{o}") for o in names])
        # At most 2^16 counts per group, then 2^12 per cell that is cut.
        before = Window.partitionBy("_key", "_cell_above").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        offsets = [(F.col(f"_o_{o}") + F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0))).alias(f"_o_{o}") for o in names]
        cells = materialised(counts.select("_key", "_cell", "_c", *offsets))
        plain = rows.drop("_cell_above", *[f"_o_{o}" for o in names])
        large = cells.filter(F.col("_c") > FIT) if shift else cells.limit(0)
        last = not shift or large.isEmpty()
        part = in_cells(plain, cells if last else cells.filter(F.col("_c") <= FIT)).withColumn("_step", F.lit(shift))
        done = part if done is None else done.unionByName(part)
        if last:
            break
        rows = in_cells(plain, large).drop("_c")
    inside = Window.partitionBy("_step", "_key", "_cell").orderBy("_code").rowsBetween(Window.unboundedPreceding, 0)
    return done.select(*[F.col(f"`{c}`") for c in columns], *[(F.col(f"_o_{o}") + F.sum(c).over(inside)).alias(o) for o, c in sums.items()])


def exact_quantiles(df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group, one column per entry of ``quantiles``; NULL is a group, too.

    Cells are counted, those that hold no wanted rank are dropped before anything else is looked at, and the rest is
    cut further while it is too large to be sorted by a task.  Equal values are counted before they meet, so a cell of
    one value is one row for the task, however many rows it has, and is not cut.
    """
    by = by or []
    # Written with their codes: a join to cells would else push the test of its key down through the code's formula, many times over per row.
    rows = materialised(coded(df.select(group_key(by), F.col(value).cast("double").alias("_v")).filter("_v is not null"), "_v"))

    def low_rank(p: float) -> Column:
        return F.floor(F.lit(p) * (F.col("_n") - 1) + F.lit(1e-9))

    def holds(rank: Column, lo: str, count: str) -> Column:
        return (rank >= F.col(lo)) & (rank < F.col(lo) + F.col(count))

    wanted = F.lit(False)
    for p in set(quantiles.values()):
        wanted = wanted | holds(low_rank(p), "_lo", "_c") | holds(F.least(low_rank(p) + 1, F.col("_n") - 1), "_lo", "_c")
    near, above = rows.withColumn("_cell", F.lit(0).cast("long")), None
    values = None
    for shift in SHIFTS:
        near = near.withColumnRenamed("_cell", "_cell_above").withColumn("_cell", F.shiftright("_code", shift))
        kept = [F.max(c).alias(c) for c in ("_n", "_lo")] if above is not None else []
        counts = near.groupBy("_key", "_cell_above", "_cell").agg(F.count(F.lit(1)).alias("_c"), (F.min("_code") < F.max("_code")).alias("_mixed"), *kept)
        group = Window.partitionBy("_key", "_cell_above")
        before = F.sum("_c").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")
        if above is None:
            counts = counts.withColumn("_n", F.sum("_c").over(group)).withColumn("_lo", before)
        else:
            counts = counts.withColumn("_lo", F.col("_lo") + before)
        cut = (F.col("_c") > FIT) & F.col("_mixed")
        above = materialised(counts.filter(wanted).select("_key", "_cell", "_c", "_n", "_lo", cut.alias("_cut")))
        plain = near.select("_key", "_v", "_code", "_cell")
        large = above.filter("_cut") if shift else above.limit(0)
        last = not shift or large.isEmpty()
        held = in_cells(plain, above if last else above.filter("not _cut"))
        held = held.groupBy("_key", "_cell", "_v", "_code", "_n", "_lo").agg(F.count(F.lit(1)).alias("_m")).withColumn("_step", F.lit(shift))
        values = held if values is None else values.unionByName(held)
        if last:
            break
        near = in_cells(plain, large).drop("_c", "_cut")
    inside = Window.partitionBy("_step", "_key", "_cell").orderBy("_code").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("_first", F.col("_lo") + F.sum("_m").over(inside) - F.col("_m"))
    picks = []
    for name, p in quantiles.items():
        low, high = low_rank(p), F.least(low_rank(p) + 1, F.col("_n") - 1)
        picks.append(F.max(F.when(holds(low, "_first", "_m"), F.col("_v"))).alias(f"_l_{name}"))
        picks.append(F.max(F.when(holds(high, "_first", "_m"), F.col("_v"))).alias(f"_h_{name}"))
    found = values.groupBy("_key").agg(F.max("_n").alias("_n"), *picks)
    out = []
    for name, p in quantiles.items():
        weight = F.lit(p) * (F.col("_n") - 1) - low_rank(p)
        out.append((F.col(f"_l_{name}") + weight * (F.col(f"_h_{name}") - F.col(f"_l_{name}"))).alias(name))
    return found.select(*[F.col("_key").getField(c).alias(c) for c in by], *out)


def kth_largest(df: DataFrame, value: str, k: int) -> float | None:
    """The k-th largest value (1-based) as a number; NULL-free input.

    The driver gets counts of cells, at most 2^16 in the first step and 2^12 later, or the values of one cell of ``FIT`` rows.
    """
    rows, left = coded(df.select(F.col(value).cast("double").alias("_v")), "_v"), k
    for shift in SHIFTS:
        cells = rows.groupBy(F.shiftright("_code", shift).alias("_cell")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("low"), F.max("_v").alias("high")).collect()
        hit = None
        for cell in sorted(cells, key=lambda r: -r["_cell"]):
            if left <= cell["_c"]:
                hit = cell
                break
            left -= cell["_c"]
        if hit is None:
            return None
        if hit["low"] == hit["high"]:
            return hit["high"]
        rows = rows.filter(F.shiftright("_code", shift) == F.lit(hit["_cell"]))
        if hit["_c"] <= FIT:
            return sorted((r["_v"] for r in rows.select("_v").collect()), reverse=True)[left - 1]
    return hit["high"]


def global_number(df: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Dense 1-based numbering in a total order of any column types.

    The frame is range-sorted and written to the checkpoint folder, which fixes
    which row sits in which partition; partition counts then give the offsets.
    """
    ensure_checkpoints(df.sparkSession)
    placed = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()).checkpoint()
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    local = Window.partitionBy("_pid").orderBy(*order)
    return (
        placed.withColumn("_r", F.row_number().over(local))
        .join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_o") + F.col("_r"))
        .drop("_pid", "_r", "_o")
    )


def hash_rank(df: DataFrame, by: list[str], ident: list[str], seed: int, name: str, total: str) -> DataFrame:
    """Rank rows of each group in a seeded random order, and add the group's size.

    Order is that of a 64-bit hash of the identifying columns; its high bits cut
    every group into even pieces, as many as the cluster's shuffle setting calls
    for, so a hot group is shared out.  The order does not depend on that number.
    """
    bits = min(16, max(8, (2 * shuffle_width(df.sparkSession, 32768)).bit_length()))
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(c) for c in ident])).withColumn(
        "_b", F.shiftright("_h", 64 - bits)
    )
    sizes = hashed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, "_b", F.sum("_c").over(group).alias(total),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"),
    )
    local = Window.partitionBy(*by, "_b").orderBy("_h", *ident)
    return (
        hashed.withColumn("_r", F.row_number().over(local))
        .join(offsets, by + ["_b"])
        .withColumn(name, F.col("_o") + F.col("_r"))
        .drop("_h", "_b", "_r", "_o")
    )
