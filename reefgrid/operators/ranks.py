"""Exact medians, last-write-wins and global numbering without one big group.

An exact median needs a rank, and the built-in aggregate keeps every distinct
value of a group in one buffer. Here ranks are found on counts instead: values
are counted in order-preserving cells, the cell that holds the wanted rank is
located on the (small, bounded) cell table, and only the values of that cell go
on to the next, finer round. Counting combines map-side, so a group with a
third of all rows shuffles no more than its cells.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reefgrid.session import pin

CELLS_PER_OCTAVE = 32
CELLS_PER_BRACKET = 4096
EXACT_ROWS = 200_000  # a cell of this many rows needs no finer cells
NAN_CELL = 1_000_000


def _octave_cell(v: Column) -> Column:
    """Weakly increasing cell number; at most about 140 000 cells for all doubles."""
    # NaN gets the last cell: it is greater than any number.
    octaves = F.least(F.log2(F.abs(v)), F.lit(2000.0))  # infinity gets a cell of its own
    magnitude = F.floor(octaves * CELLS_PER_OCTAVE) + 40000
    return F.when(F.isnan(v), F.lit(NAN_CELL).cast("bigint")).when(v == 0, F.lit(0).cast("bigint")).otherwise((F.signum(v) * magnitude).cast("bigint"))


def _bracket_cell(v: Column, lo: Column, hi: Column) -> Column:
    """Weakly increasing cell number inside ``[lo, hi]``."""
    inside = F.floor((v - lo) / (hi - lo) * CELLS_PER_BRACKET).cast("bigint")
    return F.when(hi > lo, inside).otherwise(F.lit(0).cast("bigint"))


def _locate(cells: DataFrame, keys: list[str], order: str, first: bool) -> DataFrame:
    """The cell of the wanted rank per group, with what lies before and after it."""
    w = Window.partitionBy(*keys).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    stepped = (
        cells.withColumn("_cum", F.sum("_n").over(upto))
        .withColumn("_next", F.lead("_lo").over(w))
    )
    if first:
        whole = Window.partitionBy(*keys)
        stepped = (
            stepped.withColumn("_total", F.sum("_n").over(whole))
            .withColumn("_rank", F.floor((F.col("_total") + 1) / 2).cast("bigint"))
            .withColumn("_before", F.lit(0).cast("bigint"))
            .withColumn("_after", F.lit(None).cast("double"))
        )
    local = F.col("_rank") - F.col("_before")
    return stepped.filter((F.col("_cum") >= local) & (F.col("_cum") - F.col("_n") < local)).select(
        *keys, "_total", "_rank", "_lo", "_hi", "_n",
        (F.col("_before") + F.col("_cum") - F.col("_n")).alias("_before"),
        F.coalesce("_next", "_after").alias("_after"),
    )


CARRIED = ["_total", "_rank", "_before", "_after"]


def _counted() -> list[Column]:
    return [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]


def _values(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    values = df.select(*keys, F.col(value).cast("double").alias("_v"))
    return values.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _count_cells(inside: DataFrame, keys: list[str], exact: bool) -> DataFrame:
    """Counts of the next round: finer cells, or single values in the last one."""
    cell = F.col("_v") if exact else _bracket_cell(F.col("_v"), F.col("_lo"), F.col("_hi"))
    return inside.groupBy(*keys, *CARRIED, cell.alias("_cell")).agg(*_counted())


def _middle_by_cells(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Middle values per group, all groups in the same rounds."""
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    cells = values.groupBy(*keys, _octave_cell(F.col("_v")).alias("_cell")).agg(*_counted())
    bracket = _locate(cells, keys, "_cell", first=True)
    for exact in (False, True):
        own = bracket.select(*[F.col(k).alias(f"_{k}") for k in keys], *CARRIED, "_lo", "_hi")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        inside = values.join(own, same).filter(F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_{k}" for k in keys])
        bracket = _locate(_count_cells(inside, keys, exact), keys, "_cell", first=False)
    upper_rank = F.floor(F.col("_total") / 2) + 1
    upper = F.when(F.col("_before") + F.col("_n") >= upper_rank, F.col("_lo")).otherwise(F.col("_after"))
    return bracket.select(*keys, F.col("_total").alias("n"), F.col("_lo").alias("lower_mid"), upper.alias("upper_mid"))


class Middle(NamedTuple):
    """Count and the two middle values of a column; equal ones for odd counts."""

    n: int
    lower: float
    upper: float

    @property
    def median(self) -> float:
        return (self.lower + self.upper) / 2


def _middle_of(row) -> Middle | None:
    if row is None:
        return None
    upper = row["_lo"] if row["_before"] + row["_n"] >= row["_total"] // 2 + 1 else row["_after"]
    return Middle(row["_total"], row["_lo"], upper)


def middle(df: DataFrame, value: str) -> Middle | None:
    """Exact middle of a column, None for no values.

    Runs up to three short jobs. Each brings one row to the driver, the cell of
    the wanted rank; the next one scans only its range, as pushed-down bounds.
    """
    values = _values(df, value, [])
    cells = values.groupBy(_octave_cell(F.col("_v")).alias("_cell")).agg(*_counted())
    row = _locate(cells, [], "_cell", first=True).first()
    for exact in (False, True):
        if row is None or row["_lo"] == row["_hi"]:
            break
        if not exact and row["_n"] <= EXACT_ROWS:
            continue
        known = [F.lit(row[c]).cast("double" if c in ("_after", "_lo", "_hi") else "bigint").alias(c) for c in (*CARRIED, "_lo", "_hi")]
        inside = values.filter(F.col("_v").between(row["_lo"], row["_hi"])).select("_v", *known)
        row = _locate(_count_cells(inside, [], exact), [], "_cell", first=False).first()
    return _middle_of(row)


def middle_integers(df: DataFrame, value: str) -> Middle | None:
    """``middle`` of a column with few distinct values, from their counts in one pass."""
    cells = _values(df, value, []).groupBy(F.col("_v").alias("_cell")).agg(*_counted())
    return _middle_of(_locate(cells, [], "_cell", first=True).first())


def median_literal(found: Middle | None) -> Column:
    return F.lit(None if found is None else found.median).cast("double")


def grouped_median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact median per group, for every group of ``df``, by counts in cells.

    NaN is greater than any number; a group without values has NULL. ``df`` is
    read several times, so pin it where it is costly.
    """
    found = _middle_by_cells(df, value, keys)
    middles = found.select(*keys, ((F.col("lower_mid") + F.col("upper_mid")) / 2).alias(out))
    same = [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys]
    groups = df.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    return groups.join(middles, same, "left").select(*[F.col(f"_{k}").alias(k) for k in keys], out)


def last_by_key(df: DataFrame, keys: list[str], position: list[str]) -> DataFrame:
    """Keep the row with the greatest position per key; combines map-side."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*position)).alias("_row"))
    return picked.select(*[F.col(k) if k in keys else F.col("_row")[k].alias(k) for k in df.columns])


def number_rows(df: DataFrame, order: list[str], out: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in global order.

    Range partitioning sorts in parallel; each partition then only needs the
    number of rows in the partitions before it, one row per partition.
    """
    position = F.monotonically_increasing_id()
    ranged = pin(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(position, 33).cast("int"))
        .withColumn("_row", position.bitwiseAND((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(out, (F.col("_offset") + F.col("_row") + start).cast("bigint"))
        .drop("_part", "_row", "_offset")
    )
