"""Previous row, next row and row number inside a group, safe for hot groups.

A plain window puts each group into one task. Here every group is cut into
hours: windows run per (group, slot), and a table with one row per group and
slot carries the slot borders. Both come out of one shuffle of the rows by
(group, slot), so the source is read once. A group of any size takes the same
path; no task holds more than its hour.

Rows are ordered by ``created_at`` (NULL last), then ``id``; ids are unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from logtally.functions.values import epoch_micros, rows

SLOT_SECONDS = 3600

_SLOT = "_slot"
_NO_TIME = 1 << 61  # above every time slot
_NULL_ACCOUNT = -(1 << 61)  # outside the range of account ids


def order_keys() -> list[Column]:
    return [F.col("created_at").asc_nulls_last(), F.col("id").asc_nulls_last()]


def account_group() -> Column:
    """Account id as a group key: NULL is a group of its own and can be joined."""
    return F.coalesce(F.col("account_id").cast("bigint"), F.lit(_NULL_ACCOUNT))


def _slot_of_row(slot_seconds: int) -> Column:
    """Grows with (created_at NULL last, id), so slots keep the row order."""
    by_time = F.floor(epoch_micros(F.col("created_at")) / (slot_seconds * 1_000_000))
    by_id = F.lit(_NO_TIME) + F.shiftright(F.col("id"), 20)
    return F.coalesce(by_time, by_id, F.lit(_NO_TIME))


class Ordered:
    """``df`` prepared for ordered access within groups of ``keys``.

    Key columns must not be NULL.
    """

    def __init__(self, df: DataFrame, keys: list[str], slot_seconds: int = SLOT_SECONDS) -> None:
        self.keys = keys
        self.cells = [*keys, _SLOT]
        self.columns = df.columns
        self.rows = df.withColumn(_SLOT, _slot_of_row(slot_seconds)).repartition(*self.cells)

    def _in_cell(self):
        return Window.partitionBy(*self.cells).orderBy(*order_keys())

    def _over_slots(self):
        return Window.partitionBy(*self.keys).orderBy(_SLOT)

    def _borders(self, pick, across: Column) -> DataFrame:
        """One row per cell with ``_across``, from the cells' border rows.

        A border is the whole row: the aggregate then needs all columns, like
        the window beside it, and both read the same shuffled rows.
        """
        position = F.struct(F.col("created_at").isNull(), "created_at", "id")
        return (
            self.rows.groupBy(*self.cells)
            .agg(pick(F.struct(*self.columns), position).alias("_border"), rows().alias("_n"))
            .select(*self.cells, across.alias("_across"))
        )

    def neighbour(self, columns: list[str], name: str, ahead: bool) -> DataFrame:
        """Add struct ``name``: ``columns`` of the next (or previous) row."""
        fields = F.struct(*columns)
        if ahead:
            inside = F.lead(fields).over(self._in_cell())
            borders = self._borders(F.min_by, F.lead("_border").over(self._over_slots()))
        else:
            inside = F.lag(fields).over(self._in_cell())
            borders = self._borders(F.max_by, F.lag("_border").over(self._over_slots()))
        border = F.struct(*[F.col(f"_across.{c}").alias(c) for c in columns])
        found = F.when(F.col("_across").isNotNull(), border)
        return (
            self.rows.withColumn(name, inside)
            .join(borders, self.cells, "left")
            .withColumn(name, F.coalesce(name, found))
            .drop("_across", _SLOT)
        )

    def number(self, name: str) -> DataFrame:
        """Add the 1-based row number ``name`` within each group."""
        before = self._over_slots().rowsBetween(Window.unboundedPreceding, -1)
        # The border's id is never NULL: it adds the row's dependence, not a value.
        known = F.when(F.col("_border.id").isNotNull(), F.col("_n"))
        borders = self._borders(F.max_by, F.sum(known).over(before))
        inside = F.row_number().over(self._in_cell())
        return (
            self.rows.withColumn(name, inside.cast("bigint"))
            .join(borders, self.cells, "left")
            .withColumn(name, F.col(name) + F.coalesce("_across", F.lit(0)))
            .drop("_across", _SLOT)
        )
