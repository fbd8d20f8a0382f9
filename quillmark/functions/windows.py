"""Window specifications over a book's lines (made when asked for: they need a session)."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def order() -> WindowSpec:
    return Window.partitionBy("book").orderBy("line_no")


def so_far() -> WindowSpec:
    return order().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before() -> WindowSpec:
    return order().rowsBetween(Window.unboundedPreceding, -1)


def whole() -> WindowSpec:
    return Window.partitionBy("book")


def last_known(x: Column | str) -> Column:
    """The last value of earlier lines that isn't null."""
    return F.last(x, True).over(before())


def next_known(x: Column | str) -> Column:
    """The first value of later lines that isn't null.  Read backwards: a frame
    that begins at the next row would be summed up anew for each row."""
    back = Window.partitionBy("book").orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(x, True).over(back)
