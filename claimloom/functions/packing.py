"""Several text columns as one, for rows that are about to be shuffled.

Each text column of a row takes sixteen bytes and more besides its characters; claim lines and
screenings have many of a few characters. Any text, empty and NULL ones too, comes back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Between texts; in place of NULL, and before what stands for either character in a text.
_NEXT, _MARK = "\x01", "\x02"


def packed(columns: list[str]) -> Column:
    """The columns, as text, in one text."""

    def safe(name: str) -> Column:
        text = F.replace(F.col(name).cast("string"), F.lit(_MARK), F.lit(_MARK + "b"))
        text = F.replace(text, F.lit(_NEXT), F.lit(_MARK + "a"))
        return F.coalesce(text, F.lit(_MARK))

    return F.concat_ws(_NEXT, *[safe(name) for name in columns])


def parts(text: Column) -> Column:
    """The array that :func:`unpacked` reads; a column of its own, so that it is built once."""
    return F.split(text, _NEXT, -1)


def unpacked(array: Column, columns: list[str]) -> list[Column]:
    """The columns of a packed text, by the names and in the order they were packed in."""

    def plain(position: int) -> Column:
        part = F.get(array, F.lit(position))
        text = F.replace(part, F.lit(_MARK + "a"), F.lit(_NEXT))
        return F.when(part != _MARK, F.replace(text, F.lit(_MARK + "b"), F.lit(_MARK)))

    return [plain(i).alias(name) for i, name in enumerate(columns)]
