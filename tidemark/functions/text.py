"""Splitting text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column | str) -> Column:
    """Array of the pieces between single spaces.

    Empty pieces at the end are dropped, those in front and in between are kept. An empty text has
    one empty piece and a text of nothing but spaces has none.
    """
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.rtrim(text)
    only_spaces = (F.length(text) > 0) & (F.length(trimmed) == 0)
    return F.when(~only_spaces, F.split(trimmed, " "))
