"""From message text to typed columns."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Fixed value: how user events write their time.
USER_EVENT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def decode_json(
    df: DataFrame, schema: StructType, keep: Sequence[str] = (), column: str = "value"
) -> DataFrame:
    """Fields of the JSON object in ``column``, with the ``keep`` columns behind them.

    Text that is not such an object gives a row of NULLs.
    """
    parsed = df.select(F.from_json(F.col(column).cast("string"), schema).alias("__json"), *keep)
    return parsed.select("__json.*", *keep)


def delimited(*fields: Column | str, sep: str = ",") -> Column:
    """Fields as one line of text. A NULL is an empty field, so that what follows keeps its place."""
    columns = (F.col(f) if isinstance(f, str) else f for f in fields)
    return F.concat_ws(sep, *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))


def decode_delimited(df: DataFrame, schema: StructType, sep: str = ",", column: str = "value") -> DataFrame:
    """Bind the pieces of ``column`` to the fields of ``schema`` by position; other columns stay.

    A piece that is missing or does not fit its type is NULL. There is no quoting.
    """
    pieces = F.split(F.col(column).cast("string"), re.escape(sep))
    fields = [
        _typed(F.get("__pieces", F.lit(i)), field.dataType).alias(field.name)
        for i, field in enumerate(schema.fields)
    ]
    others = [c for c in df.columns if c != column]
    # A filter on the fields is not moved below this step, where each of its terms would split the line again.
    split_once = df.select(*others, F.explode(F.array(pieces)).alias("__pieces"))
    return split_once.select(*others, *fields)


def _typed(text: Column, data_type) -> Column:
    return text if isinstance(data_type, StringType) else text.try_cast(data_type)


def _user_event_fields(df: DataFrame, column: str) -> DataFrame:
    text = F.col(column).cast("string")
    pieces = F.split(text, r"\s")
    flag = F.lower(F.get(pieces, F.lit(3)))
    return df.select(
        text.alias("__line"),
        F.get(pieces, F.lit(0)).try_cast("int").alias("userId"),
        F.get(pieces, F.lit(1)).alias("time"),
        F.get(pieces, F.lit(2)).alias("page"),
        F.when(flag == "true", True).when(flag == "false", False).alias("isLast"),
        F.try_to_timestamp(F.get(pieces, F.lit(1)), F.lit(USER_EVENT_TIME)).alias("eventTime"),
    )


_USER_EVENT_COLUMNS = ("userId", "time", "page", "isLast", "eventTime")


def _is_user_event() -> Column:
    ok = F.lit(True)
    for name in _USER_EVENT_COLUMNS:
        ok = ok & F.col(name).isNotNull()
    return ok


def decode_user_events(df: DataFrame, on_malformed: str = "fail", column: str = "value") -> DataFrame:
    """``userId time page isLast`` lines as columns, plus ``eventTime``, the instant ``time`` stands for.

    A malformed line stops the query, or is left out with ``on_malformed="quarantine"``; then
    ``malformed_user_events`` gives the lines left out.
    """
    fields = _user_event_fields(df, column)
    if on_malformed == "quarantine":
        fields = fields.where(_is_user_event())
    elif on_malformed == "fail":
        complaint = F.concat(F.lit("malformed user event: "), F.coalesce("__line", F.lit("NULL")))
        # A filter, so that lines are checked whichever columns are used later.
        checked = F.when(_is_user_event(), True).otherwise(F.raise_error(complaint).cast("boolean"))
        fields = fields.where(checked)
    else:
        raise ValueError(f"on_malformed must be 'fail' or 'quarantine', not {on_malformed!r}")
    return fields.select(*_USER_EVENT_COLUMNS)


def malformed_user_events(df: DataFrame, column: str = "value") -> DataFrame:
    """The lines that ``decode_user_events`` cannot read."""
    return _user_event_fields(df, column).where(~_is_user_event()).select(F.col("__line").alias("value"))


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add ``year``, ``month`` and ``day`` of a time column."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})
