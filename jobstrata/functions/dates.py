"""Date and time rules. Whatever depends on today takes ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstrata import vocab

AsOf = Column | str | dt.date | dt.datetime | None


def as_date(as_of: AsOf) -> Column:
    """The reference day: given, or the current date."""
    if as_of is None:
        return F.current_date()
    return as_of.cast("date") if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def as_timestamp(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of.cast("timestamp") if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def not_older(df: DataFrame, column: str, as_of: AsOf, days: int) -> Column:
    """Rows dated at most ``days`` days before ``as_of``.

    The bound takes the type of the column (date, timestamp or ISO text), so the comparison
    needs no cast of stored values and reaches the scan.
    """
    return F.col(column) >= F.date_sub(as_date(as_of), days).cast(df.schema[column].dataType)


def not_before(df: DataFrame, column: str, as_of: AsOf, interval: str) -> Column:
    """Rows no older than an interval such as ``6 HOURS`` before ``as_of``."""
    bound = as_timestamp(as_of) - F.expr(f"INTERVAL {interval}")
    return F.col(column) >= bound.cast(df.schema[column].dataType)


def parse_timestamp(c: Column) -> Column:
    """ISO text to timestamp; what cannot be read becomes NULL."""
    return F.try_to_timestamp(c)


def path_extract_date(path: Column, name: Column) -> Column:
    """Day of extraction: a dated folder, a dated file name, or a compact date in the name."""
    folder = F.regexp_extract(path, r".*/([0-9]{4}-[0-9]{2}-[0-9]{2})/.*", 1)
    dashed = F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    compact = F.regexp_extract(name, r"(?:^|[^0-9])([0-9]{8})(?:[^0-9]|$)", 1)
    spread = F.regexp_replace(compact, r"^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    blank = F.lit("")
    return F.coalesce(F.nullif(folder, blank), F.nullif(dashed, blank), F.nullif(spread, blank))


def is_recent(ts: Column, as_of: AsOf = None, days: int = vocab.RECENT_DAYS, allow_future: bool = True) -> Column:
    """Posted at most ``days`` days before ``as_of``; NULL stays NULL."""
    age = F.datediff(as_date(as_of), F.to_date(ts))
    return age <= days if allow_future else age.between(0, days)


def is_recent_listing(ts: Column, as_of: AsOf = None) -> Column:
    """Fewer than seven full days old; unreadable times count as just seen."""
    age = F.floor((as_timestamp(as_of).cast("double") - ts.cast("timestamp").cast("double")) / 86400)
    return F.coalesce(age < vocab.LISTING_RECENT_DAYS, F.lit(False))


def relative_date(text: Column, as_of: AsOf = None) -> Column:
    """'3 days ago', 'há 2 semanas', '5 hours ago' to a date; anything else is ``as_of``.

    The count is all digits of the text, one if there are none or it is zero. A date
    before the first year cannot be computed and falls back to ``as_of`` as well.
    """
    today = as_date(as_of)
    lowered = F.lower(text)
    digits = F.regexp_replace(lowered, "[^0-9]", "")
    number = digits.try_cast("bigint")
    count = F.when((digits == "") | (number == 0), F.lit(1)).otherwise(number)
    has = lambda *words: F.coalesce(
        F.contains(lowered, F.lit(words[0])) | F.contains(lowered, F.lit(words[1])), F.lit(False)
    )
    days_back = count.try_cast("int")
    weeks_back = F.try_multiply(count, F.lit(7).cast("bigint")).try_cast("int")
    back = (
        F.when(has("hour", "hora"), F.lit(0))
        .when(has("day", "dia"), days_back)
        .when(has("week", "semana"), weeks_back)
        .otherwise(F.lit(0))
    )
    found = F.date_sub(today, back)
    return F.when(found >= F.lit("0001-01-01").cast("date"), found).otherwise(today)


def effective_time(posted: Column, ingested: Column) -> Column:
    return F.coalesce(posted, ingested)
