"""Presentation of values as text columns. A null is a dash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import Col, col

DASH = "—"


def dashed(c: Col, text: Column) -> Column:
    return F.when(col(c).isNull(), DASH).otherwise(text)


def whole(c: Col) -> Column:
    return dashed(c, F.format_number(col(c), 0))


def delta(c: Col) -> Column:
    return dashed(c, F.concat(F.when(col(c) > 0, "+").otherwise(""), F.format_number(col(c), 0)))


def size(c: Col) -> Column:
    """Bytes, or KB, MB and GB with one decimal below a hundred."""
    n = col(c).cast("double")

    def scaled(power: int, unit: str) -> Column:
        v = n / F.lit(1024.0**power)
        return F.concat(F.when(v >= 100, F.format_string("%.0f", v)).otherwise(F.format_string("%.1f", v)), F.lit(f" {unit}"))

    return dashed(c, F.when(n < 1024, F.concat(col(c).cast("string"), F.lit(" B"))).when(n < 1024**2, scaled(1, "KB")).when(n < 1024**3, scaled(2, "MB")).otherwise(scaled(3, "GB")))


def dollars(c: Col) -> Column:
    v = F.round(col(c), 0)
    return dashed(c, F.concat(F.when(v < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(v), 0)))


def day(c: Col) -> Column:
    """The UTC day of an ISO text; a text that is none stays as it is."""
    c = col(c)
    return F.when(c.isNull() | (c == ""), DASH).otherwise(F.coalesce(F.date_format(F.to_utc_timestamp(c.try_cast("timestamp"), "UTC"), "yyyy-MM-dd"), c))


def moment(c: Col) -> Column:
    c = col(c)
    return F.when(c.isNull() | (c == ""), DASH).otherwise(F.coalesce(F.date_format(c.try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss'Z'"), c))


def days_open(c: Col) -> Column:
    d = col(c)
    years = F.format_string("%.1f", d.cast("double") / F.lit(365.25))
    return dashed(c, F.when(d < 365, F.concat(d.cast("string"), F.lit(" d"))).otherwise(F.concat(years, F.lit(" y ("), F.format_number(d, 0), F.lit(" d)"))))


def short_id(c: Col, ends: int = 10) -> Column:
    t = col(c)
    return F.when(t.isNull() | (t == ""), DASH).when(F.length(t) <= 2 * ends + 1, t).otherwise(F.concat(F.left(t, F.lit(ends)), F.lit("…"), F.right(t, F.lit(ends))))


def percent(c: Col) -> Column:
    v = col(c).cast("double")
    return F.concat(F.when((v >= 10) | (v == 0), F.format_string("%.0f", v)).otherwise(F.format_string("%.1f", v)), F.lit("%"))
