"""Date parsing and calendar functions.

``to_date_text`` follows the mention job: text -> DATE by cutting the date
part (never through a timestamp, so no session-zone shift), NULL instead of an
error for junk such as 'Unknown'.

``parse_post_date`` follows the feed parser: a fixed list of date formats, each
a full match, then a year-less 'Mon d' completed with the as-of year. The
formats have five layouts that exclude one another; the layout is chosen once,
one regular expression per layout names year, month and day, and the date is
built from them (an impossible date such as Feb 30 is NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONTH_NAMES


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_text(c) -> Column:
    """Text -> DATE, NULL when the text has no leading 'yyyy-m-d' date."""
    return _c(c).try_cast("date")


# Parts of the layouts, with the alternatives that each directive admits. A
# leap second never makes a date and year 0 does not exist.
_Y = r"((?!0000)[0-9]{4})"
_M = r"(1[0-2]|0[1-9]|[1-9])"
_D = r"(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
_TIME = r"(?:2[0-3]|[01][0-9]|[0-9]):(?:[0-5][0-9]|[0-9]):(?:[0-5][0-9]|[0-9])"
_SHORT = "(" + "|".join(m[:3] for m in MONTH_NAMES) + ")"
_NAME = "(" + "|".join(m[:3] + (f"(?:{m[3:]})?" if m[3:] else "") for m in MONTH_NAMES) + ")"

# The layouts of POST_DATE_FORMATS and of the year-less form. \z, not $: Java's
# $ would also accept a trailing line terminator.
ISO_LAYOUT = rf"(?i)^{_Y}-{_M}-{_D}(?:T{_TIME}(?:\.[0-9]{{1,6}})?Z|\s+{_TIME})?\z"
SLASH_LAYOUT = rf"^{_M}/{_D}/{_Y}\z"
MONTH_FIRST_LAYOUT = rf"(?i)^{_NAME}\s+{_D},\s+{_Y}\z"
DAY_FIRST_LAYOUT = rf"(?i)^{_D}\s+{_SHORT}\s+{_Y}\z"
YEARLESS_LAYOUT = rf"(?i)^{_SHORT}\s+{_D}\s*\z"


def _month_number(name: Column) -> Column:
    months = F.array(*[F.lit(m[:3]) for m in MONTH_NAMES])
    return F.array_position(months, F.lower(F.substring(name, 1, 3))).cast("string")


def parse_post_date(c, as_of_year: int | Column) -> Column:
    """Multi-format post date -> DATE (NULL for '', 'Unknown', NULL or no match).

    ``as_of_year`` completes the year-less form; the live tool used the
    clock's year, here it is a parameter so results are reproducible.
    """
    c = _c(c)
    year = as_of_year if isinstance(as_of_year, Column) else F.lit(int(as_of_year))

    def named(layout: str, month: int, rest: str) -> Column:
        """'Y-<month number>-D', month and rest read by one match each."""
        parts = F.split(F.regexp_replace(c, layout, rest), "-")
        return F.concat_ws("-", parts[0], _month_number(F.regexp_extract(c, layout, month)), parts[1])

    text = (F.when(c.rlike(ISO_LAYOUT), F.regexp_replace(c, ISO_LAYOUT, "$1-$2-$3"))
            .when(c.rlike(SLASH_LAYOUT), F.regexp_replace(c, SLASH_LAYOUT, "$3-$1-$2"))
            .when(c.rlike(MONTH_FIRST_LAYOUT), named(MONTH_FIRST_LAYOUT, 1, "$3-$2"))
            .when(c.rlike(DAY_FIRST_LAYOUT), named(DAY_FIRST_LAYOUT, 2, "$3-$1"))
            .when(c.rlike(YEARLESS_LAYOUT), F.concat_ws(
                "-", F.lpad(year.cast("string"), 4, "0"), _month_number(F.regexp_extract(c, YEARLESS_LAYOUT, 1)),
                F.regexp_extract(c, YEARLESS_LAYOUT, 2))))
    return F.replace(text, F.lit(" "), F.lit("")).try_cast("date")


def stop_flag(date_text, stop_date: str | None, as_of_year) -> Column:
    """Stop test of the feed: parsed date <= stop date; unparsable -> False."""
    if not stop_date:
        return F.lit(False)
    parsed = parse_post_date(date_text, as_of_year)
    return F.coalesce(parsed <= F.lit(stop_date).cast("date"), F.lit(False))


def weekday_monday0(c) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``)."""
    return F.weekday(_c(c))


def round_half_even_nonneg(c) -> Column:
    """``max(0, round(x))`` with Python's half-even rounding, as INT."""
    return F.greatest(F.lit(0), F.rint(_c(c))).cast("int")
