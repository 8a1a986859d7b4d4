"""Free text of a listing to typed columns: dates, times, cost, contacts, category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from crowdlane.functions.clock import col

# English month names; the three-letter form is accepted too.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

FULL_DATE = r"([A-Za-z]+\s+\d{1,2},\s+\d{4})"
DAY_RANGE = r"^([A-Za-z]+\s+\d{1,2})\s*-\s*([A-Za-z]+\s+\d{1,2})"
DAY_ONLY = r"^([A-Za-z]+\s+\d{1,2})"
ONE_DATE = r"^([A-Za-z]+)\s+(\d{1,2})(?:,\s+(\d{4}))?$"
ONE_TIME = r"(?i)^(\d{1,2}):?(\d{2})?\s*(AM|PM)"
AMOUNT = r"\$?\s*(\d+(?:\.\d{2})?)"
EMAIL = r"(?U)[\w.-]+@[\w.-]+\.\w+"
CATEGORY = r'"crmCatSubcat":\s*"([^"]+)"'


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Apply ``fn`` to a value that it mentions several times, computing the value once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _extract(c: Column, pattern: str, group: int) -> Column:
    return blank_to_null(F.regexp_extract(c, pattern, group))


def _month_number(name: Column) -> Column:
    short = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), name)
    whole = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)
    return F.nullif(F.greatest(short, whole), F.lit(0))


def single_date(c: Column | str, year: Column | int) -> Column:
    """"Month D, YYYY" or "Month D" (taking ``year``), full or short month name; else NULL.

    29 February needs a written year: without one it is not accepted, even in a leap year.
    """
    default_year = (F.lit(year) if isinstance(year, int) else year).cast("string")

    def dated(p: Column) -> Column:
        day = F.lpad(p["day"], 2, "0")
        iso = F.concat(
            F.coalesce(p["year"], default_year), F.lit("-"), F.lpad(p["month"].cast("string"), 2, "0"), F.lit("-"), day
        )
        leap_day_without_year = p["year"].isNull() & (p["month"] == 2) & (day == "29")
        return F.when(F.coalesce(~leap_day_without_year, F.lit(True)), iso.try_cast("date"))

    def parts(s: Column) -> Column:
        return F.struct(
            _month_number(F.lower(F.regexp_extract(s, ONE_DATE, 1))).alias("month"),
            _extract(s, ONE_DATE, 2).alias("day"),
            _extract(s, ONE_DATE, 3).alias("year"),
        )

    return let(let(strip(c), parts), dated)


def parse_dates(c: Column | str, year: Column | int) -> Column:
    """Struct (start_date, end_date, is_multi_day) of a listing's date line.

    Tried in order: one or more full dates (first and last count), a range of two
    days without year, one day without year, the whole text.
    """
    s = col(c)

    def chosen(full: Column) -> Column:
        one_day = F.regexp_extract(s, DAY_ONLY, 1)
        return (
            F.when(F.size(full) > 0, F.array(F.get(full, F.lit(0)), F.get(full, F.size(full) - 1)))
            .when(s.rlike(DAY_RANGE), F.array(F.regexp_extract(s, DAY_RANGE, 1), F.regexp_extract(s, DAY_RANGE, 2)))
            .when(one_day != "", F.array(one_day, one_day))
            .otherwise(F.array(s, s))
        )

    def result(dates: Column) -> Column:
        start, end = F.get(dates, F.lit(0)), F.get(dates, F.lit(1))
        return F.struct(
            start.alias("start_date"),
            end.alias("end_date"),
            F.coalesce(start != end, F.lit(False)).alias("is_multi_day"),
        )

    texts = let(F.regexp_extract_all(s, F.lit(FULL_DATE), F.lit(1)), chosen)
    return let(F.transform(texts, lambda t: single_date(t, year)), result)


def single_time(c: Column) -> Column:
    """Seconds after midnight of a 12-hour clock time at the start of the text; else NULL."""

    def parts(s: Column) -> Column:
        return F.struct(
            _extract(s, ONE_TIME, 1).cast("int").alias("hour"),
            F.coalesce(_extract(s, ONE_TIME, 2).cast("int"), F.lit(0)).alias("minute"),
            (F.upper(F.regexp_extract(s, ONE_TIME, 3)) == "PM").alias("pm"),
        )

    def seconds(p: Column) -> Column:
        # 12 AM is hour 0, 12 PM stays 12
        hour = F.when(p["hour"] == 12, 0).otherwise(p["hour"]) + F.when(p["pm"], 12).otherwise(0)
        fits = F.when(p["pm"], p["hour"] <= 12).otherwise(p["hour"] < 24)
        return F.when(fits & (p["minute"] < 60), (hour * 3600 + p["minute"] * 60).cast("int"))

    return let(let(strip(c), parts), seconds)


def parse_time_range(c: Column | str) -> Column:
    """Struct (start_sec, end_sec); parts are split on "to" between blanks or on a dash."""
    parts = F.split(col(c), r"(?i)\s+to\s+|\s*-\s*")
    return F.struct(
        single_time(F.get(parts, F.lit(0))).alias("start_sec"),
        single_time(F.get(parts, F.lit(1))).alias("end_sec"),
    )


def parse_cost(c: Column | str) -> Column:
    """Struct (cost_min, cost_max, cost_description).

    The word "free" wins; otherwise the smallest and largest amount. A thousands
    comma splits a number, so "1,000" reads as 1 and 0.
    """
    s = strip(blank_to_null(col(c)))
    free = s.rlike(r"(?i)\bfree\b")
    found = F.transform(F.regexp_extract_all(s, F.lit(AMOUNT), F.lit(1)), lambda a: a.try_cast("double"))
    return let(
        F.when(free, F.array(F.lit(0.0))).otherwise(found),
        lambda amounts: F.struct(
            F.array_min(amounts).alias("cost_min"),
            F.array_max(amounts).alias("cost_max"),
            F.when(free, F.lit("Free")).otherwise(s).alias("cost_description"),
        ),
    )


def clean_phone(c: Column | str) -> Column:
    digits = F.regexp_replace(col(c), r"\D", "")
    return F.when(F.length(digits) >= 10, F.right(digits, F.lit(10))).otherwise(blank_to_null(strip(c)))


def clean_email(c: Column | str) -> Column:
    return F.coalesce(_extract(col(c), EMAIL, 0), blank_to_null(strip(c)))


def percent_decode(c: Column) -> Column:
    """Percent-decoding that keeps a plus sign; malformed escapes leave the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def extract_category(c: Column | str) -> Column:
    """Category named in a tracking attribute; NULL when there is none."""
    return percent_decode(_extract(col(c), CATEGORY, 1))
