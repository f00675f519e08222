"""Date parsing, period codes and calendar arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reformat_iso(col: str | Column, pattern: str) -> Column:
    """Text in ``pattern`` to ISO text. Patterns longer than 11 letters carry a time."""
    col = F.col(col) if isinstance(col, str) else col
    if len(pattern) > 11:
        return F.date_format(F.try_to_timestamp(col, F.lit(pattern)), "yyyy-MM-dd HH:mm:ss")
    return F.date_format(F.to_date(F.try_to_timestamp(col, F.lit(pattern))), "yyyy-MM-dd")


def _safe_date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def date_by_length(col: Column) -> Column:
    """8 or 10 characters are ``yyyyMMdd`` (with an optional ``.0``), 6 are ``yyMMdd``."""
    text = F.trim(col)
    size = F.length(text)
    full = F.substring(text, 1, 8)
    short = F.concat(F.lit("20"), text)
    return F.when(size.isin(8, 10), F.try_to_date(full, "yyyyMMdd")).when(size == 6, F.try_to_date(short, "yyyyMMdd"))


def timestamp_minutes(col: Column) -> Column:
    """``yyyyMMddHHmm`` text to a timestamp without time zone."""
    return F.try_to_timestamp(F.trim(col), F.lit("yyyyMMddHHmm")).cast("timestamp_ntz")


def period_type(col: Column) -> Column:
    """Seven characters are a month, six a quarter, four a year, anything else unknown."""
    size = F.length(col)
    return F.when(size == 7, "M").when(size == 6, "Q").when(size == 4, "Y").otherwise("")


# English month abbreviations in calendar order.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def month_number(abbreviation: Column) -> Column:
    """1–12 for a three-letter English month in any case, null otherwise."""
    place = F.instr(F.lit("".join(MONTHS)), F.upper(F.trim(abbreviation))) - 1
    return F.when((place >= 0) & (place % 3 == 0), (place / 3 + 1).cast("int"))


def period_start(col: Column) -> Column:
    """First day of a period code.

    Understands ``Q12017``, ``2017Q1``, ``2017``, ``cy2010``, ``MAY2017``, ``Jan10``, ``Jan 2015``.
    """
    text = F.upper(F.regexp_replace(col, r"\s+", ""))

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def number(value: Column) -> Column:
        return value.try_cast("int")

    quarter_first, year_first = r"^Q([1-4])(\d{4})$", r"^(\d{4})Q([1-4])$"
    month_long, month_short, plain_year = r"^([A-Z]{3})(\d{4})$", r"^([A-Z]{3})(\d{2})$", r"^(?:CY)?(\d{4})$"
    one = F.lit(1)
    return (
        F.when(
            text.rlike(quarter_first),
            _safe_date(number(part(quarter_first, 2)), number(part(quarter_first, 1)) * 3 - 2, one),
        )
        .when(
            text.rlike(year_first),
            _safe_date(number(part(year_first, 1)), number(part(year_first, 2)) * 3 - 2, one),
        )
        .when(text.rlike(plain_year), _safe_date(number(part(plain_year, 1)), one, one))
        .when(
            text.rlike(month_long), _safe_date(number(part(month_long, 2)), month_number(part(month_long, 1)), one)
        )
        .when(
            text.rlike(month_short),
            _safe_date(number(part(month_short, 2)) + 2000, month_number(part(month_short, 1)), one),
        )
    )


def quarter_label(ts: Column) -> Column:
    """``Q3 1997``."""
    return F.concat(F.lit("Q"), F.quarter(ts).cast("string"), F.lit(" "), F.year(ts).cast("string"))


def quarter_start(ts: Column) -> Column:
    """First day of the quarter."""
    return F.trunc(ts.cast("date"), "quarter")


def mid_month(year: Column, month: Column) -> Column:
    """The 15th, the convention for monthly plant data."""
    return _safe_date(year.cast("int"), month.cast("int"), F.lit(15))


def boundaries_crossed(unit: str, start: Column, end: Column) -> Column:
    """Warehouse ``DATEDIFF``: how many unit borders lie between the two, not elapsed whole units."""
    unit = unit.lower()
    if unit == "day":
        return F.datediff(end.cast("date"), start.cast("date"))
    if unit == "week":
        return F.floor(F.datediff(end.cast("date"), start.cast("date")) / 7).cast("int")
    if unit == "hour":
        hours = F.unix_micros(F.date_trunc("hour", end).cast("timestamp")) - F.unix_micros(
            F.date_trunc("hour", start).cast("timestamp")
        )
        return F.floor(hours / F.lit(3_600_000_000)).cast("int")
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    if unit == "month":
        return months
    if unit == "quarter":
        return (F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)
    if unit == "year":
        return F.year(end) - F.year(start)
    raise ValueError(f"unknown unit {unit}")


def expected_observations(frequency: Column, start: Column, end: Column) -> Column:
    """Observations a series of this frequency should have between two dates."""
    code = F.upper(frequency)
    days = boundaries_crossed("day", start, end)
    half_years = F.floor((days + 1) / F.lit(365.0) * 2).cast("int")
    return (
        F.when(code == "ANNL", boundaries_crossed("year", start, end) + 1)
        .when(code == "MONT", boundaries_crossed("month", start, end) + 1)
        .when(code == "QUAR", boundaries_crossed("quarter", start, end) + 1)
        .when(code.isin("WFR", "WSU", "WTU", "WMO"), F.floor(days / 7).cast("int") + 1)
        .when(code == "SANN", half_years + 1)
        .otherwise(days + 1)
    )


def weekend_days(start: Column, end: Column) -> Column:
    """Saturdays and Sundays in ``[start, end)``, closed form.

    Counts of weekend days since a fixed Monday are subtracted, so no day sequence is generated.
    """

    def since_monday(day: Column) -> Column:
        n = F.datediff(day.cast("date"), F.lit("1900-01-01").cast("date"))
        return F.floor(n / 7) * 2 + F.greatest(F.pmod(n, F.lit(7)) - 5, F.lit(0))

    return (since_monday(end) - since_monday(start)).cast("int")


def work_days(start: Column, end: Column) -> Column:
    """Monday to Friday days in ``[start, end)``."""
    return (F.datediff(end.cast("date"), start.cast("date")) - weekend_days(start, end)).cast("int")


def shift_hours(ts: Column, hours: Column | int) -> Column:
    """Fixed-offset shift of a timestamp, used for local to UTC by a known offset."""
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def date_plus_minutes(day: Column, minutes: Column) -> Column:
    """Ping time = day + whole minutes."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor(minutes).cast("int"))


# Chinese digits, units and half-day words.
CHINESE_DIGITS = {"零": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
CHINESE_UNITS = {"十": 10, "百": 100, "千": 1000, "万": 10000}
AFTERNOON_WORDS = ("下午", "晚上")


def chinese_number(text: Column) -> Column:
    """Arabic or Chinese numeral text to an integer (``二十三`` → 23, ``十`` → 10); null when empty.

    A fold over the characters keeps (total, pending digit); a unit character multiplies what waits.
    """
    digits = F.create_map(*[F.lit(x) for pair in CHINESE_DIGITS.items() for x in pair])
    units = F.create_map(*[F.lit(x) for pair in CHINESE_UNITS.items() for x in pair])
    start = F.struct(F.lit(0).alias("total"), F.lit(-1).alias("digit"))

    def step(state: Column, ch: Column) -> Column:
        unit = F.try_element_at(units, ch)
        digit = F.try_element_at(digits, ch)
        waiting = F.when(state["digit"] >= 0, state["digit"]).otherwise(F.lit(1))
        return F.when(
            unit.isNotNull(),
            F.struct((state["total"] + waiting * unit).alias("total"), F.lit(-1).alias("digit")),
        ).otherwise(F.struct(state["total"].alias("total"), F.coalesce(digit, F.lit(0)).alias("digit")))

    folded = F.aggregate(
        F.split(text, ""), start, step, lambda s: s["total"] + F.greatest(s["digit"], F.lit(0))
    )
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int")).when(F.length(text) > 0, folded)


def chinese_timestamp(text: Column, default: Column) -> Column:
    """Chinese date phrase to a timestamp; parts that are not named come from ``default`` (date parts)
    or are zero (time parts). Afternoon words add twelve hours."""
    numeral = "0-9零一二两三四五六七八九十"

    def group(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1)

    year = F.coalesce(chinese_number(group(f"([{numeral}]+)年")), F.year(default))
    month = F.coalesce(chinese_number(group(f"([{numeral}]+)月")), F.month(default))
    day = F.coalesce(chinese_number(group(f"([{numeral}]+)[号日]")), F.dayofmonth(default))
    hour = F.coalesce(chinese_number(group(f"([{numeral}百]+)[点时:.]")), F.lit(0))
    minute = F.coalesce(chinese_number(group(f"[点时:.]([{numeral}百]+)分?")), F.lit(0))
    second = F.coalesce(chinese_number(group(f"([{numeral}百]+)秒")), F.lit(0))
    later = text.rlike("|".join(AFTERNOON_WORDS)) & (hour < 12)
    hour = F.when(later, hour + 12).otherwise(hour)
    stamp = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", year, month, day, hour, minute, second)
    return F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
