"""Date helpers: weekend flag, week index, business-day counts, time frames.

All closed-form column expressions: no calendar table, no join, no window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import ColumnOrName, as_col

# National holidays listed by the reference (2024 only).
BR_HOLIDAYS_2024 = [
    dt.date(2024, 1, 1), dt.date(2024, 2, 12), dt.date(2024, 2, 13),
    dt.date(2024, 4, 19), dt.date(2024, 4, 21), dt.date(2024, 5, 1),
    dt.date(2024, 6, 20), dt.date(2024, 9, 7), dt.date(2024, 10, 12),
    dt.date(2024, 11, 2), dt.date(2024, 11, 15), dt.date(2024, 12, 25),
]



def easter_sunday(year: int) -> dt.date:
    """Gregorian Easter (anonymous Gregorian computus)."""
    a, b, c = year % 19, year // 100, year % 100
    d, e = b // 4, b % 4
    g = (8 * b + 13) // 25
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = (a + 11 * h + 22 * l_) // 451
    month = (h + l_ - 7 * m + 114) // 31
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return dt.date(year, month, day)


# Fixed-date national holidays (month, day) and the Easter
# offsets of the moveable ones (Carnival Monday/Tuesday, Good Friday,
# Corpus Christi).
FIXED_DATE_HOLIDAYS = [(1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)]
EASTER_OFFSETS = [-48, -47, -2, 60]


def national_holidays(years: Iterable[int]) -> list[dt.date]:
    """Holiday calendar generated by rule for the given years."""
    out: set[dt.date] = set()
    for y in years:
        out.update(dt.date(y, m, d) for m, d in FIXED_DATE_HOLIDAYS)
        easter = easter_sunday(y)
        out.update(easter + dt.timedelta(days=k) for k in EASTER_OFFSETS)
    return sorted(out)


def _whole(a: Column, b: int) -> Column:
    """a // b of a non-negative whole number."""
    return ((a - a % b) / b).cast("int")


def easter_date(year: ColumnOrName) -> Column:
    """Gregorian Easter Sunday of a year, by arithmetic on the year alone (any year from 1583 on).

    The Sunday after the full moon of the church calendar, which is at most 28 days after 21 March.
    """
    y = as_col(year).cast("int")
    golden, century = y % 19, _whole(y, 100)
    moon = (golden * 19 + century - _whole(century, 4) - _whole(century * 8 + 13, 25) + 15) % 30
    moon = moon - _whole(moon + _whole(golden, 11), 29)
    return F.next_day(F.date_add(F.make_date(y, F.lit(3), F.lit(21)), moon), "Sunday")


def _on_21_april(easter: Column) -> Column:
    """Whether Good Friday is 21 April, itself a holiday: that day counts once."""
    return (F.month(easter) == 4) & (F.dayofmonth(easter) == 23)


def holidays_before(d: ColumnOrName) -> Column:
    """National holidays on weekdays in the year of ``d``, before ``d``, by rule. The moveable ones are always on weekdays."""
    c = as_col(d)
    year = F.year(c)
    easter = easter_date(year)
    after = F.datediff(c, easter)
    count = F.lit(0)
    for month, day in FIXED_DATE_HOLIDAYS:
        holiday = F.make_date(year, F.lit(month), F.lit(day))
        count = count + ((holiday < c) & (F.weekday(holiday) < 5)).cast("int")
    for offset in EASTER_OFFSETS:
        count = count + (after > offset).cast("int")
    return count - ((after > -2) & _on_21_april(easter)).cast("int")


def _fixed_before(year: Column) -> Column:
    """Fixed-date holidays on weekdays in all years before ``year``. Weekdays repeat every 400 years, so 400 sums say it for any year."""
    sums = [0]
    for y in range(2000, 2400):  # any 400 years that begin with a multiple of 400
        sums.append(sums[-1] + sum(dt.date(y, m, k).weekday() < 5 for m, k in FIXED_DATE_HOLIDAYS))
    table = F.array(*[F.lit(n) for n in sums[:400]])
    return _whole(year, 400) * sums[400] + F.get(table, year % 400)


def holidays_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """National holidays on weekdays in [start, end), by rule; 0 if end <= start.

    Closed form but for the years between the two, which are looked at for a Good Friday on 21 April.
    """
    s, e = as_col(start), as_col(end)
    first, last = F.year(s), F.year(e)
    years = F.when(last > first, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>"))
    once = F.size(F.filter(years, lambda y: _on_21_april(easter_date(y))))
    whole = (last - first) * len(EASTER_OFFSETS) + _fixed_before(last) - _fixed_before(first) - once
    return F.when(e > s, holidays_before(e) - holidays_before(s) + whole).otherwise(F.when(e.isNotNull() & s.isNotNull(), F.lit(0))).cast("bigint")


def is_national_holiday(d: ColumnOrName) -> Column:
    """Whether a day is a national holiday, by rule."""
    c = as_col(d)
    easter = easter_date(F.year(c))
    fixed = F.concat_ws("-", F.month(c), F.dayofmonth(c)).isin([f"{m}-{k}" for m, k in FIXED_DATE_HOLIDAYS])
    return fixed | F.datediff(c, easter).isin(EASTER_OFFSETS)


# A holiday list becomes an array literal; bound its size.
MAX_HOLIDAYS = 20_000


def is_weekend(d: ColumnOrName) -> Column:
    """Saturday or Sunday (dayofweek 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(as_col(d)).isin(1, 7)


def week_index(d: ColumnOrName) -> Column:
    """Sunday-started week number since 1970 (1970-01-04 opens week 1)."""
    return F.floor((F.unix_date(as_col(d)) + F.lit(4)) / F.lit(7)).cast("bigint")


def business_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """The reference's weekday approximation, kept as is.

    days - 2 * week boundaries crossed - [start is Sunday] - [end is Saturday].
    Exact for a weekday end; can be one low otherwise (Sat->Sun gives -1).
    """
    s, e = as_col(start), as_col(end)
    return (
        F.datediff(e, s).cast("bigint")
        - F.lit(2) * (week_index(e) - week_index(s))
        - F.when(F.dayofweek(s) == 1, 1).otherwise(0)
        - F.when(F.dayofweek(e) == 7, 1).otherwise(0)
    ).cast("bigint")


def weekdays_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Exact count of Monday..Friday days in [start, end); 0 if end <= start."""
    s, e = as_col(start), as_col(end)
    n = F.greatest(F.datediff(e, s), F.lit(0))
    full, rem = F.floor(n / 7), n % 7
    d0 = F.weekday(s)  # 0 = Monday .. 6 = Sunday
    head = F.greatest(F.lit(0), F.least(rem, F.lit(5) - d0))
    tail = F.greatest(F.lit(0), rem - (F.lit(7) - d0))
    return (full * 5 + head + tail).cast("bigint")


def _checked(holidays: Iterable[dt.date]) -> list[dt.date]:
    days = sorted(set(holidays))
    if len(days) > MAX_HOLIDAYS:
        raise ValueError(f"holiday list too long ({len(days)} > {MAX_HOLIDAYS})")
    return days


def _holiday_array(holidays: Iterable[dt.date]) -> Column:
    days = _checked(holidays)
    if not days:
        return F.array().cast("array<date>")
    return F.array(*[F.lit(d) for d in days])


def business_days_exact(
    start: ColumnOrName, end: ColumnOrName, holidays: Iterable[dt.date] | None = BR_HOLIDAYS_2024
) -> Column:
    """Weekdays in [start, end) that are not holidays (per-row expression).

    ``holidays=None`` takes the national holidays by rule: no list, and no years outside of which
    nothing is known. Lists are fine while short; for long ones and large tables
    prefer ``with_business_days`` (calendar table + broadcast hash join).
    """
    s, e = as_col(start), as_col(end)
    if holidays is None:
        return (weekdays_between(s, e) - holidays_between(s, e)).cast("bigint")
    days = _checked(holidays)
    on_weekday_in_range = F.filter(
        _holiday_array(days), lambda h: (h >= s) & (h < e) & (F.weekday(h) < 5)
    )
    count = (weekdays_between(s, e) - F.size(on_weekday_in_range)).cast("bigint")
    return F.when(_covered(s, days) & _covered(e, days), count)


def _years(days: list[dt.date]) -> tuple[dt.date, dt.date] | None:
    """First day covered by a holiday list and the first one after it (whole years)."""
    return (dt.date(days[0].year, 1, 1), dt.date(days[-1].year + 1, 1, 1)) if days else None


def _covered(d: Column, days: list[dt.date]) -> Column:
    """Whether the list knows the holidays up to ``d``; without holidays every day is known."""
    span = _years(days)
    return F.lit(True) if span is None else (d >= F.lit(span[0])) & (d <= F.lit(span[1]))


def is_business_day(d: ColumnOrName, holidays: Iterable[dt.date] | None = BR_HOLIDAYS_2024) -> Column:
    """Weekday that is no holiday; NULL outside the years of the list. ``holidays=None``: by rule, any year.

    Fine for short lists; ``with_business_days`` has the same flag from its calendar join.
    """
    c = as_col(d)
    if holidays is None:
        return (F.weekday(c) < 5) & ~is_national_holiday(c)
    days = _checked(holidays)
    span = _years(days)
    known = F.lit(True) if span is None else (c >= F.lit(span[0])) & (c < F.lit(span[1]))
    return F.when(known, (F.weekday(c) < 5) & ~F.array_contains(_holiday_array(days), c))


# The calendar covers whole years; bound it so the broadcast side is small.
MAX_CALENDAR_YEARS = 400


def holiday_calendar(spark: SparkSession, holidays: Iterable[dt.date]) -> tuple[DataFrame, dt.date, dt.date]:
    """One row per day over the holiday years: (cal_date, holidays_before, is_holiday).

    ``holidays_before`` counts weekday holidays strictly before the day. The
    table has at most MAX_CALENDAR_YEARS * 366 + 1 rows, checked here, so
    broadcasting it is safe. Returns (calendar, first day, last day).
    """
    days = _checked(holidays)
    weekday_days = [h for h in days if h.weekday() < 5]
    first, last = _years(days) or (dt.date(2000, 1, 1), dt.date(2001, 1, 1))  # no holidays: count 0 everywhere
    if last.year - first.year > MAX_CALENDAR_YEARS:
        raise ValueError(f"holiday calendar spans more than {MAX_CALENDAR_YEARS} years")
    n = (last - first).days + 1
    arr = F.array(*[F.lit(h) for h in weekday_days]) if weekday_days else F.array().cast("array<date>")
    cal = spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("cal_date"))
    cal = cal.select("cal_date", F.size(F.filter(arr, lambda h: h < F.col("cal_date"))).cast("bigint")
                     .alias("holidays_before"), F.array_contains(arr, F.col("cal_date")).alias("is_holiday"))
    return cal, first, last


def with_business_days(df: DataFrame, start: str, end: str, holidays: Iterable[dt.date],
                       out: str = "business_days", start_flag: str | None = None) -> DataFrame:
    """Add exact business days in [start, end) via a calendar join, and, as
    ``start_flag``, whether the start is a business day.

    Outside the years of the holiday list nothing is known: the result is
    NULL. Start and end are looked up with two equi-joins against the size-checked, broadcast calendar: per row this is two hash
    probes and closed-form weekday arithmetic, all in generated code.
    """
    holidays = _checked(holidays)
    cal, first, last = holiday_calendar(df.sparkSession, holidays)
    cal = F.broadcast(cal)
    lo, hi = F.lit(first), F.lit(last)

    def clamp(c: str) -> Column:  # without holidays any day of the calendar stands for all
        return F.col(c) if holidays else F.least(F.greatest(F.col(c), lo), hi)

    cs = cal.select(F.col("cal_date").alias("_cs_date"), F.col("holidays_before").alias("_cs_n"), F.col("is_holiday").alias("_cs_off"))
    ce = cal.select(F.col("cal_date").alias("_ce_date"), F.col("holidays_before").alias("_ce_n"))
    joined = (df.join(cs, clamp(start) == F.col("_cs_date"), "left")
              .join(ce, clamp(end) == F.col("_ce_date"), "left"))
    known = F.col("_cs_n").isNotNull() & F.col("_ce_n").isNotNull()
    in_range = F.when(F.col(end) > F.col(start), F.col("_ce_n") - F.col("_cs_n")).otherwise(F.lit(0))
    result = F.when(known, (weekdays_between(start, end) - in_range).cast("bigint"))
    joined = joined.withColumn(out, result)
    if start_flag:
        of_year = F.col(start) < hi if holidays else F.lit(True)  # the calendar's last day opens an unknown year
        joined = joined.withColumn(start_flag, F.when(F.col("_cs_n").isNotNull() & of_year, (F.weekday(start) < 5) & ~F.col("_cs_off")))
    return joined.drop("_cs_date", "_cs_n", "_cs_off", "_ce_date", "_ce_n")


TIME_FRAMES = ("date", "week", "month", "quarter", "year")


def time_frame(d: ColumnOrName, frame: str) -> Column:
    """Truncate a DATE to a time frame (weeks start on Monday)."""
    c = as_col(d)
    if frame == "date":
        return c.cast("date")
    if frame not in TIME_FRAMES:
        raise ValueError(f"unknown time frame {frame!r}")
    return F.date_trunc(frame, c).cast("date")
