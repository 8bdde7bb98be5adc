"""Mission elapsed time as column expressions: canonical ``DD HH MM SS`` text and seconds.

Null and blank input give null; nothing here needs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Look-alikes of digits in timestamps; what stands after their digits is dropped.
LOOK_ALIKES, DIGITS, DROPPED = "OQIL][SB)(°", "00111158000", "':?./"
GROUPS = r"(\d{1,2})[\s:]+(\d{1,2})[\s:]+(\d{1,2})[\s:]+(\d{1,2})"
DAY = 86_400


def is_blank(c: Column) -> Column:
    """Null and the empty string are alike in every predicate."""
    return c.isNull() | (c == "")


def denoised(c: Column) -> Column:
    """Look-alikes become digits, separators other than blanks go, dashes are zeros."""
    return F.replace(F.replace(F.translate(F.upper(c), LOOK_ALIKES + DROPPED, DIGITS), F.lit("--"), F.lit("00")), F.lit("-"), F.lit("0"))


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def formatted(seconds: Column) -> Column:
    """Seconds to ``DD HH MM SS``; days are not bounded."""
    day, rest = F.floor(seconds / DAY), F.pmod(seconds, F.lit(DAY))
    return F.concat_ws(" ", *(_two(x.cast("bigint")) for x in (day, F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))))


def seconds_of(parts: list[Column]) -> Column:
    d, h, m, s = parts
    return d * DAY + h * 3600 + m * 60 + s


def parsed_seconds(c: Column) -> Column:
    """Seconds of a noisy timestamp, null where it can't be one.

    Four groups anywhere, else all digit runs of the text when there are three (seconds are zero) or
    four. Days 94 and 55 are misread 4 and 5, others above 10 keep their last digit.
    """
    clean = denoised(c)
    runs = F.regexp_extract_all(clean, F.lit(r"(\d+)"), F.lit(1))
    four = F.regexp_like(clean, F.lit(GROUPS))
    groups = F.array(*(F.regexp_extract(clean, GROUPS, i) for i in range(1, 5)))
    chosen = F.when(four, groups).when(F.size(runs) == 3, F.concat(runs, F.array(F.lit("00")))).when(F.size(runs) == 4, runs)
    part = [F.get(chosen, F.lit(i)).try_cast("bigint") for i in range(4)]
    day = F.when(part[0] == 94, 4).when(part[0] == 55, 5).when(part[0] > 10, part[0] % 10).otherwise(part[0])
    fits = (part[1] <= 23) & (part[2] <= 59) & (part[3] <= 59)
    return F.when(fits, seconds_of([day, *part[1:]])).cast("bigint")


def carried(c: Column) -> Column:
    """Parts over their range carry into the next; other than four numbers stay as they are."""
    parts = F.split(F.trim(c), r"\s+")
    n = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    whole = (F.size(parts) == 4) & n[0].isNotNull() & n[1].isNotNull() & n[2].isNotNull() & n[3].isNotNull()
    return F.when(whole, formatted(seconds_of(n))).otherwise(c)


def canonical_seconds(c: Column) -> Column:
    """Seconds of a clean ``DD HH MM SS``, null for anything else."""
    parts = F.split(F.trim(c), r"\s+")
    return F.when(F.size(parts) == 4, seconds_of([F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]))


def hour_snapped(now: Column, last: Column) -> Column:
    """The nearest time within ten minutes after ``last`` with its hour or one beside it; same day only."""
    hour = F.floor(F.pmod(last, F.lit(DAY)) / 3600).cast("bigint")
    base = now - F.pmod(now, F.lit(DAY)) + F.pmod(now, F.lit(3600))
    tries = F.transform(F.array(F.lit(0), F.lit(-1), F.lit(1)), lambda d: F.struct((base + (hour + d) * 3600 - last).alias("ahead"), (hour + d).alias("hour")))
    good = F.filter(tries, lambda x: (x["hour"] >= 0) & (x["hour"] <= 23) & (x["ahead"] > 0) & (x["ahead"] <= 600))
    return F.when(F.floor(now / DAY) == F.floor(last / DAY), last + F.array_min(F.transform(good, lambda x: x["ahead"])))


#: Digits and what is read for them in a time within a text.
EMBEDDED, EMBEDDED_FROM, EMBEDDED_TO = "[0-9OIilCSB]", "OoCcIilSsBb", "00001115588"


def embedded(c: Column) -> Column:
    """The first eight digits or look-alikes of a text as ``DD HH MM SS``; null if there are fewer."""
    digits = F.translate(F.array_join(F.slice(F.regexp_extract_all(c, F.lit(f"({EMBEDDED})"), F.lit(1)), 1, 8), ""), EMBEDDED_FROM, EMBEDDED_TO)
    return F.when(F.length(digits) == 8, F.concat_ws(" ", *(F.substring(digits, i, 2) for i in (1, 3, 5, 7))))
