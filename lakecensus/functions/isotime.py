"""ISO-8601 timestamps in every form that the extractor's parser takes, as expressions.

The usual form (a calendar date, T or a blank, HH:MM[:SS[.fraction]] and an offset) is one match
and one cast. Everything else is tokenised: a date (calendar or ISO week, with or without hyphens),
one separator of any kind, a time of two-digit parts with or without colons and a fraction, and an
offset of the same build. Parts of a second beyond the sixth digit are cut off.

The parser's lenience is kept, as its results are what users have: between the time and its offset
one odd sign may stand, or anything at all behind a fraction of six digits or more; a third colon,
or nothing at all, may lead the fraction; minutes and seconds of an offset aren't held to 59, only
the whole to less than a day. Exceptions: none known within the years 1 to 9999; an offset that
moves a time out of these years gives that instant, where the extractor would fail to store it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the white space that the extractor's strip() takes away -----------------
WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
         "\u200a\u2028\u2029\u202f\u205f\u3000")
# --- end of fixed values ----------------------------------------------------------------

USUAL = r"^(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([+-](0\d|1[0-7]):[0-5]\d)?)?\z"
# a week's day after a hyphen is one only if no second digit follows (else a time begins there); of
# digits in a row behind a week the first is a day if their number is one or even
DATE = (r"(?>\d{4}-\d\d-\d\d|\d{8}|\d{4}-W\d\d-\d(?=\z|[^0-9])|\d{4}-W\d\d"
        r"|\d{4}W\d{3}(?=(?:\d(?:\d\d)*)?(?!\d))|\d{4}W\d\d)")
SIGN = r"(?s:.)"
TIME = r"(?:\d\d:\d\d:\d\d(?:[.,:]\d+)?|\d\d(?::?\d\d)?(?:[.,]\d+)?|\d{6}(?:[.,]\d+|\d\d+)?)"
FRACTION = r"(?:\d{1,5}|\d{6,}[^+-]*)"
BEFORE_OFFSET = (r"(?:(?:\d\d(?::\d\d){0,2}|(?:\d\d){2,3})[\x00-\x7f&&[^+-]]?"
                 rf"|(?:\d\d:\d\d:\d\d[.,:]|\d\d(?::?\d\d)?[.,]|\d{{6}}[.,]){FRACTION}"
                 r"|\d{6}(?:\d{2,5}|\d{6,}[^+-]*))")
UNDER_A_DAY = r"(?:[01]\d|2[0-2]|23(?!:?(?:[6-9]\d|59:?[6-9]\d)))"
ANY = rf"^(?!0000){DATE}(?:\z|{SIGN}(?:{TIME}|{BEFORE_OFFSET}[+-](?={UNDER_A_DAY}){TIME})\z)"


def strip(s: Column) -> Column:
    return F.btrim(s, F.lit(WHITE))


def _week_date(date: Column) -> Column:
    """YYYYWww or YYYYWwwD -> date; null where there is no such day."""
    fourth = F.concat(F.substring(date, 1, 4), F.lit("-01-04")).try_cast("date")  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    week, day = F.substring(date, 6, 2).cast("int"), F.substring(F.concat(date, F.lit("1")), 8, 1).cast("int")
    found = F.date_add(monday, (week - 1) * 7 + day - 1)
    thursday = F.date_add(monday, 52 * 7 + 3)
    real = day.between(1, 7) & (week.between(1, 52) | ((week == 53) & (F.year(thursday) == F.year(fourth))))
    return F.when(real & (F.year(found) < 10_000), found)


def _clock(time: Column) -> Column:
    """A time of any build -> HH:MM:SS.fraction, the fraction cut after six digits."""
    out = F.regexp_replace(
        time, r"(?s)^(\d\d:\d\d:\d\d|\d{6}|\d\d:?\d\d|\d\d)(?:(?:[.,:](?=\d)|(?=\d\d))(\d{1,6}))?.*$", "$1.$2")
    for build, full in ((r"^(\d\d)(\d\d)(\d\d)\.", "$1:$2:$3."), (r"^(\d\d):?(\d\d)\.", "$1:$2:00."), (r"^(\d\d)\.", "$1:00:00.")):
        out = F.regexp_replace(out, build, full)
    return F.concat(out, F.lit("0"))


def _tokenised(s: Column) -> Column:
    date = F.translate(F.regexp_extract(s, rf"^({DATE})", 1), "-", "")
    time = F.regexp_extract(s, rf"^{DATE}{SIGN}([^+-]*)", 1)
    offset = F.regexp_extract(s, rf"^{DATE}{SIGN}[^+-]*([+-].*)", 1)
    day = F.when(F.substring(date, 5, 1) == "W", _week_date(date).cast("string")).otherwise(
        F.regexp_replace(date, r"^(\d{4})(\d\d)(\d\d)$", "$1-$2-$3"))
    at = F.try_to_timestamp(F.concat(day, F.lit("T"), _clock(F.when(time == "", "00").otherwise(time))))
    # an offset below one second is none
    shift = F.regexp_replace(_clock(F.substr(offset, F.lit(2))), r"^00:00:00\..*$", "00:00:00.0")
    back = F.regexp_replace(
        F.concat(F.translate(F.substring(offset, 1, 1), "+-", "-+"), shift),
        r"^([+-])(\d\d):(\d\d):(\d\d\.\d+)$", "$1$2 hours $1$3 minutes $1$4 seconds")
    return F.when(offset == "", at).otherwise(at + back.try_cast("interval"))


def parse(s: Column) -> Column:
    """A text without white space around it -> timestamp; null where it is none. Times without an
    offset are of the session's time zone, which ``configure`` pins to UTC."""
    seconds = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})([+-]\d{2}:\d{2})?$", "$1:00$2")
    return F.when(s.rlike(USUAL), F.try_to_timestamp(seconds)).when(s.rlike(ANY), _tokenised(s))
