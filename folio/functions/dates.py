"""Free date texts to timestamps, as Columns: a small grammar over tokens.

A text is cut into words and numbers after weekday names, ordinal endings and a time of day are taken off.  Its shape, one
letter a token, decides the order of the parts:

    m n y    January 5, 2020        n m y    5 January 2020, 5-Jan-20        y m n    2020 Jan 5
    y n n    2020-01-05, 2020/1/5   n n y    1/5/2020, 1-5-20, 5.1.2020      d        20200105

(m month name, n number of one or two digits, y of four, d of eight; a year of two digits may stand where y stands last).
``n n y`` is month first with slashes or hyphens and day first with dots; ``day_first=True`` makes it day first always.
Where the chosen order has no such month, the other order is taken: 13/1/2020 is 13 January.  Two-digit years are
1969 to 2068.  Anything else, and any date that does not exist, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folio.functions.util import col_of, let

# English month and weekday names; three letters and more, "sept" included by its first three.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
PIVOT = 69  # two-digit years from here on are of the last century

_WEEKDAY_RE = r"\b(?:" + "|".join(f"{d[:3]}(?:{d[3:]}|{d[3:-3]})?" for d in WEEKDAYS) + r")\b\.?,?"
_ORDINAL_RE = r"(?<=[0-9])(?:st|nd|rd|th)\b"
_TIME_RE = r"(?:\bat\s+|[t,]\s*|\s+|^)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.[0-9]+)?)?\s*([ap]\.?m\.?)?(?=\s|$|,)"


def _month(word: Column) -> Column:
    """Number of a month name, whole or shortened to three letters or more; NULL for other words."""
    out = F.lit(None).cast("int")
    for i, name in enumerate(MONTHS, 1):
        out = F.when((F.length(word) >= 3) & F.startswith(F.lit(name), word), i).otherwise(out)
    return F.when(word == "sept", 9).otherwise(out)


def _shape(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: (
        F.when(t.rlike("^[0-9]{1,2}$"), "n").when(t.rlike("^[0-9]{4}$"), "y").when(t.rlike("^[0-9]{8}$"), "d")
        .when(_month(t).isNotNull(), "m").otherwise("x"))), "")


def _year(token: Column) -> Column:
    n = token.cast("int")
    return F.when(F.length(token) == 4, n).when(n >= PIVOT, 1900 + n).otherwise(2000 + n)


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def _from_tokens(t: Column, dotted: Column, day_first: bool) -> Column:
    def tok(i: int) -> Column:
        return F.try_element_at(t, F.lit(i))

    def num(i: int) -> Column:
        return F.try_element_at(t, F.lit(i)).try_cast("int")

    def numbers(_) -> Column:
        first = F.lit(True) if day_first else dotted  # the day stands first
        swap = F.when(first, (num(2) > 12) & (num(1) <= 12)).otherwise((num(1) > 12) & (num(2) <= 12))
        day = F.when(first != swap, num(1)).otherwise(num(2))
        month = F.when(first != swap, num(2)).otherwise(num(1))
        return _date(_year(tok(3)), month, day)

    whole = tok(1)
    return let(_shape(t), lambda s: (
        F.when(s.isin("mny", "mnn"), _date(_year(tok(3)), _month(tok(1)), num(2)))
        .when(s.isin("nmy", "nmn"), _date(_year(tok(3)), _month(tok(2)), num(1)))
        .when(s == "ymn", _date(num(1), _month(tok(2)), num(3)))
        .when(s == "ynn", _date(num(1), num(2), num(3)))
        .when(s.isin("nny", "nnn"), numbers(s))
        .when(s == "d", _date(F.substr(whole, F.lit(1), F.lit(4)).try_cast("int"), F.substr(whole, F.lit(5), F.lit(2)).try_cast("int"),
                              F.substr(whole, F.lit(7), F.lit(2)).try_cast("int")))))


def parse_date(c, day_first: bool = False) -> Column:
    """Timestamp (without zone) of a free date text, NULL if it is none."""
    text = F.regexp_replace(F.regexp_replace(F.lower(col_of(c)), _WEEKDAY_RE, " "), _ORDINAL_RE, "")

    def run(x: Column) -> Column:
        h, m, s, half = (F.regexp_extract(x, _TIME_RE, i) for i in range(1, 5))
        hour = h.try_cast("int")
        hour = (F.when(half == "", hour).when((hour < 1) | (hour > 12), F.lit(None))
                .otherwise(hour % 12 + F.when(F.startswith(half, F.lit("p")), 12).otherwise(0)))
        clock = F.when(h == "", F.lit("00:00:00")).otherwise(F.concat_ws(
            ":", F.lpad(hour.cast("string"), 2, "0"), m, F.when(s == "", "00").otherwise(s)))
        rest = F.regexp_replace(x, _TIME_RE, " ")
        clean = ~F.regexp_replace(rest, r"[\s,./-]|[0-9]|[a-z]", "").rlike(".")  # nothing but tokens and separators
        tokens = F.regexp_extract_all(rest, F.lit("[0-9]+|[a-z]+"), 0)
        dotted = rest.rlike(r"^\s*[0-9]{1,2}\.\s*[0-9]{1,2}\.")
        day = let(tokens, lambda t: _from_tokens(t, dotted, day_first))
        known = clean & ((h == "") | (hour.isNotNull() & (hour < 24)))
        return F.when(known, F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), clock), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))
    return let(text, run)
