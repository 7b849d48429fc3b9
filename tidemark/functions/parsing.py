"""Cells written for people as typed values. What can't be read is null, never zero or NaN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import let, whole

#: Texts that mean "no value".
BLANKS = ("", "-", "--", "\u2014", "\u2013", "n/a", "N/A", "NA", "null", "undefined")
#: Currencies that are written behind an amount (and behind its multiplier).
CURRENCIES = ("KWF", "KWD", "USD", "SAR", "AED", "EUR", "GBP", "QAR", "BHD", "OMR", "JOD", "EGP", "TRY", "JPY", "CHF", "CAD", "AUD", "INR")
#: Market codes of the feed.
MARKETS = {"P": "Premier Market", "M": "Main Market", "B": "Auction Market"}
MULTIPLIERS = {"K": 1e3, "M": 1e6, "B": 1e9}

MARKS = "[\u202a\u202b\u202c\u200e\u200f]"
PLAIN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _trimmed(x: Column) -> Column:
    return F.regexp_replace(x, "^[\\s\u00a0\ufeff]+|[\\s\u00a0\ufeff]+$", "")


def clean(raw: Column) -> Column:
    """Without invisible direction marks and outer space; null if nothing is left or it stands for nothing."""
    s = _trimmed(F.translate(F.regexp_replace(raw, MARKS, ""), "\u00a0", " "))
    return let(s, lambda x: F.when(~x.isin(*BLANKS) & ~F.lower(x).isin(*BLANKS), x))


def _multiplier(letter: Column) -> Column:
    return reduce(lambda x, kv: x.when(F.upper(letter) == kv[0], kv[1]), MULTIPLIERS.items(), F.when(F.lit(False), 1.0))


def to_number(raw: Column) -> Column:
    """Thousands separators, percent, currency, accounting negatives, K/M/B; else the first number in the noise."""

    def of_body(full: Column) -> Column:
        times = F.coalesce(_multiplier(F.regexp_extract(full, "(?i)([KMB])$", 1)), F.lit(1.0))
        return let(F.regexp_replace(full, "(?i)[KMB]$", ""), lambda body: F.when(~body.isin("", "-", "+"), F.when(body.rlike(PLAIN), body.try_cast("double") * times).otherwise(noisy(body, times))))

    def noisy(body: Column, times: Column) -> Column:
        found = F.regexp_extract(body, r"(-?[0-9][0-9.]*)", 1)
        own = _multiplier(F.regexp_extract(body, r"(?i)-?[0-9][0-9.]*([KMB])", 1))
        return let(found, lambda n: F.when(n.rlike(PLAIN), n.try_cast("double"))) * F.coalesce(own, times)

    def of_text(s: Column) -> Column:
        body = F.regexp_replace(F.translate(s, "\u2212", "-"), r"[()\s,%$]", "")
        value = let(F.regexp_replace(body, f"(?i)({'|'.join(CURRENCIES)})$", ""), of_body)
        return F.when(s.rlike(r"^\(.*\)$"), -value).otherwise(value)

    return let(clean(raw), of_text)


def to_integer(raw: Column) -> Column:
    return whole(to_number(raw))


def parse_float(raw: Column) -> Column:
    """The number that a text starts with, after separators and all white space went."""
    s = F.regexp_replace(F.regexp_replace(F.translate(raw, "\u2212", "-"), MARKS, ""), "[,\\s\u00a0]", "")
    return F.when(s != "N/A", F.nullif(F.regexp_extract(s, r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)", 1), F.lit("")).try_cast("double"))


def to_symbol(raw: Column) -> Column:
    """The leading token behind the last colon, upper-cased, letters, digits, dots and underscores only."""
    after = _trimmed(F.element_at(F.split(clean(raw), ":"), -1))
    token = F.regexp_extract(after, "^([^\\s\u2014\u2013-]*)", 1)
    return F.nullif(F.regexp_replace(F.upper(token), "[^A-Z0-9._]", ""), F.lit(""))


def to_side(raw: Column) -> Column:
    return let(F.upper(clean(raw)), lambda up: F.when(up.contains("BUY") | up.startswith("B") | up.contains("شراء"), "BUY").when(up.contains("SELL") | up.startswith("S") | up.contains("بيع"), "SELL").when(up.isNotNull(), "UNKNOWN"))


CLOCK = r"([0-9]{1,2}):([0-9]{1,2})(?::([0-9]{1,2}))?"


def to_time(raw: Column) -> Column:
    """The first clock time anywhere in the text as HH:MM:SS."""

    def parts(t: Column) -> Column:
        h, m, s = (F.regexp_extract(t, CLOCK, k) for k in (1, 2, 3))
        return F.when(t.rlike(CLOCK), F.array(h, m, F.when(s == "", "0").otherwise(s)))

    def join(x: Column) -> Column:
        ok = (x[0].try_cast("int") <= 23) & (x[1].try_cast("int") <= 59) & (x[2].try_cast("int") <= 59)
        return F.when(ok, F.concat_ws(":", *(F.lpad(x[k], 2, "0") for k in range(3))))

    return let(let(clean(raw), parts), join)


def to_date_dmy(raw: Column) -> Column:
    """DD-MM-YYYY, nothing else."""
    return F.when(raw.rlike("^[0-9]{2}-[0-9]{2}-[0-9]{4}$"), F.try_to_date(raw, "dd-MM-yyyy"))


def to_instant(raw: Column, day: Column) -> Column:
    """A full date and time (ISO or DD-MM-YYYY), or a clock time on ``day``; without an offset it is the exchange's. UTC, without zone."""
    t = F.nullif(F.trim(raw), F.lit(""))
    iso = F.regexp_replace(t, "^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})", "$3-$2-$1")
    full = iso.rlike("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}")
    offset = F.regexp_extract(iso, r"([+-][0-9]{2}):?[0-9]{2}$", 1)
    hours = F.when(iso.rlike("Z$"), 0).when(offset != "", offset.try_cast("int")).otherwise(3)
    bare = F.regexp_replace(iso, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    bare = F.when(iso.rlike("[0-9]:[0-9]"), bare).otherwise(iso)
    at = F.when(full, bare.try_cast("timestamp_ntz")).otherwise(F.concat_ws(" ", day.cast("string"), to_time(t)).try_cast("timestamp_ntz"))
    shift = F.when(full & iso.rlike("[0-9]:[0-9]"), hours).otherwise(3)
    return at - F.make_dt_interval(hours=shift)


def row_date(text: Column, unix: Column) -> Column:
    """A daily table's date: unix seconds, else text such as 1 Feb '26."""
    t = F.regexp_replace(text, "[\u202a\u202b\u202c\u200e\u200f\u00a0]", " ")
    pat = r"([0-9]{1,2})\s+([A-Za-z]{3})\s+'?([0-9]{2,4})"
    day, month, year = (F.regexp_extract(t, pat, k) for k in (1, 2, 3))
    long = F.when(year.try_cast("int") < 100, (year.try_cast("int") + 2000).cast("string")).otherwise(year)
    parsed = F.try_to_date(F.concat_ws(" ", day, month, long), "d MMM yyyy")
    seconds = unix.try_cast("double")
    return F.coalesce(F.when(seconds > 0, F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))), parsed)


def market_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in MARKETS.items() for x in kv])
    return F.coalesce(names[F.upper(F.trim(code))], code)


def pick(raw: Column, column: Column, *keys: str) -> Column:
    """The first of the raw JSON's keys that has a value, else the column."""
    return F.coalesce(*(F.nullif(F.get_json_object(raw, f"$.{k}"), F.lit("")) for k in keys), column)


def synthetic_id(*parts: Column) -> Column:
    """An id for an order without one, of the parts that tell it apart; null unless all are there."""
    text = F.concat_ws("|", *(p.cast("string") for p in parts))
    all_there = reduce(lambda a, b: a & b, (p.isNotNull() for p in parts))
    return F.when(all_there, F.concat(F.lit("SYN-"), F.substring(F.sha1(text), 1, 16)))


def split_symbol(raw: Column) -> tuple[Column, Column]:
    """"SYM - CODE" as its two parts."""
    parts = F.split(raw, r"\s+-\s+")
    return F.nullif(F.trim(parts[0]), F.lit("")), F.nullif(F.trim(F.get(parts, F.lit(1))), F.lit(""))


def resolve_columns(header: list[str], aliases: dict[str, tuple[str, ...]]) -> dict[str, int]:
    """Places of the wanted columns in a header: an exact alias first, then one that it starts with; else -1."""
    low = [(h or "").strip().lower() for h in header]
    out = {}
    for name, words in aliases.items():
        exact = [i for i, h in enumerate(low) if h in words]
        start = [i for i, h in enumerate(low) if any(h.startswith(w) for w in words)]
        out[name] = (exact or start or [-1])[0]
    return out


def looks_like_header(cells: Column, header: list[str], words: tuple[str, ...]) -> Column:
    """Whether a row repeats the header, or has nothing but header words in its filled cells."""
    low = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    filled = F.filter(low, lambda c: c != "")
    return (low == F.array(*(F.lit(h.strip().lower()) for h in header))) | ((F.size(filled) > 0) & F.forall(filled, lambda c: c.isin(*words)))


def daily_columns(headers: list[str]) -> dict[str, int]:
    """Places of a daily table's columns, counted behind the date column; -1 if absent."""
    low = [(h or "").lower().strip() for h in headers]
    tests = {
        "open": lambda h: h == "open",
        "high": lambda h: h == "high",
        "low": lambda h: h == "low",
        "close": lambda h: h in ("close", "price"),
        "change": lambda h: "change" in h or "chg" in h or h == "%",
        "volume": lambda h: h in ("volume", "vol"),
    }
    return {k: next((i - 1 for i, h in enumerate(low) if i and test(h)), -1) if low else -1 for k, test in tests.items()}
