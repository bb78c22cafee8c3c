"""Cleansing expressions. Every helper takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c) -> Column:
    """A text as DOUBLE, null when it is not a plain number (Java's `1d`/`1f` do not count)."""
    c = _col(c).cast("string")
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def int_or_zero(c) -> Column:
    """Number truncated to INT; unreadable or missing gives 0."""
    return F.coalesce(number(c).try_cast("int"), F.lit(0))


def float_or_zero(c) -> Column:
    """Number as FLOAT; unreadable or missing gives 0."""
    return F.coalesce(number(c).try_cast("float"), F.lit(0).cast("float"))


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(~c.rlike(r"(?U)^\s*$"), c)


def fill_text(df: DataFrame) -> DataFrame:
    """Null text columns become the empty string."""
    return df.na.fill("")


def epoch(c) -> Column:
    """Epoch seconds from an ISO text (offset aware, date only allowed) or from an epoch number."""
    c = _col(c).cast("string")
    stamp = F.unix_timestamp(c.try_cast("timestamp"))
    return F.coalesce(F.when(c.rlike(NUMBER), c.try_cast("double").cast("long")), stamp)


def start_or_date(event_time) -> Column:
    """Epoch of a calendar boundary: its date-time, else its date, else an error."""
    event_time = _col(event_time)
    text = F.coalesce(event_time["dateTime"], event_time["date"])
    return F.when(text.isNull(), F.raise_error(F.lit("event time without dateTime and date")).cast("long")) \
        .otherwise(epoch(text))


def media_ext(url) -> Column:
    """`jpg` when the address names a jpeg anywhere, else `png`; a missing address stays null."""
    url = _col(url)
    return F.when(url.isNull(), None).when(F.lower(url).rlike(r"\.jpe?g"), "jpg").otherwise("png")


def cv_link(base: str, user_id, cv_id) -> Column:
    """Download link for one person; language and format stay as literal placeholders."""
    return F.concat(F.lit(base.rstrip("/") + "/"), _col(user_id).cast("string"), F.lit("/"),
                    _col(cv_id).cast("string"), F.lit("/{LANG}/{FORMAT}"))


def pick_locale(translations, locale: str = "no") -> Column:
    """The wanted translation out of a struct or map of translations, '' when there is none."""
    return F.coalesce(_col(translations)[locale], F.lit(""))


def join_field(items, field: str, sep: str = ";") -> Column:
    """One field of a list of structs as text; null for a missing or empty list."""
    items = _col(items)
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda x: x[field]), sep))


def join_tag_list(items, tag: str, locale: str = "no", sep: str = ";") -> Column:
    """`item.tag.locale` of each list element; missing parts count as '', a missing list as ''."""
    items = _col(items)
    parts = F.transform(items, lambda x: F.coalesce(x[tag][locale], F.lit("")))
    return F.coalesce(F.array_join(parts, sep), F.lit(""))


def common_name(c) -> Column:
    """`CN=Ann Bee,OU=x` gives `Ann Bee`; a text without `=` gives ''."""
    return F.split_part(F.split_part(_col(c), F.lit("="), F.lit(2)), F.lit(","), F.lit(1))


def clean_name(c) -> Column:
    return F.regexp_replace(_col(c), "[^A-Za-z0-9]+", "_")


def years_since(year, now_year: int) -> Column:
    """Years from a year given as text until `now_year`; 0 for a missing or `0` year."""
    year = _col(year).cast("string")
    return F.when(year.isNull() | (year == "0"), 0).otherwise(F.lit(now_year) - number(year).try_cast("int"))


def stable_guid(c) -> Column:
    return F.sha1(F.encode(_col(c), "utf-8"))


def location_units(location, word: str = "Enheter") -> Column:
    """Comma parts of a place text that contain `word`, each cut after its last dash."""
    parts = F.filter(F.split(F.coalesce(_col(location), F.lit("")), ","), lambda x: x.contains(word))
    return F.transform(parts, lambda x: F.element_at(F.split(x, "-"), -1))


def strip_modifier(c) -> Column:
    return F.regexp_replace(_col(c), "::skin-tone-.", "")


def pad_period(c) -> Column:
    """`YYYYW` and `YYYYWW` both as `YYYYWW`."""
    c = _col(c).cast("string")
    return F.concat(F.substring(c, 1, 4), F.lpad(F.substring(c, 5, 2), 2, "0"))


def closed_period(period, tab, iso_year: int, iso_week: int, weeks: int = 4) -> Column:
    """True for completed (`B`) periods that ended at least `weeks` weeks ago, 52 weeks to a year."""
    period = _col(period).cast("string")
    number_of = lambda start, size: F.substring(period, start, size).try_cast("int")
    index = number_of(1, 4) * 52 + number_of(5, 2)
    return F.coalesce((_col(tab) == "B") & (index <= iso_year * 52 + iso_week - weeks), F.lit(False))


def prefix_flag(c, prefix: str = "RT @") -> Column:
    return _col(c).startswith(prefix)


def reindex(df: DataFrame, columns: dict[str, T.DataType | str]) -> DataFrame:
    """Exactly these columns in this order; the ones the input lacks are null."""
    have = set(df.columns)
    return df.select([
        F.col(f"`{name}`") if name in have else F.lit(None).cast(kind).alias(name)
        for name, kind in columns.items()
    ])


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=columns)
