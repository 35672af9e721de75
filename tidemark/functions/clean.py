"""Cleaning rules as column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONGITUDE_BOUNDS = (-180.0, 180.0)
LATITUDE_BOUNDS = (-90.0, 90.0)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_null(*cols: Column | str) -> Column:
    """The first value that is not null; an empty string counts as a value."""
    return F.coalesce(*[_col(c) for c in cols])


def fill_default(c: Column | str, default) -> Column:
    """``default`` where the value is null; an empty string is left alone."""
    return F.coalesce(_col(c), F.lit(default))


def clean_phone(c: Column | str) -> Column:
    """Digits of a phone number without the ``+`` and the ``1`` it may start with.

    Null stays null; text without any digit becomes an empty string. Only one
    leading ``+`` and one leading ``1`` go, so an inner ``+`` survives.
    """
    kept = F.regexp_replace(_col(c), "[^0-9+]+", "")
    return F.regexp_replace(kept, r"^\+?1?", "")


def clean_url(c: Column | str) -> Column:
    r"""A URL with every escaped slash (``\/``) turned back into a slash."""
    return F.replace(_col(c), F.lit("\\/"), F.lit("/"))


def full_address(
    address_1: Column | str,
    address_2: Column | str,
    address_3: Column | str,
    city: Column | str,
    state: Column | str,
    postal_code: Column | str,
    country: Column | str,
    skip_nulls: bool = False,
) -> Column:
    """``a1[, a2][, a3], city, state postal, country`` in one line.

    The second and third address lines are optional. If any other part is null
    the whole address is null, unless ``skip_nulls`` asks for the parts there
    are.
    """
    a1, a2, a3, city, state, postal, country = map(
        _col, (address_1, address_2, address_3, city, state, postal_code, country)
    )
    if skip_nulls:
        region = F.nullif(F.concat_ws(" ", state, postal), F.lit(""))
        return F.nullif(F.concat_ws(", ", a1, a2, a3, city, region, country), F.lit(""))
    street = F.concat_ws(", ", a1, a2, a3)
    region = F.concat(state, F.lit(" "), postal)
    # concat_ws never yields null, so the mandatory first line is tested apart.
    return F.when(
        a1.isNotNull(),
        F.concat(street, F.lit(", "), city, F.lit(", "), region, F.lit(", "), country),
    )


def valid_coord(c: Column | str, low: float, high: float) -> Column:
    """The coordinate as a double when within the bounds (inclusive), else null.

    The value is cast before it is compared, so quoted numbers are judged as
    numbers and text that is no number becomes null instead of failing the job.
    NaN is out of range.
    """
    x = _col(c).try_cast("double")
    return F.when(x.between(F.lit(low), F.lit(high)), x)


def valid_longitude(c: Column | str) -> Column:
    return valid_coord(c, *LONGITUDE_BOUNDS)


def valid_latitude(c: Column | str) -> Column:
    return valid_coord(c, *LATITUDE_BOUNDS)


def date_of(c: Column | str) -> Column:
    """The calendar date of a time stamp or of its ISO text; null if unreadable."""
    return _col(c).try_cast("date")
