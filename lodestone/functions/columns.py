"""Cleaning, coding and geometry as built-in column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import domains as D

_SPACES = "  "


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Trimmed; blank and empty become null."""
    return F.nullif(F.btrim(col(c), F.lit(_SPACES)), F.lit(""))


def date(c: Column | str) -> Column:
    """Dates written year-month-day; sentinels, compared as text, and all else become null."""
    t = F.btrim(col(c), F.lit(_SPACES))
    return F.when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}(?!\d)") & ~t.isin(*D.SENTINEL_DATES), t.try_cast("date"))


def number(c: Column | str, kind: str = "decimal(18,2)") -> Column:
    return F.btrim(col(c), F.lit(_SPACES)).try_cast(kind)


def flag(c: Column) -> Column:
    """Two-valued: null counts as false."""
    return F.coalesce(c, F.lit(False))


def label(c: Column, names: Mapping[str, str]) -> Column:
    """The label of a code, null for an unknown one: looked up in a literal map, whose code stays small."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c)


def state(c: Column | str) -> Column:
    up = F.upper(F.btrim(col(c), F.lit(_SPACES)))
    return F.when(up.isin(D.STATES), up).otherwise(label(up, D.STATE_CORRECTIONS))


def division_number(cnae: Column) -> Column:
    return F.substring(cnae, 1, 2).try_cast("int")


def section(cnae: Column, field: int) -> Column:
    """Letter (field 2) or name (field 3) of the section whose range holds the code's division."""
    names = {n: s[field] for s in D.CNAE_SECTIONS for n in range(s[0], s[1] + 1)}
    return F.get(F.array(*[F.lit(names.get(n)).cast("string") for n in range(max(names) + 1)]), division_number(cnae))


def area_band(area: Column) -> Column:
    out = None
    for _, top, name in D.AREA_BANDS:
        out = (F.when if out is None else out.when)(area < top, F.lit(name)) if top is not None else out.when(area.isNotNull(), F.lit(name))
    return out


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * D.EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


_FROM = "ÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
_TO = "AAAAAAEEEEIIIIOOOOOUUUUCNY"


def name_key(c: Column | str) -> Column:
    """Upper case without accents; apostrophe, backtick and hyphen become one space."""
    plain = F.translate(F.upper(col(c)), _FROM, _TO)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "['`-]", " "), " +", " "))


def per(top: Column, under: Column, factor: float = 1.0) -> Column:
    """``factor * top / under`` as a double; null where ``under`` is 0."""
    return F.try_divide(F.lit(factor) * top.cast("double"), under.cast("double"))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def format_number(x: float, digits: int = 0) -> str:
    """1.234,5 as in pt-BR."""
    return f"{x:,.{digits}f}".translate(str.maketrans(",.", ".,"))


def format_percent(x: float, digits: int = 1) -> str:
    return format_number(x, digits) + "%"


def format_bytes(n: float) -> str:
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024 or unit == "GB":
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    raise AssertionError
