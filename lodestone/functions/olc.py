"""Open Location Code as column expressions, from its public specification.

Full codes of ten or eleven digits decode to the centre of their cell.  Short codes with four digits before
the plus are recovered as the cell nearest to an anchor.  Anything else is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..domains import OLC_ALPHABET as A

#: 1/8000 of a degree is the height and width of a ten-digit cell.
CELL = 8000
FULL = rf"^[{A}]{{8}}\+[{A}]{{2,3}}\z"
SHORT = rf"^[{A}]{{4}}\+[{A}]{{2,3}}\z"


def normal(code: Column) -> Column:
    return F.upper(F.btrim(code, F.lit(" '\"")))


def kind(code: Column) -> Column:
    """``completo``, ``curto`` or null, of a normalised code."""
    return F.when(code.rlike(FULL), F.lit("completo")).when(code.rlike(SHORT), F.lit("curto"))


def _index(digits: Column, k: int) -> Column:
    return F.position(F.substring(digits, k + 1, 1), F.lit(A)) - 1


def _units(digits: Column, axis: int) -> Column:
    return reduce(lambda a, b: a + b, [_index(digits, 2 * k + axis).cast("long") * 20 ** (4 - k) for k in range(5)])


def cell(digits: Column) -> tuple[Column, Column, Column]:
    """South and west in cells, and whether the first digits are in range."""
    return _units(digits, 0), _units(digits, 1), (_index(digits, 0) <= 8) & (_index(digits, 1) <= 17)


def _centre(digits: Column) -> tuple[Column, Column]:
    south, west, ok = cell(digits)
    last = _index(digits, 10)
    eleven = F.length(digits) == 11
    lat = south / CELL - 90 + F.when(eleven, (F.floor(last / 4) + 0.5) / 40000).otherwise(0.5 / CELL)
    lon = west / CELL - 180 + F.when(eleven, (last % 4 + 0.5) / 32000).otherwise(0.5 / CELL)
    return F.when(ok, lat), F.when(ok, lon)


def _point(digits: Column) -> Column:
    """The centre as a struct; the digits are named once, so that the expression stays small."""

    def place(d: Column) -> Column:
        lat, lon = _centre(d)
        return F.struct(lat.alias("lat"), lon.alias("lon"))

    return F.get(F.transform(F.array(digits), place), F.lit(0))


def decode(code: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a normalised full code; null for any other."""
    point = _point(F.when(code.rlike(FULL), F.replace(code, F.lit("+"), F.lit(""))))
    return point["lat"], point["lon"]


def _prefix(lat: Column, lon: Column) -> Column:
    """The first four digits of the code of a point."""
    y = F.least(F.greatest(lat + 90, F.lit(0.0)), F.lit(180 - 1 / CELL))
    x = F.pmod(lon + 180, F.lit(360.0))

    def at(n: Column) -> Column:
        return F.substring(F.lit(A), n.cast("int") + 1, F.lit(1))

    return F.concat(at(F.floor(y / 20)), at(F.floor(x / 20)), at(F.floor(F.pmod(y, F.lit(20.0)))), at(F.floor(F.pmod(x, F.lit(20.0)))))


def _normal_lon(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def recover(code: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """The point of a normalised short code nearest to an anchor; null without one or for any other code."""
    ok = code.rlike(SHORT) & lat0.isNotNull() & lon0.isNotNull()
    lon0 = _normal_lon(lon0)
    point = _point(F.when(ok, F.concat(_prefix(lat0, lon0), F.replace(code, F.lit("+"), F.lit("")))))

    def near(p: Column) -> Column:
        lat, lon = p["lat"], p["lon"]
        lat = F.when((lat0 + 0.5 < lat) & (lat - 1 >= -90), lat - 1).when((lat0 - 0.5 > lat) & (lat + 1 <= 90), lat + 1).otherwise(lat)
        lon = F.when(lon0 + 0.5 < lon, lon - 1).when(lon0 - 0.5 > lon, lon + 1).otherwise(lon)
        return F.struct(lat.alias("lat"), _normal_lon(lon).alias("lon"))

    found = F.get(F.transform(F.array(point), near), F.lit(0))
    return found["lat"], found["lon"]
