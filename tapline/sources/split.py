"""Equi-depth splits of a database query: partitions of like size whatever the key's distribution.

The database numbers the rows in key order and returns every ``step``-th key, a few for each partition asked for. Keys
between two such points hold about ``step`` rows, so ranges of as many points are about equally deep. A key that
fills several points in a row is *hot*: it is read by equality, and split further by a numeric expression of the
row (``spread_by``) if it holds more than one share. Null keys are read the same way. The conditions exclude each
other and together cover every row.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from ..errors import SourceError

#: Points asked for a partition; a key with half as many is hot.
POINTS = 8
#: Databases whose window functions know no order: the rows are numbered in the order of a subquery.
UNORDERED_WINDOWS = frozenset({"derby"})


@dataclass(frozen=True)
class Histogram:
    """Sorted keys, one for each ``step`` rows, and how many rows have a key and how many have none."""

    points: Sequence
    step: int
    filled: int
    nulls: int


def literal(value) -> str:
    """A key as SQL text; dates and times in JDBC's own escapes, which drivers turn into their database's form."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return "{ts '" + value.isoformat(sep=" ") + "'}"
    if isinstance(value, datetime.date):
        return "{d '" + value.isoformat() + "'}"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise SourceError(f"A key of type {type(value).__name__} cannot split a query.")


def histogram(rows_of: Callable[[str], list], text: str, column: str, partitions: int, database: str = "") -> Histogram:
    """Ask the database for the key's histogram; ``rows_of`` runs a query there. A few rows for each partition."""
    (filled, everything), = rows_of(f"SELECT COUNT({column}) AS filled, COUNT(*) AS everything FROM ({text}) tapline_n")
    filled, everything = int(filled), int(everything)
    step = max(1, -(-filled // (POINTS * partitions)))
    if database in UNORDERED_WINDOWS:
        numbered = (f"SELECT tapline_k, ROW_NUMBER() OVER () AS tapline_r FROM (SELECT {column} AS tapline_k FROM ({text}) tapline_i "
                    f"WHERE {column} IS NOT NULL ORDER BY {column}) tapline_s")
    else:
        numbered = (f"SELECT {column} AS tapline_k, ROW_NUMBER() OVER (ORDER BY {column}) AS tapline_r FROM ({text}) tapline_i "
                    f"WHERE {column} IS NOT NULL")
    points = rows_of(f"SELECT tapline_k FROM ({numbered}) tapline_p WHERE MOD(tapline_r, {step}) = 0") if filled else []
    return Histogram(sorted(r[0] for r in points), step, filled, everything - filled)


def conditions(found: Histogram, column: str, partitions: int, spread_by: str | None = None) -> list[str]:
    """One condition a partition: ranges of keys of like depth, hot keys by themselves, and null keys."""
    share = max(1.0, (found.filled + found.nulls) / partitions)
    weights: dict = {}
    for key in found.points:
        weights[key] = weights.get(key, 0) + found.step
    hot = [k for k, n in weights.items() if n >= max(share / 2, 2 * found.step)]
    alone = set(hot)
    cuts, depth = [], 0
    for key, n in weights.items():                          # a range ends before the key that begins the next
        if key in alone:
            continue
        if depth and depth + n > share:
            cuts.append(key)
            depth = 0
        depth += n
    apart = "".join(f" AND {column} <> {literal(k)}" for k in hot)
    bounds = [None, *cuts, None]
    out = []
    for low, high in zip(bounds, bounds[1:]):
        parts = ([f"{column} >= {literal(low)}"] if low is not None else []) + ([f"{column} < {literal(high)}"] if high is not None else [])
        out.append((" AND ".join(parts) or f"{column} IS NOT NULL") + apart)
    for key in hot:
        out += spread(f"{column} = {literal(key)}", weights[key], share, spread_by)
    if found.nulls or not found.filled:
        out += spread(f"{column} IS NULL", found.nulls, share, spread_by)
    return out


def spread(condition: str, rows: int, share: float, spread_by: str | None) -> list[str]:
    """The condition, split by the remainder of ``spread_by`` into parts of about one share."""
    parts = max(1, round(rows / share))
    if parts == 1 or not spread_by:
        return [condition]
    remainder = f"MOD(ABS({spread_by}), {parts})"
    first = f"{condition} AND ({remainder} = 0 OR {spread_by} IS NULL)"
    return [first, *(f"{condition} AND {remainder} = {k}" for k in range(1, parts))]
