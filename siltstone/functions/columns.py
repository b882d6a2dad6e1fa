"""Column expressions shared by the curated tables.  All of them stay JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The accepted boolean spellings, compared in lower case.
TRUE_TEXT = ("true", "t", "1")
FALSE_TEXT = ("false", "f", "0")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentinel_to_null(c: str | Column, sentinel: str = "NULL") -> Column:
    """NULL where the column holds the sentinel text, the value itself elsewhere."""
    return F.nullif(_col(c), F.lit(sentinel))


def joined_text(*cols: str | Column, sep: str = ", ") -> Column:
    """Non-NULL parts joined by ``sep``; the empty string, never NULL, when every part is NULL."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def parse_bool(c: str | Column, strict: bool = True) -> Column:
    """Boolean from text.

    Only the spellings above count, in any case; blanks are not trimmed and ``yes`` is invalid.
    ``strict`` fails the query on any other value, NULL included; otherwise such values give NULL.
    """
    c = _col(c)
    low = F.lower(c)
    if strict:
        message = F.concat(F.lit("invalid boolean text: "), F.coalesce(c, F.lit("NULL")))
        other = F.raise_error(message).cast("boolean")
    else:
        other = F.lit(None).cast("boolean")
    return F.when(low.isin(*TRUE_TEXT), True).when(low.isin(*FALSE_TEXT), False).otherwise(other)


def bool_text(c: str | Column) -> Column:
    """``'True'`` for a true boolean or the number 1, ``'False'`` for anything else and for NULL."""
    return F.when(_col(c).cast("double") == 1, "True").otherwise("False")


def map_fields(c: str | Column, fields: Sequence[str]) -> list[Column]:
    """One column per map key; a missing key gives NULL, under ANSI rules too."""
    return [F.try_element_at(_col(c), F.lit(f)).alias(f) for f in fields]


def hashed_id(c: str | Column) -> Column:
    """md5 of the id's text form; NULL for a NULL id."""
    return F.md5(_col(c).cast("string"))


def surrogate_key(*ids: str | Column, hashed: str | Column | None = None) -> Column:
    """The first non-NULL natural id, else the md5 of ``hashed``."""
    candidates = [_col(c) for c in ids]
    if hashed is not None:
        candidates.append(hashed_id(hashed))
    return F.coalesce(*candidates)


def survivorship(df: DataFrame, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each rule keep the first non-NULL source, in the order given, and drop the losing columns."""
    merged = df.withColumns({name: F.coalesce(*[F.col(s) for s in sources]) for name, sources in rules.items()})
    losers = {s for sources in rules.values() for s in sources} - set(rules)
    return merged.drop(*losers)
