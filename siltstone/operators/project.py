"""Projections: rule-based renames, typed renames, header normalisation, output contracts."""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


#: What a landed row that does not fit its columns brings along: its whole text, and the file it stands in.
MALFORMED, FILE = "_malformed", "_file"


class Field(NamedTuple):
    source: str
    target: str
    type: str | None


def snake_name(source: str) -> str:
    """``ShippingStateCode`` -> ``shipping_state_code``, ``IFS_Opp_No__c`` -> ``ifs_opp_no__c``,
    ``CF$_KW`` -> ``cf_kw``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", source.replace("$", "")).lower()


def fields(text: str) -> list[Field]:
    """Read a column list, one ``source [: type] [-> target]`` per line.

    The target defaults to ``snake_name(source)``.
    """
    out = []
    for line in filter(None, (part.strip() for part in text.splitlines())):
        left, _, target = (p.strip() for p in line.partition("->"))
        source, _, type_ = (p.strip() for p in left.partition(":"))
        out.append(Field(source, target or snake_name(source), type_ or None))
    return out


def _value(field: Field) -> Column:
    c = F.col(f"`{field.source}`")
    return c.try_cast(field.type) if field.type else c


def project(df: DataFrame, spec: str) -> DataFrame:
    """Select, rename and cast the listed columns.  A value that does not fit its type becomes NULL.  What tells
    malformed rows apart, if there, is kept beside them."""
    return df.select(*[_value(f).alias(f.target) for f in fields(spec)], *[c for c in (MALFORMED, FILE) if c in df.columns])


def rejected_cells(df: DataFrame, spec: str) -> DataFrame:
    """One row: for every typed column, how many non-NULL cells ``project`` turns into NULL."""
    return df.agg(*[
        F.count_if(F.col(f"`{f.source}`").isNotNull() & _value(f).isNull()).alias(f.target)
        for f in fields(spec) if f.type
    ])


def normalize_headers(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that differ only in case are an error here,
    not an ambiguity at first use."""
    lowered = [c.lower() for c in df.columns]
    clashes = sorted(name for name, n in Counter(lowered).items() if n > 1)
    if clashes:
        raise ValueError(f"columns differ only in case: {clashes}")
    return df.toDF(*lowered)


def to_contract(df: DataFrame, ddl: str) -> DataFrame:
    """Match the frame to a declared schema by name.

    Reorders columns, widens numbers, fills absent nullable columns with NULL and attaches the column
    comments.  A narrowing type change or a column the contract does not declare is an error.
    """
    schema = StructType.fromDDL(ddl)
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns outside the contract: {extra}")
    return df.to(schema)


def sql_over(text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text over DataFrames named in it as ``{name}``; no session-wide view is created."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)
