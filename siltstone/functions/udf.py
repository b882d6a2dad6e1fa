"""User-supplied parsers, for what column expressions cannot do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from siltstone.functions.columns import map_fields


def map_parser(parse: Callable[[str], dict[str, str]], fallback: str, errors: tuple[type[Exception], ...]):
    """A UDF ``text -> map<string,string>`` that gives ``{fallback: text}`` where ``parse`` raises ``errors``."""

    def run(text):
        if text is None:
            return None
        try:
            return dict(parse(text))
        except errors:
            return {fallback: text}

    return F.udf(run, "map<string,string>", useArrow=True)


def parse_distinct(df: DataFrame, column: str, parser, fields: list[str]) -> DataFrame:
    """One row per distinct value of ``column`` with the parsed fields: the parser sees each value once."""
    parsed = df.select(column).distinct().withColumn("__map", parser(F.col(column)))
    return parsed.select(column, *map_fields("__map", fields))
