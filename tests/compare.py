"""Runs registered queries against their DuckDB oracles."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def staged_plans() -> Iterator[list[str]]:
    """The plans of all frames that are staged inside the block."""
    from siltstone.sources import stage as module

    plain, plans = module.stage, []

    def recording(df, label):
        plans.append(plan_text(df))
        return plain(df, label)

    users = [m for name, m in list(sys.modules.items()) if name.startswith("siltstone") and getattr(m, "stage", None) is plain]
    for user in users:
        user.stage = recording
    try:
        yield plans
    finally:
        for user in users:
            user.stage = plain


def check(spark: SparkSession, con, query, sql: str, sf_dir: str) -> int:
    with staged_plans() as plans:
        df = query(spark, sf_dir)
    for plan in [*plans, plan_text(df)]:
        assert not any(node in plan for node in ALL_PAIRS), plan
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    got, want = rows(df.columns, df.collect()), rows(names, expected.fetchall())
    if got != want:
        left, right = set(map(repr, got)), set(map(repr, want))
        raise AssertionError(
            f"{len(got)} rows, expected {len(want)}; only here {sorted(left - right)[:3]}; missing {sorted(right - left)[:3]}"
        )
    return len(got)
