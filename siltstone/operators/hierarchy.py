"""Two-level hierarchy lookup and roll-up over a code / parent-code table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F


ROWS_PER_TASK = 100_000  # of a roll-up, where every row may be a group


class Hierarchy(NamedTuple):
    """Column names of the table and the level at which the owner of a subtree sits."""

    code: str
    parent: str
    level: str
    name: str
    owner_level: str


def attach_owner(children: DataFrame, nodes: DataFrame, h: Hierarchy, owner_on: Column | None = None) -> DataFrame:
    """Left-join each child to its parent and, where the grandparent is at the owner level, to that.

    Adds ``parent_code``, ``parent_level``, ``parent_name``, ``owner_code``, ``owner_name`` and ``copies``.
    Equal node rows are condensed to one with a weight before the join: a code that is repeated many
    times then costs one row, and ``copies`` says how many joined rows this one stands for.
    ``owner_on`` replaces the default owner-level condition on the grandparent's columns.
    """
    keyed = nodes.where(F.col(h.code).isNotNull())
    parents = keyed.groupBy(
        F.col(h.code).alias("parent_code"), F.col(h.parent).alias("__grand"),
        F.col(h.level).alias("parent_level"), F.col(h.name).alias("parent_name"),
    ).agg(F.count("*").alias("__n1"))
    owners = keyed.where(F.col(h.level) == h.owner_level if owner_on is None else owner_on).groupBy(
        F.col(h.code).alias("owner_code"), F.col(h.name).alias("owner_name"),
    ).agg(F.count("*").alias("__n2"))
    joined = (
        children
        .join(parents, F.col(h.parent) == F.col("parent_code"), "left")
        .join(owners, F.col("__grand") == F.col("owner_code"), "left")
    )
    return joined.withColumn(
        "copies", F.coalesce("__n1", F.lit(1)) * F.coalesce("__n2", F.lit(1))
    ).drop("__grand", "__n1", "__n2")


def resolved_owner(h: Hierarchy) -> tuple[Column, Column]:
    """Code and name of the owner: the parent when it sits at the owner level, else the grandparent."""
    at_parent = F.col("parent_level") == h.owner_level
    return (
        F.when(at_parent, F.col("parent_code")).otherwise(F.col("owner_code")),
        F.when(at_parent, F.col("parent_name")).otherwise(F.col("owner_name")),
    )


def hierarchy_rollup(children: DataFrame, nodes: DataFrame, h: Hierarchy, group_by: Sequence[str],
                     amount: str, counted: str, total_as: str, count_as: str) -> DataFrame:
    """Sum ``amount`` and count non-NULL ``counted`` per child group and attached parent and owner.

    The measures run after the join, so a repeated parent code multiplies them; the weights reproduce
    that without building the repeated rows.

    Most groups are a single row with all its texts, many times what its compressed size in a shuffle tells.  So the
    groups are dealt to tasks by the number of children, which a job counts, and a task's memory does not grow with it.
    Where one group has more than a task's share, rows are combined before the shuffle instead.
    """
    owner = ["parent_code", "parent_level", "parent_name", "owner_code", "owner_name"]
    joined = attach_owner(children, nodes, h)
    sizes = children.groupBy(F.xxhash64(*group_by).alias("group")).agg(F.count("*").alias("n"))
    found = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    if found["most"] <= ROWS_PER_TASK:
        joined = joined.repartition(found["n"] // ROWS_PER_TASK + 1, *group_by, *owner)
    return joined.groupBy(*group_by, *owner).agg(
        F.sum(F.col(amount) * F.col("copies")).alias(total_as),
        F.sum(F.when(F.col(counted).isNotNull(), F.col("copies")).otherwise(F.lit(0))).alias(count_as),
    )
