"""Queries over the star schema: joins, enrichment, row security.

No broadcast is forced here. A stored dimension below Spark's broadcast
threshold is broadcast because the scan knows its size; beyond it the join is a
sort-merge join whose fact side AQE may split at hot cranes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.schema import CRANE_ID, REGION
from gantry.sources.scratch import stored


def star_join(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their crane."""
    return fact.join(dim, CRANE_ID)


def enrich_dim(dim: DataFrame, master: DataFrame) -> DataFrame:
    """Dimension rows with the columns of an external master table, if it has them."""
    return dim.join(master, CRANE_ID, "left")


def granted_regions(grants: DataFrame, user: str | Column | None = None) -> DataFrame:
    """Regions one user may see; the session's user when none is named."""
    who = F.current_user() if user is None else user
    if isinstance(who, str):
        who = F.lit(who)
    return grants.filter(F.col("user_name") == who).select(REGION).distinct()


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The roots (one column) and all nodes that links from ``parent`` to ``child`` lead to.

    Each step follows the links of what the step before found and keeps what is new, so it
    ends at any depth and on cycles. The steps are written tables; there are as many as the
    deepest path has links.
    """
    name = roots.columns[0]
    links = edges.select(F.col("parent").alias("from"), F.col("child").alias(name)).where(F.col("child").isNotNull())
    newest = stored(roots.where(F.col(name).isNotNull()).distinct())
    seen = newest
    while not newest.isEmpty():
        below = links.join(newest.withColumnRenamed(name, "from"), "from").select(name).distinct()
        newest = stored(below.join(seen, name, "left_anti"))
        seen = seen.union(newest)
    return seen


def visible_regions(
    grants: DataFrame, user: str | Column | None = None, parents: DataFrame | None = None
) -> DataFrame:
    """Granted regions; with ``parents`` (``child``, ``parent``) also all regions below them."""
    granted = granted_regions(grants, user)
    return granted if parents is None else reachable(parents, granted)


def visible_cranes(
    dim: DataFrame, grants: DataFrame, user: str | Column | None = None, parents: DataFrame | None = None
) -> DataFrame:
    """Dimension rows in the visible regions. A crane without a region is in none."""
    return dim.join(visible_regions(grants, user, parents), REGION, "left_semi")


def visible_facts(
    fact: DataFrame,
    dim: DataFrame,
    grants: DataFrame,
    user: str | Column | None = None,
    parents: DataFrame | None = None,
) -> DataFrame:
    """Fact rows of the cranes the user may see."""
    return fact.join(visible_cranes(dim, grants, user, parents).select(CRANE_ID), CRANE_ID, "left_semi")


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A row for each day from ``first`` to ``last``: day, ISO week and weekday (1 to 7), month, quarter."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    days = spark.range(1).select(F.explode(span).alias("calendar_day"))
    return days.select(
        "calendar_day",
        F.weekofyear("calendar_day").alias("iso_week"),
        F.month("calendar_day").alias("month"),
        F.quarter("calendar_day").alias("quarter"),
        (F.weekday("calendar_day") + 1).alias("iso_weekday"),
    )


def on_days(dated: DataFrame, day: str, days: DataFrame) -> DataFrame:
    """Rows whose ``day`` is among the calendar ``days``, with the calendar's columns.

    Where ``day`` divides the table into folders and the days are a filtered stored calendar,
    Spark reads the calendar first and then only the folders of the days that are left.
    """
    return dated.join(days, F.col(day) == F.col("calendar_day"))
