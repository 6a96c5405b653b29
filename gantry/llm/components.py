"""Connected components by alternating large and small stars, as joins and aggregates.

No node's neighbours are ever collected: each step needs their minimum only, which
combines before the shuffle. The links of every step are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.sources.scratch import stored


LINKS_PER_TASK = 250_000


def _state(links: DataFrame) -> tuple:
    both = F.xxhash64("child", "parent")
    return tuple(links.agg(F.count("*"), F.bit_xor(both), F.sum(F.shiftright(both, 24))).first())


def components(links: DataFrame, keep: Callable[[DataFrame], DataFrame] = stored) -> DataFrame:
    """``child``, ``parent`` for links ``a``, ``b``: the smallest node of each node's component.

    ``keep`` writes the links of a step and reads them back.

    The smallest nodes themselves, and nodes without links, have no row. Null ends and
    links of a node with itself are ignored; repeated links do not matter.
    """
    a, b = F.col("a"), F.col("b")
    links = keep(
        links.where(a != b).select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct()
    )
    state = _state(links)
    while state[0]:
        # tasks by the number of links; a step over few links needs no shuffle at all
        links = links.coalesce(1 + state[0] // LINKS_PER_TASK)
        ends = F.array(F.struct(F.col("child").alias("u"), F.col("parent").alias("v")), F.struct(F.col("parent").alias("u"), F.col("child").alias("v")))
        around = links.select(F.inline(ends))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every larger neighbour of a node is linked to the smallest node around
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent"))
        root = large.groupBy("child").agg(F.min("parent").alias("root"))
        # every smaller neighbour, and the node, is linked to the smallest one
        small = (
            large.join(root, "child")
            .select(F.explode(F.array("child", "parent")).alias("child"), F.col("root").alias("parent"))
            .where(F.col("child") != F.col("parent"))
            .distinct()
        )
        links, before = keep(small), state
        state = _state(links)
        if state == before:
            break
    return links
