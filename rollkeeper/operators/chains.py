"""Chains of rows that wait for one another, followed by doubling.

Each round joins the steps with themselves, so they are twice as long as before: a chain of n
takes log2(n) rounds. Steps and findings are stored tables; nothing but their counts comes to
the driver. So the joins are merge joins: a broadcast in each of many rounds would bring every
one of these tables through the driver, small as each may be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.session import written


def doomed(steps: DataFrame, lost: DataFrame) -> DataFrame:
    """The nodes from which some path over ``steps`` (a, b) leads to a ``lost`` node (n) or into a ring; stored."""
    lost = written(lost.select("n").distinct(), "lost")
    steps = written(steps.select("a", "b").distinct(), "steps")
    nodes = steps.select("a").distinct().count()
    # a path of so many steps as there are nodes that have one runs in a ring
    for _ in range(nodes.bit_length() + 1):
        if steps.isEmpty():
            return lost
        found = steps.join(lost.hint("merge"), steps.b == lost.n, "left_semi").select(F.col("a").alias("n"))
        lost = written(lost.unionByName(found).distinct(), "lost")
        live = steps.join(lost.hint("merge"), steps.a == lost.n, "left_anti")
        onward = steps.select(F.col("a").alias("b"), F.col("b").alias("c"))
        steps = written(live.join(onward.hint("merge"), "b").select("a", F.col("c").alias("b")).distinct(), "steps")
    rest = steps.select(F.col("a").alias("n"))
    return written(lost.unionByName(rest).distinct(), "lost")
