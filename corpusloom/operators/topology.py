"""Topological order of histories, oldest first."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.sources import tables

#: Ranges of levels whose commits are numbered apart.
RANGES = 4096


def levels(commits: DataFrame, commit: str = "commit", parents: str = "parents") -> DataFrame:
    """commit, level: the commits on the longest way to a commit from one without parents. Raises on cycles.

    Parents outside the table don't count, nor does one that is named twice. Commits with one parent are lines: pointers to the next
    commit that has none or several double their steps each round. What is left are merges, and each round settles those all of whose lines
    begin at settled ones. So the rounds follow the logarithm of the longest line, and the merges on a way. Each round's table is written.
    """
    spark = commits.sparkSession
    folder = tables.scratch(spark, "levels")
    own = commits.select(F.col(commit).alias("c")).distinct()
    edges = commits.select(F.col(commit).alias("c"), F.explode(parents).alias("p")).distinct()
    edges = tables.saved(edges.join(own.withColumnRenamed("c", "p"), "p", "left_semi").select("c", "p"), f"{folder}/edges")
    n_parents = edges.groupBy("c").agg(F.count("*").alias("n"), F.min("p").alias("p"))
    kinds = tables.saved(own.join(n_parents, "c", "left").select("c", F.coalesce("n", F.lit(0)).alias("n"), "p"), f"{folder}/kinds")
    # a pointer ends at a commit with no or several parents: to there it is steps long
    ways = tables.saved(kinds.select("c", F.when(F.col("n") == 1, F.col("p")).otherwise(F.col("c")).alias("to"), F.when(F.col("n") == 1, 1).otherwise(0).cast("long").alias("steps")), f"{folder}/ways-0")
    most = own.count()
    step = 0
    while True:
        step += 1
        on = ways.select(F.col("c").alias("to"), F.col("to").alias("_far"), F.col("steps").alias("_more"))
        ways = tables.saved(ways.join(on, "to").select("c", F.col("_far").alias("to"), (F.col("steps") + F.col("_more")).alias("steps"), (F.col("_more") > 0).alias("open")), f"{folder}/ways-{step}")
        if not ways.where("open").limit(1).count():
            break
        if 1 << (step - 1) > 2 * most:
            raise ValueError("the history has a cycle")
    ways = ways.drop("open")
    needs = edges.join(kinds.where("n > 1").select("c"), "c", "left_semi").join(ways.select(F.col("c").alias("p"), "to", "steps"), "p").groupBy("c", "to").agg((F.max("steps") + 1).alias("steps"))
    needs = tables.saved(needs, f"{folder}/needs-0")
    settled = tables.saved(kinds.where("n = 0").select("c", F.lit(0).cast("long").alias("level")), f"{folder}/settled-0")
    fresh, step = settled, 0
    while needs.limit(1).count():
        step += 1
        # what was settled last is taken into account once: (c, to null) holds the greatest level so far
        known = needs.join(fresh.select(F.col("c").alias("to"), "level"), "to", "left")
        now = known.groupBy("c").agg(F.max(F.when(F.col("to").isNull(), F.col("steps")).otherwise(F.col("level") + F.col("steps"))).alias("level"), F.count_if(F.col("to").isNotNull() & F.col("level").isNull()).alias("open"))
        now = tables.saved(now, f"{folder}/now-{step}")
        fresh = now.where("open = 0").select("c", "level")
        if not fresh.limit(1).count():
            if not known.where("level is not null and to is not null").limit(1).count():
                raise ValueError("the history has a cycle")
        left = known.where("to is not null and level is null").select("c", "to", "steps")
        carried = now.where("open > 0 and level is not null").select("c", F.lit(None).cast("string").alias("to"), F.col("level").alias("steps"))
        needs = tables.saved(left.unionByName(carried), f"{folder}/needs-{step}")
        settled = settled.unionByName(fresh)
        if step % 16 == 0:
            settled = tables.saved(settled, f"{folder}/settled-{step}")
    return ways.join(settled.select(F.col("c").alias("to"), "level"), "to").select(F.col("c").alias(commit), (F.col("level") + F.col("steps")).alias("level"))


def positions(commits: DataFrame, commit: str = "commit", parents: str = "parents") -> DataFrame:
    """commit, level, position (from 0): parents before children, by level and then by commit.

    Commits are counted by level and the first characters of their names first, so no window spans the table but one over these counts' ranges.
    """
    l = tables.saved(levels(commits, commit, parents), f"{tables.scratch(commits.sparkSession, 'positions')}/levels")
    part = F.substring(commit, 1, 2)
    counts = l.groupBy("level", part.alias("part")).agg(F.count("*").alias("n"))
    span = F.floor(F.col("level") / F.greatest(F.lit(1), F.lit((l.agg(F.max("level")).collect()[0][0] or 0) // RANGES + 1))).alias("span")
    totals = counts.groupBy(span).agg(F.sum("n").alias("n"))
    before = totals.select("span", F.coalesce(F.sum("n").over(Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("span").orderBy("level", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("span", span).withColumn("_in", inner).join(F.broadcast(before), "span").select("level", "part", (F.col("_before") + F.col("_in")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("level", "part").orderBy(commit)) - 1
    return l.withColumn("part", part).withColumn("_place", place).join(starts, ["level", "part"]).select(commit, "level", (F.col("_start") + F.col("_place")).alias("position"))
