"""Connected components of a graph given as an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapengine.llm.storage import written


def components(edges: DataFrame) -> DataFrame | None:
    """``v, root`` (the component's smallest vertex) for each vertex of ``edges(a, b)``, or None without an edge.

    In each round vertices are ranked anew by a hash, every vertex moves to its
    first neighbour in that order (or stays) and the edges are renamed.  No
    order of ids lasts over the rounds, so on average a fixed share of the
    vertices goes in each, a long ordered chain too, and the number of rounds is
    logarithmic.  A round's rows are one per vertex or edge, its minima are
    partial aggregates, and its tables are written, so no vertex's neighbours
    are ever gathered and a lost executor costs one round at most.
    """
    rounds = []
    e = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    while not e.isEmpty():
        both = e.select(F.col("a").alias("v"), F.col("b").alias("w")).union(e.select("b", "a"))
        salt = F.lit(len(rounds))
        first = F.least(F.struct(F.xxhash64(salt, "v").alias("h"), F.col("v").alias("w")), F.min(F.struct(F.xxhash64(salt, "w").alias("h"), "w")))
        to = written(both.groupBy("v").agg(first["w"].alias("to")), "moves")
        rounds.append(to)
        e = written(e.join(to.toDF("a", "ta"), "a").join(to.toDF("b", "tb"), "b").where("ta <> tb")
                    .select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(), "edges")
    if not rounds:
        return None
    total = rounds[-1].toDF("v", "root")
    for to in reversed(rounds[:-1]):
        total = (to.join(total.toDF("to", "root"), "to", "left")
                 .select("v", F.coalesce("root", "to").alias("root")))
    total = written(total, "roots")
    least = total.groupBy("root").agg(F.min("v").alias("least"))
    return total.join(least, "root").select("v", F.col("least").alias("root"))
