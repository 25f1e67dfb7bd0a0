"""Connected components of a link table by randomised contraction.

Each round every node moves to the neighbour (or stays itself) that is least by
a hash of the round; links are relabelled and those within one node go. Stars
fold in one round and long chains lose a constant share of their nodes a round.
All state lives in tables: links are aggregated map-side, and both sides of each
join are plain tables, so Spark can split the rows of a node with many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsieve.llm.common import write_table


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``: bigint, not null); nodes of one component
    have the same ``root``, one of them. Links may repeat, come in either order or join a node to itself."""
    def tidy(e):
        return e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    own = links.where("a = b").select("a").distinct()
    links = write_table(tidy(links))
    moves: list[DataFrame] = []
    at = links
    while not at.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(moves)), c).alias("h"), F.col(c).alias("n"))
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy("a").agg(F.min(rank("b")).alias("best")).select(
            F.col("a").alias("node"), F.least(rank("a"), F.col("best")).getField("n").alias("root"))
        move = write_table(move)
        moves.append(move)
        half = at.join(move, at["a"] == move["node"]).select(F.col("root").alias("a"), "b")
        whole = half.join(move, half["b"] == move["node"]).select("a", F.col("root").alias("b"))
        at = write_table(tidy(whole))
    if not moves:
        return own.select(F.col("a").alias("node"), F.col("a").alias("root"))
    done = moves[-1]
    for move in reversed(moves[:-1]):
        later = done.select(F.col("node").alias("via"), F.col("root").alias("end"))
        done = write_table(move.join(later, move["root"] == later["via"], "left")
                           .select("node", F.coalesce("end", "root").alias("root")))
    alone = own.join(done, own["a"] == done["node"], "left_anti").select(F.col("a").alias("node"), F.col("a").alias("root"))
    return done.unionByName(alone)
