"""Communities of labels on the weighted co-occurrence graph, as rounds of joins on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.staging import stage

LEAST_GAIN = 1e-12
#: One in so many of the nodes that can gain moves in a round; after the last number the best single node.
SHARES = (2, 16)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def modularity(edges: DataFrame, state: DataFrame) -> float:
    """Modularity of (label, community) on (src, dst, weight): share of weight inside communities minus the share by chance."""
    ends = _both_ways(edges)
    named = [state.select(F.col("label").alias(end), F.col("community").alias(name)) for end, name in (("src", "a"), ("dst", "b"))]
    joined = ends.join(named[0], "src").join(named[1], "dst")
    per = joined.groupBy("a").agg(F.sum("weight").alias("all"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0)).alias("inside"))
    total = per.agg(F.sum("all")).scalar().cast("double")
    return per.agg(F.sum(F.col("inside") / total - F.pow(F.col("all") / total, 2))).first()[0] or 0.0


def _judged(links: DataFrame, nodes: DataFrame, double: float) -> DataFrame:
    """(node, inside, new, gain): weight of a node inside its community, its best other community and what moving there gains.

    Moving from A to C gains w(C) - w(A) - k (tot(C) - tot(A) + k) / 2m, in units of m. Among equal gains the first name wins.
    """
    sizes = nodes.groupBy("community").agg(F.sum("degree").alias("tot"))
    seen = links.join(nodes.select(F.col("node").alias("dst"), "community"), "dst").groupBy(F.col("src").alias("node"), "community").agg(F.sum("weight").alias("w"))
    own = nodes.select("node", "degree", F.col("community").alias("own")).join(sizes.select(F.col("community").alias("own"), F.col("tot").alias("own_tot")), "own")
    other = seen.join(sizes, "community").join(own, "node")
    away = F.col("community") != F.col("own")
    worth = F.when(away, F.col("w") - F.col("degree") * F.col("tot") / double)
    best = other.groupBy("node").agg(
        F.coalesce(F.max(F.when(~away, F.col("w"))), F.lit(0.0)).alias("inside"), F.max(worth).alias("worth"),
        F.min_by(F.when(away, F.col("community")), F.struct(F.coalesce(-worth, F.lit(float("inf"))), F.col("community"))).alias("new"),
        F.max(F.col("degree") * (F.col("own_tot") - F.col("degree")) / double).alias("stay"),
    )
    return best.select("node", "inside", "new", (F.col("worth") - F.col("inside") + F.col("stay")).alias("gain"))


def _quality(judged: DataFrame, nodes: DataFrame, double: float) -> float:
    inside = judged.agg(F.sum("inside")).first()[0] or 0.0
    loops, chance = nodes.groupBy("community").agg(F.sum("loop").alias("loop"), F.sum("degree").alias("tot")).agg(F.sum("loop"), F.sum(F.pow(F.col("tot") / double, 2))).first()
    return (inside + loops) / double - chance


def communities(edges: DataFrame, max_rounds: int = 1_000) -> DataFrame:
    """(label, community) by multi-level modularity on (src, dst, weight); a community is named after its first label.

    Local moves: in each round some of the nodes that gain by moving to the community of a neighbour do so at once. A round
    that does not raise the modularity is taken back and tried with fewer nodes, at last with the best one alone, which always
    gains; so the modularity only rises, until no node gains. Then every community becomes one node, edges between
    communities are summed, edges inside become its loop, and the moves begin again, until nothing merges. All tables are
    written, so the lineage stays short. If moves are still left after ``max_rounds`` rounds, an error is raised.
    """
    weights = edges.select("src", "dst", F.col("weight").cast("double").alias("weight")).filter("src <> dst AND weight > 0")
    links = stage(_both_ways(weights), "links")
    double = links.agg(F.sum("weight")).first()[0]
    if not double:
        return links.select(F.col("src").alias("label"), F.col("src").alias("community"))
    nodes = links.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("degree")).select("node", "degree", F.lit(0.0).alias("loop"))
    members = stage(nodes.select(F.col("node").alias("label"), "node"), "members")
    rounds = 0
    while True:
        state = stage(nodes.withColumn("community", F.col("node")), "level")
        judged = stage(_judged(links, state, double), "moves")
        quality, attempt = _quality(judged, state, double), 0
        while True:
            moves = judged.filter(F.col("gain") > LEAST_GAIN).select("node", "new", "gain")
            if moves.isEmpty():
                break
            rounds += 1
            if rounds > max_rounds:
                raise RuntimeError(f"labels still move after {max_rounds} rounds")
            if attempt < len(SHARES):
                moves = moves.filter(F.pmod(F.xxhash64("node", F.lit(rounds)), F.lit(SHARES[attempt])) == 0)
            else:
                moves = moves.orderBy(F.desc("gain"), "node").limit(1)
            moved = state.join(moves.select("node", "new"), "node", "left").select("node", "degree", "loop", F.coalesce("new", "community").alias("community"))
            moved = stage(moved, "level")
            after = stage(_judged(links, moved, double), "moves")
            better = _quality(after, moved, double)
            # the best single move is taken as it is: what it gains may be too little to show in the sum
            if better > quality + LEAST_GAIN or attempt == len(SHARES):
                state, judged, quality, attempt = moved, after, better, 0
            else:
                attempt += 1
        named = state.select("node", "community")
        members = stage(members.join(named, "node").select("label", F.col("community").alias("node")), "members")
        inner = links.join(named, links["src"] == named["node"]).select("dst", "weight", F.col("community").alias("a"))
        joined = stage(inner.join(named, inner["dst"] == named["node"]).groupBy("a", F.col("community").alias("b")).agg(F.sum("weight").alias("weight")), "merged")
        loops = joined.filter("a = b").select(F.col("a").alias("community"), F.col("weight").alias("more"))
        merged = state.groupBy("community").agg(F.sum("degree").alias("degree"), F.sum("loop").alias("loop")).join(loops, "community", "left")
        merged = stage(merged.select(F.col("community").alias("node"), "degree", (F.col("loop") + F.coalesce("more", F.lit(0.0))).alias("loop")), "nodes")
        if merged.count() == state.count():
            first = members.groupBy("node").agg(F.min("label").alias("community"))
            return stage(members.join(first, "node").select("label", "community"), "community")
        nodes, links = merged, stage(joined.filter("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight"), "links")


def label_propagation(edges: DataFrame, max_rounds: int = 1_000) -> DataFrame:
    """(label, community) by weighted label propagation on (src, dst, weight).

    Each round moves the nodes of one hash parity to the community with the largest total edge weight among their
    neighbours (ties: the smallest name). Alternating parities stop two neighbours from swapping for ever. Rounds are
    joins on written tables, so the lineage stays short; two quiet rounds end the loop. If labels still move after
    ``max_rounds``, an error is raised instead of an unsettled partition.
    """
    both = edges.select("src", "dst", "weight").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    links = stage(both, "links")
    state = stage(links.select(F.col("src").alias("label")).distinct().withColumn("community", F.col("label")), "community")
    parity = F.pmod(F.conv(F.substring(F.md5("src"), 1, 8), 16, 10).cast("bigint"), F.lit(2))
    quiet = 0
    for round_no in range(max_rounds):
        votes = (
            links.filter(parity == round_no % 2)
            .join(state.withColumnsRenamed({"label": "dst"}), "dst")
            .groupBy("src", "community")
            .agg(F.sum("weight").alias("w"))
        )
        choice = votes.groupBy(F.col("src").alias("label")).agg(
            F.min_by("community", F.struct(-F.col("w"), F.col("community"))).alias("new")
        )
        moved = state.join(choice, "label", "left").select(
            "label", F.coalesce("new", "community").alias("community"), F.col("community").alias("old")
        )
        moved = stage(moved, "community")
        changed = moved.filter(F.col("community") != F.col("old")).limit(1).count()
        state = moved.select("label", "community")
        quiet = 0 if changed else quiet + 1
        if quiet == 2:
            return state
    raise RuntimeError(f"labels still move after {max_rounds} rounds")
