"""Connected components of links between documents, by contraction.

Every node takes the smallest of itself and its neighbours as parent, links are rewritten to the
parents, and what is left is contracted again until no link remains. Even rounds compare ids, which
settles the stars that candidate search makes at once; odd rounds compare hashes of ids, so a long
chain shrinks by a constant factor. Minima combine before the shuffle and each round's tables are
written to the shared folder, so a hub or a lost executor costs nothing but its own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node of its component."""
    edges = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges"
    )
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node"))).distinct()
    assigned = nodes.withColumn("root", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        rank = (lambda c: F.struct(c.alias("x"), c.alias("id"))) if turn % 2 == 0 else (
            lambda c, t=turn: F.struct(F.xxhash64(c, F.lit(t)).alias("x"), c.alias("id"))
        )
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        parents = materialise(
            best.select(F.col("a").alias("_n"), F.least(F.col("m"), rank(F.col("a")))["id"].alias("_p")), "parents"
        )
        # each round's parents are a written table, so this chain of joins is as long as there are rounds
        assigned = assigned.join(parents, assigned["root"] == parents["_n"], "left").select("node", F.coalesce("_p", "root").alias("root"))
        left = parents.select(F.col("_n").alias("_na"), F.col("_p").alias("_pa"))
        right = parents.select(F.col("_n").alias("_nb"), F.col("_p").alias("_pb"))
        moved = edges.join(left, edges["a"] == left["_na"]).join(right, edges["b"] == right["_nb"])
        edges = materialise(
            moved.select(F.least("_pa", "_pb").alias("a"), F.greatest("_pa", "_pb").alias("b")).where("a < b").distinct(),
            "edges",
        )
        turn += 1
    assigned = materialise(assigned, "roots")
    lowest = assigned.groupBy("root").agg(F.min("node").alias("low"))
    return materialise(assigned.join(lowest, "root").select("node", F.col("low").alias("root")), "components")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after more links: only roots that new links join are contracted again."""
    of_a = roots.select(F.col("node").alias("_a"), F.col("root").alias("_ra"))
    of_b = roots.select(F.col("node").alias("_b"), F.col("root").alias("_rb"))
    met = links.join(of_a, links["a"] == of_a["_a"], "left").join(of_b, links["b"] == of_b["_b"], "left")
    top = components(met.select(F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b")))
    above = top.select(F.col("node").alias("_n"), F.col("root").alias("_top"))
    old = roots.join(above, roots["root"] == above["_n"], "left").select("node", F.coalesce("_top", "root").alias("root"))
    return old.unionAll(top.join(roots, "node", "left_anti").select("node", "root"))


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members (bucket, node, ref) with the roots of node and ref."""
    of_node = roots.select(F.col("node").alias("_n"), "root")
    of_ref = roots.select(F.col("node").alias("_r"), F.col("root").alias("_ref_root"))
    joined = members.join(of_node, members["node"] == of_node["_n"], "left").join(of_ref, members["ref"] == of_ref["_r"], "left")
    return joined.select("bucket", "node", "ref", F.coalesce("root", "node").alias("root"), F.coalesce("_ref_root", "ref").alias("ref_root"))


def _pairs(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def linked(buckets: DataFrame, verify, measure=None, possible=None) -> tuple[DataFrame, DataFrame]:
    """Links and components of nodes that share buckets.

    buckets: (bucket, node). verify: takes pairs (a, b), a < b, and returns those that hold, with a and
    b among its columns. First every node of a bucket meets its smallest one. Then, in buckets that
    still hold several components, each node outside the first one's component meets all nodes of
    other components. So a bucket whose nodes are all alike costs one pair a node, and every link
    between nodes of one bucket that could join two components is tried.

    measure: takes nodes (node) and returns them with columns that `possible` compares: possible(x, y)
    gets the two nodes' columns by name and says whether the pair may hold. Pairs that can't are not
    made after the first step, which settles the many that hang about a large group of copies without
    belonging to it.
    """
    centers = buckets.groupBy("bucket").agg(F.min("node").alias("ref"), F.max("node").alias("most")).where("ref < most").drop("most")
    members = materialise(buckets.join(centers, "bucket").distinct(), "members")
    tried = materialise(members.where("node > ref").select(F.col("ref").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    links = materialise(verify(tried), "links")
    roots = components(links)
    placed = materialise(_placed(members, roots), "placed")
    open_ = placed.join(placed.where("root <> ref_root").select("bucket").distinct(), "bucket", "left_semi")
    names: list[str] = []
    if measure is not None:
        open_ = materialise(open_, "open-buckets")
        measured = materialise(measure(open_.select("node").distinct()), "measured")
        names = [c for c in measured.columns if c != "node"]
        open_ = open_.join(measured, "node")
    of_x = {c: F.col(f"x_{c}") for c in names}
    may = possible({c: F.col(c) for c in names}, of_x) if names else F.lit(True)
    # two nodes that share several buckets are paired in the first of them only
    held = open_.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("_in"))
    open_ = open_.join(held, "node")
    outside = open_.where("root <> ref_root").select("bucket", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "_in", *names)])
    apart = (F.col("root") != F.col("x_root")) & ((F.col("root") == F.col("ref_root")) | (F.col("node") < F.col("x_node")))
    first = F.array_min(F.array_intersect("_in", "x__in")) == F.col("bucket")
    rest = open_.where("node <> ref").join(outside, "bucket").where(apart & first & may).select(*_pairs("node", "x_node")).distinct()
    rest = materialise(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = materialise(verify(rest), "links")
        links, roots = links.unionAll(more), merged(roots, more)
    return links, roots
