"""Distributed union-find: components of an edge table by alternating large-star and small-star
steps, and the comparison of bucket members that leads to the edges. Every step is joins and
map-side-combined aggregates over the edges, written to the shared folder; nothing but the answer
to "are they stars yet" reaches the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.common import written


DRAWN = 6
GROUP = 500


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Every node points at one root, and no root points on."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node that isn't the least of its component, from edges (a, b) of longs;
    root is the least one. Loops and repeated edges don't matter; no edges give no row."""
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def bucket_members(spread: DataFrame) -> DataFrame:
    """(bucket, uid, size) of the buckets with several members, from (uid, bucket) rows that may repeat. Buckets
    of the same members get one name, by their members; their rows repeat."""
    whole = Window.partitionBy("bucket")
    members = spread.select("uid", F.min("uid").over(whole).alias("u0"), F.max("uid").over(whole).alias("u1"),
                            F.count(F.lit(1)).over(whole).alias("size"), F.bit_xor(F.xxhash64("uid")).over(whole).alias("all"))
    return members.where("u0 < u1").select(F.xxhash64("size", "all").alias("bucket"), "uid", "size")


def shared_buckets(spread: DataFrame) -> DataFrame:
    """``bucket_members``, each bucket once: those of the same members lead to the same pairs."""
    return bucket_members(spread).distinct()


def link_buckets(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str, hub_rounds: int,
                 sets_of: Callable[[DataFrame], DataFrame] | None = None, threshold: float = 0.8,
                 pairs_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components of the links among members of the same bucket, from ``buckets`` (bucket, uid) and
    ``verify``, which takes pairs (a, b) to (a, b, ok); (node, root) as ``components`` gives.

    Each round compares one member of every bucket that still holds several components, its hub, with
    its members of other components, so the pairs are no more than the rows of the buckets. The hub
    is the most central member: that with the most fellow members over all its
    buckets, as the original is of which the others are edited copies. The second round's hub is the
    most central one outside the bucket's largest component; later rounds draw ``DRAWN`` members of that
    component by a hash that differs by bucket, so that a member outside it meets that many of them in
    each of its buckets. The members of buckets that then still hold several components are paired by
    ``could_be_alike`` over ``sets_of``, which takes (uid, root) to (uid, root, elements): every pair of
    a bucket is compared, or can't reach the threshold, or is in one component. ``pairs_of`` stands for
    all that: it takes (bucket, uid, root, main), the root of the bucket's largest component, to the pairs
    to compare. Without either all pairs of these buckets are compared."""
    size = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    central = written(buckets.join(size, "bucket").groupBy("uid").agg(F.sum("size").alias("fellows")), f"{name}-central")
    # one sortable number: fellows first, the uid's hash to part equals
    rank = F.struct("fellows", F.xxhash64("uid").alias("tie"), "uid", "root")
    state = written(buckets.join(central, "uid").select("bucket", "uid", F.col("uid").alias("root"), "fellows"), f"{name}-state")
    links: list[DataFrame] = []
    roots = None
    for turn in range(hub_rounds):
        if turn:
            state = written(_apart(state, roots), f"{name}-apart")
            if turn == 1:
                hubs = state.where("root != main").groupBy("bucket").agg(F.max(rank).alias("hub"))
            else:
                drawn = Window.partitionBy("bucket").orderBy(F.xxhash64("uid", "bucket", F.lit(turn)), "uid")
                hubs = state.where("root = main").withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= DRAWN).select("bucket", F.struct("uid", "root").alias("hub"))
            state = state.drop("main")
        else:
            hubs = state.groupBy("bucket").agg(F.max(rank).alias("hub"))
        pairs = state.join(hubs, "bucket").where("root != hub.root").select(F.least("uid", "hub.uid").alias("a"), F.greatest("uid", "hub.uid").alias("b"))
        pairs = written(pairs.distinct(), f"{name}-pairs")
        if turn and pairs.isEmpty():
            return roots
        # filtered when read again: what the verdict needs twice is then computed once
        links.append(written(verify(pairs), f"{name}-links").where("ok").select("a", "b"))
        roots = components(all_of(links), f"{name}-components")
    state = written(_apart(state, roots).select("bucket", "uid", "root", "main"), f"{name}-apart")
    if state.isEmpty():
        return roots
    if pairs_of:
        pairs = pairs_of(state)
    elif sets_of:
        rest = written(state.select("uid", "root").distinct(), f"{name}-rest")
        pairs = could_be_alike(sets_of(rest), threshold, f"{name}-rest")
    else:
        mates = state.select("bucket", F.col("uid").alias("b"), F.col("root").alias("r"))
        pairs = state.join(mates, "bucket").where("uid < b and root != r").select(F.col("uid").alias("a"), "b").distinct()
    pairs = written(pairs, f"{name}-pairs")
    links.append(written(verify(pairs), f"{name}-links").where("ok").select("a", "b"))
    return components(all_of(links), f"{name}-components")


def all_of(parts: list[DataFrame]) -> DataFrame:
    every = parts[0]
    for more in parts[1:]:
        every = every.union(more)
    return every


def _apart(state: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components by ``roots``, with the root of the largest one."""
    state = state.drop("root").join(roots.select(F.col("node").alias("uid"), "root"), "uid", "left").select("bucket", "uid", F.coalesce("root", "uid").alias("root"), "fellows")
    sizes = state.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.count(F.lit(1)).alias("parts")).where("parts > 1").select("bucket", F.col("m.root").alias("main"))
    return state.join(main, "bucket")


def could_be_alike(sets: DataFrame, threshold: float, name: str) -> DataFrame:
    """Pairs (a, b) of ``sets`` (uid, root, elements) with other roots whose similarity may be the
    threshold or more; none that has it is left out.

    The sets are put in one order, the elements of one component alone first, then the rarest. Two
    sets with enough in common have their first common element so early in both that the rest of
    either can hold as many as they need, so the join is over the sets' beginnings, with that bound
    at each common element. An element of many sets is dealt to pairs of groups of them, no task
    having more than about 2 x ``GROUP`` of its sets."""
    each = sets.select("uid", "root", F.size("elements").alias("n"), F.explode("elements").alias("e"))
    many = each.groupBy("e").agg(F.count(F.lit(1)).alias("df"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("e", "df")
    common = each.join(many, "e").groupBy("uid", "root", "n").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("s"))
    own = F.col("n") - F.size("s")  # elements before the common ones
    early = F.floor(F.col("n") * (1 - threshold) + 1e-6) + 1 - own
    starts = common.where(early > 0).select("uid", "root", "n", own.alias("own"), F.posexplode(F.slice("s", F.lit(1), early.cast("int"))))
    groups = F.ceil(F.col("col.df") / GROUP)
    dealt = starts.select("uid", "root", "n", (F.col("n") - F.col("own") - F.col("pos")).alias("left"), F.col("col.e").alias("e"),
                          F.pmod(F.xxhash64("uid"), groups).alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), groups - 1)).alias("h"))
    dealt = written(dealt.select("uid", "root", "n", "left", "e", "g", F.least("g", "h").alias("lo"), F.greatest("g", "h").alias("hi")), f"{name}-starts")
    x, y = (dealt.select("e", "lo", "hi", *[F.col(c).alias(c + k) for c in ("uid", "root", "n", "left", "g")]) for k in "xy")
    need = threshold / (1 + threshold) * (F.col("nx") + F.col("ny")) - 1e-6
    both = x.join(y, ["e", "lo", "hi"]).where((F.col("uidx") < F.col("uidy")) & (F.col("rootx") != F.col("rooty")) & ((F.col("lo") == F.col("hi")) | (F.col("gx") != F.col("gy"))) & (F.least("leftx", "lefty") >= need))
    return both.select(F.col("uidx").alias("a"), F.col("uidy").alias("b")).distinct()
