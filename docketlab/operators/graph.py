"""Match graphs: components, density, and splitting of loose clusters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.scratch import discard, written


def both_ways(edges: DataFrame) -> DataFrame:
    pairs = edges.select("src", "dst").where("src <> dst")
    return pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


#: Edges whose forest one task finds, and that one file of a round holds.
EDGES_PER_TASK = 200_000


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def least_reached(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches over the edges ``u, v``: roots are hooked to lesser ones, and
    edges between what is joined already are dropped, until none is left."""
    root = np.arange(n)
    while len(u):
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(up := root[root], root):
            root = up
        u, v = root[u], root[v]
        apart = u != v
        u, v = u[apart], v[apart]
    return root


def _forest(batches):
    """Task: of its edges as many as join the same nodes, each from a node to the least one that it reaches here."""
    none = np.empty(0, np.int64)
    u, v = (np.concatenate(x) for x in zip((none, none), *([b.column(k).to_numpy() for k in (0, 1)] for b in batches)))
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = least_reached(at[: len(u)], at[len(u) :], len(nodes))
    low = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[low]), pa.array(nodes[root[low]])], ["u", "v"])


def _settled(forest: DataFrame) -> bool:
    """Whether each node has one edge at most to a lesser one, which has none: nothing is left to join."""
    ends = forest.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(forest.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def star_components(edges: DataFrame, rounds: int = 60, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u, v``) with an edge to another; the root is its component's least.

    Each round deals the edges evenly to tasks of ``per_task`` edges, by turns those of near nodes together, as ids
    given one after another are often linked, and by number; each task leaves a forest of them. If the forests settle
    all, they are the result. Else a large star and a small star follow: each is a minimum per node and a join, both on
    the node, so a node with very many edges is combined map-side and its join can be split; no neighbour list is ever
    gathered. What a round leaves is written, in as many files as it has tasks. An empty edge table gives an empty
    result; self-loops are ignored.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    now = written(pairs.distinct(), "edges")
    for nr in range(rounds):
        tasks = 1 + now.count() // per_task
        if tasks == 1:
            dealt = now.coalesce(1)
        else:
            dealt = now.repartition(tasks, F.xxhash64("u", "v")) if nr % 2 else now.repartitionByRange(tasks, "v", "u")
        forest = written(dealt.mapInArrow(_forest, "u long, v long"), "forest")
        discard(now)
        if tasks == 1 or _settled(forest):
            named = forest.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return named.unionByName(forest.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        large = written(_large_star(forest).coalesce(tasks), "large")
        discard(forest)
        now = written(_small_star(large).coalesce(tasks), "small")
        discard(large)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, component`` for each vertex, the component being its least id; only linked vertices take part in the rounds."""
    roots = star_components(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")))
    return written(vertices.join(roots, vertices["id"] == roots["node"], "left").select("id", F.coalesce("root", "id").alias("component")), "components")


def density(members: DataFrame, edges: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``component, size, least, valid``: whether each member is linked to that share of the others at least.

    Components of two or one are valid.
    """
    # Edges meet their components in one direction and are turned round after that.
    links = edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    inside = links.join(members.select(F.col("id").alias("src"), "component"), "src").join(members.select(F.col("id").alias("dst"), F.col("component").alias("other")), "dst").where("component = other")
    degree = inside.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    size = members.groupBy("component").agg(F.count("*").alias("size"))
    share = members.join(degree, "id", "left").join(size, "component").withColumn("share", F.coalesce("n", F.lit(0)) / F.greatest(F.col("size") - 1, F.lit(1)))
    return share.groupBy("component", "size").agg(F.min("share").alias("least")).withColumn("valid", (F.col("size") <= 2) | (F.col("least") >= threshold))


def split_members(ids: list, links: dict, keys: dict, threshold: float) -> list[set]:
    """Valid parts of one component; ``links`` has each id's neighbours, ``keys`` its case ids.

    A component whose members share one case id stays whole. Otherwise loosely linked members leave it at once, unless
    they share a case id with one that stays, and the rest is looked at again; those that left are on their own.
    """
    todo, done = [set(ids)], []
    while todo:
        nodes = todo.pop()
        n = len(nodes)
        loose = {v for v in nodes if len(links.get(v, set()) & nodes) < threshold * (n - 1)}
        common = set.intersection(*(set(keys.get(v, ())) for v in nodes))
        if n <= 2 or not loose or common:
            done.append(nodes)
            continue
        kept = nodes - loose
        held = set().union(*(set(keys.get(v, ())) for v in kept)) if kept else set()
        rescued = {v for v in loose if held & set(keys.get(v, ()))}
        kept, loose = kept | rescued, loose - rescued
        if not loose:
            done.append(nodes)
            continue
        done += [{v} for v in sorted(loose)]
        while kept:
            part, front = set(), {min(kept)}
            while front:
                part |= front
                front = set().union(*(links.get(v, set()) for v in front)) & kept - part
            kept -= part
            todo.append(part)
    return done


def grow_members(ids: list, links: dict, threshold: float = 0.5) -> list[set]:
    """Greedy variant: from each seed in order, members are added while all keep the share of links."""
    left, done = sorted(ids), []
    while left:
        part = {left[0]}
        for v in left[1:]:
            trial = part | {v}
            if len(trial) <= 2 and v in links.get(left[0], set()) or len(trial) > 2 and all(len(links.get(u, set()) & trial) >= threshold * (len(trial) - 1) for u in trial):
                part = trial
        done.append(part)
        left = [v for v in left if v not in part]
    return done


def split_components(members: DataFrame, edges: DataFrame, keys: DataFrame | None = None, threshold: float = 0.3, grow: bool = False) -> DataFrame:
    """``id, cluster``: components that are dense enough as they are, the others split; the cluster is its least id.

    Only invalid components are gathered, each as the edges inside it. They are dealt to tasks by number and come one
    after another in each, so the cost is that of their edges and not one of starting work on each component.
    """
    bad = written(density(members, edges, threshold).where("NOT valid").select("component"), "invalid")
    fine = members.join(bad, "component", "left_anti").select("id", F.col("component").alias("cluster"))
    loose = members.join(bad, "component", "left_semi")
    near = both_ways(edges).join(loose.select(F.col("id").alias("src")), "src", "left_semi").groupBy("src").agg(F.collect_set("dst").alias("near"))
    loose = loose.join(near, loose["id"] == near["src"], "left").drop("src")
    if keys is None:
        loose = loose.withColumn("keys", F.array().cast("array<string>"))
    else:
        loose = loose.join(keys.select("id", "keys"), "id", "left")

    def parts_of(rows: list) -> list[tuple]:
        links = {v: set(near) if near is not None else set() for _, v, near, _ in rows}
        own = {v: own if own is not None else [] for _, v, _, own in rows}
        parts = grow_members(list(links), links, threshold) if grow else split_members(list(links), links, own, threshold)
        return [(v, least) for p in parts for least in (min(p),) for v in p]

    def split(batches):
        """Task: rows come component by component; one that a batch breaks off goes on in the next."""
        held: list = []
        for b in batches:
            done = []
            for row in zip(*(b.column(k).to_pylist() for k in range(4))):
                if held and held[-1][0] != row[0]:
                    done += parts_of(held)
                    held = []
                held.append(row)
            if done:
                yield _pairs(done)
        if held:
            yield _pairs(parts_of(held))

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = loose.select(F.col("component").cast("long"), F.col("id").cast("long"), F.col("near").cast("array<long>"), "keys").repartition(tasks, "component").sortWithinPartitions("component")
    return fine.unionByName(dealt.mapInArrow(split, "id long, cluster long"))


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["id", "cluster"])


def star_edges(rows: DataFrame, key, id_col: str = "id") -> DataFrame:
    """Edges from the least id of each key to the others: as good as all pairs for components, and linear."""
    least = rows.groupBy(key).agg(F.min(id_col).alias("src"))
    return rows.join(least, key).select("src", F.col(id_col).alias("dst")).where("src <> dst").distinct()
