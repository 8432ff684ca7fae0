"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors of a label are dealt to shards around centroids, each to its nearest few, so shards overlap. Every shard builds a
graph: of its nearest neighbours a vector keeps those that no kept one is much closer to. The adjacency lists of a vector from
all its shards are united. Then every vector is searched for in its nearest shard: greedily from the medoid to the
closest vectors, and from there on along all edges as long as what they reach is within range. Found pairs are verified in
double precision. An audit compares one vector in a hundred with all rows of its label; if less than ``LEAST_RECALL`` of their
links were found, the search is repeated with more overlap and a wider beam. If less than ``FLOOR`` is found even then, the labels
that miss links are compared whole, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import components, staging
from masthead.sources.staging import Staging

SIMILARITY = 0.93
SHARD = 1000  # vectors per centroid aimed at
SAMPLE = 20_000  # rows the first centroids are fitted on, over all labels
FANOUT = 64  # centroids an oversized shard is split around
FIT = 32  # rows of it to a centroid they are fitted on
PART = 20_000  # rows of it that a task deals
OVERLAP = 2  # shards of a vector
DEGREE = 24  # edges a vector keeps in a shard
CANDIDATES = 64  # nearest neighbours considered for them
ALPHA = 1.2  # how much closer a kept neighbour must be to rule another out
BEAM = 32
SLACK = 0.05  # edges are followed to vectors that are this much less similar than asked for
AUDITED = 100  # ids divisible by this
LEAST_RECALL = 0.98
FLOOR = 0.9
ROUNDS = 4
BLOCK = 2000  # rows of an audit block
LARGEST = 6000  # vectors of a shard; above, it is split anew
PROGRESS = 0.9  # of the largest shard; if the largest one of its parts has more, it is compared in blocks


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_numpy()).astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _valid(vector: Column) -> Column:
    """No null, no component that is null, NaN or infinite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means; the first centroids are spread by farthest-first choice."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    centres = sample[chosen]
    for _ in range(8):
        owner = (sample @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        norm = np.sqrt((sums * sums).sum(1))
        centres = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-12)[:, None], centres)
    return centres


def _split(rows: pd.DataFrame, centres: np.ndarray, overlap: int) -> pd.DataFrame:
    """The rows of one space, each in its nearest parts."""
    order = np.argsort(-(_unit(rows["vector"]) @ centres.T), axis=1, kind="stable")[:, :overlap]
    out = [rows.assign(space=rows["space"] + "/" + order[:, k].astype(str), home=rows["home"] & (k == 0)) for k in range(order.shape[1])]
    return pd.concat(out)[["space", "node", "vector", "home"]]


def _first_level(rest: DataFrame, total: int, overlap: int, schema: str) -> DataFrame:
    """Labels split around centroids that are fitted on the driver, on about SAMPLE rows of all of them."""
    share = F.abs(F.xxhash64("node", F.lit(0)) % 1_000_000) < F.lit(min(1.0, SAMPLE / total) * 1_000_000)
    rows = rest.filter(share).select("space", "n", "vector").toPandas()
    centres = {}
    for (space, n), group in rows.groupby(["space", "n"]):
        count = int(min(-(-n // SHARD), max(1, len(group) // 8)))
        centres[space] = _centroids(_unit(group["vector"]), count)
    shared = rest.sparkSession.sparkContext.broadcast(centres)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for space, group in frame.groupby("space"):
                own = shared.value.get(space)
                yield group.assign(space=f"{space}/0") if own is None else _split(group, own, overlap)

    return rest.select("space", "node", "vector", "home").mapInPandas(deal, schema)


def _next_level(rest: DataFrame, level: int, overlap: int, schema: str) -> DataFrame:
    """Oversized shards split around up to FANOUT centroids each, fitted on a sample of their own.

    A shard is dealt in parts of about PART rows; each part is sent the sample and fits the same centroids on it.
    """
    centroids = F.least(F.ceil(F.col("n") / SHARD), F.lit(FANOUT))
    parts = F.ceil(F.col("n") / PART).cast("int")
    chosen = F.abs(F.xxhash64("node", F.lit(level)) % 1_000_000) < centroids * (FIT * 1_000_000) / F.col("n")
    sample = rest.filter(chosen).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    sample = sample.select("space", "part", "node", "vector").toDF("s_space", "s_part", "s_node", "s_vector")
    rows = rest.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).select("space", "part", "n", "node", "vector", "home")

    def deal(own: pd.DataFrame, fitted: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"space": [], "node": [], "vector": [], "home": []})
        if not len(fitted):
            return own.assign(space=own["space"] + "/0")[["space", "node", "vector", "home"]]
        count = int(min(-(-own["n"].iloc[0] // SHARD), FANOUT))
        return _split(own, _centroids(_unit(fitted.sort_values("s_node")["s_vector"]), count), overlap)

    return rows.groupBy("space", "part").cogroup(sample.groupBy("s_space", "s_part")).applyInPandas(deal, schema)


def _dealt(vectors: DataFrame, overlap: int, stage: Staging, name: str) -> tuple[DataFrame, DataFrame | None]:
    """(space, node, vector, home): every vector in its nearest shards; home marks the nearest of all. Then the rows of
    shards above LARGEST that splitting makes no smaller.
    """
    schema = f"space string, node long, vector {vectors.schema['vector'].dataType.simpleString()}, home boolean"
    dealt, done, level, before = vectors.withColumn("home", F.lit(True)), None, 0, None
    while True:
        sizes = dealt.groupBy("space").agg(F.count("*").alias("n"))
        large = stage.save(sizes.filter(F.col("n") > (SHARD if not level else LARGEST)), f"{name}-large-{level}")
        small = dealt.join(large, "space", "left_anti").select("space", "node", "vector", "home")
        done = small if done is None else done.unionByName(small)
        total, largest = large.agg(F.sum("n"), F.max("n")).first()
        if not total:
            return done, None
        rest = dealt.join(large, "space")
        if before is not None and largest > PROGRESS * before:
            return done, rest.select("space", "node", "vector")
        parts = _next_level(rest, level, overlap, schema) if level else _first_level(rest, total, overlap, schema)
        dealt = stage.save(parts, f"{name}-{level}")
        # A vector may come to a shard by two ways.
        dealt = dealt.groupBy("space", "node").agg(F.first("vector").alias("vector"), F.max("home").alias("home"))
        before = largest if level else None
        level += 1


def robust_prune(x: np.ndarray, point: int, order: np.ndarray, alpha: float = ALPHA, degree: int = DEGREE) -> list[int]:
    """Of ``order`` (nearest first) the neighbours that no kept one is ``alpha`` times closer to than the point is."""
    far = 1 - x[order] @ x[point]
    between = 1 - x[order] @ x[order].T
    kept: list[int] = []
    alive = order != point
    for i in range(len(order)):
        if alive[i]:
            kept.append(int(order[i]))
            if len(kept) == degree:
                break
            alive &= alpha * between[i] > far
    return kept


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    """The adjacency lists of a shard."""
    frame = frame.sort_values("node")
    x, nodes = _unit(frame["vector"]), frame["node"].to_numpy()
    lists = []
    for start in range(0, len(x), 512):
        near = x[start : start + 512] @ x.T
        width = min(CANDIDATES + 1, len(x))
        part = np.argpartition(-near, width - 1, axis=1)[:, :width]
        for row in range(len(near)):
            order = part[row][np.argsort(-near[row, part[row]], kind="stable")]
            lists.append(nodes[robust_prune(x, start + row, order)].tolist())
    return pd.DataFrame({"node": nodes, "near": lists})


def _searcher(beam: int, similarity: float):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node").reset_index(drop=True)
        x, nodes = _unit(frame["vector"]), frame["node"].to_numpy()
        edges: list[np.ndarray] = []
        for near in frame["near"]:
            at = np.searchsorted(nodes, near) if near is not None else np.zeros(0, int)
            ok = at < len(nodes)
            at = at[ok]
            edges.append(at[nodes[at] == np.asarray(near)[ok]] if len(at) else np.zeros(0, int))
        back: list[list[int]] = [[] for _ in nodes]
        for i, own in enumerate(edges):
            for j in own.tolist():
                back[j].append(i)
        edges = [np.union1d(own, np.array(other, int)).astype(int) for own, other in zip(edges, back, strict=True)]
        medoid = int((x @ x.mean(0)).argmax())
        found_a, found_b = [], []
        seen = np.full(len(x), -1)
        for q in np.flatnonzero(frame["home"].to_numpy()).tolist():
            for other in _range_search(x, edges, medoid, q, beam, similarity, seen):
                found_a.append(nodes[min(q, other)])
                found_b.append(nodes[max(q, other)])
        return pd.DataFrame({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})

    return search


def _range_search(
    x: np.ndarray, edges: list[np.ndarray], medoid: int, q: int, beam: int, similarity: float, seen: np.ndarray
) -> list[int]:
    """The vectors within range of ``q`` that greedy search from the medoid, and then all edges in range, reach."""
    query = x[q]
    pool = np.array([medoid])
    value = x[pool] @ query
    expanded: set[int] = set()
    seen[medoid] = q
    everything, values = [pool], [value]
    while True:
        order = np.argsort(-value, kind="stable")[:beam]
        pool, value = pool[order], value[order]
        open_ = [p for p in pool.tolist() if p not in expanded][:4]
        if not open_:
            break
        expanded.update(open_)
        new = np.unique(np.concatenate([edges[p] for p in open_]))
        new = new[seen[new] != q]
        if len(new):
            seen[new] = q
            near = x[new] @ query
            everything.append(new)
            values.append(near)
            pool, value = np.concatenate([pool, new]), np.concatenate([value, near])
    points, near = np.concatenate(everything), np.concatenate(values)
    waiting = [p for p in points[near >= similarity - SLACK].tolist() if p not in expanded]
    inside = points[near >= similarity].tolist()
    while waiting:
        new = np.unique(np.concatenate([edges[p] for p in waiting]))
        new = new[seen[new] != q]
        if not len(new):
            break
        seen[new] = q
        near = x[new] @ query
        inside += new[near >= similarity].tolist()
        waiting = new[near >= similarity - SLACK].tolist()
    return [p for p in inside if p != q]


def _found(vectors: DataFrame, overlap: int, beam: int, similarity: float, stage: Staging, name: str) -> DataFrame:
    """The linked pairs (a < b) that the search finds."""
    shards, stuck = _dealt(vectors, overlap, stage, name)
    shards = stage.save(shards, f"{name}-shards")
    lists = shards.groupBy("space").applyInPandas(lambda frame: _build(frame), "node long, near array<long>")
    united = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    graph = shards.join(stage.save(united, f"{name}-graph"), "node")
    pairs = graph.groupBy("space").applyInPandas(_searcher(beam, similarity), "a long, b long")
    if stuck is not None:
        stuck = stage.save(stuck, f"{name}-stuck")
        pairs = pairs.unionByName(true_links(stuck, stuck, similarity))
    return stage.save(pairs.distinct(), f"{name}-pairs")


def true_links(vectors: DataFrame, asked: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b), a < b: the links of the nodes ``asked`` with all rows of their space, compared in blocks of both."""
    blocks = vectors.groupBy("space").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    q_blocks = asked.groupBy("space").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q_blocks"))
    limits = blocks.join(q_blocks, "space")
    number = F.xxhash64("node")
    rows = vectors.join(limits, "space").withColumn("block", F.pmod(number, "blocks").cast("int"))
    rows = rows.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    queries = asked.join(limits, "space").withColumn("q_block", F.pmod(number, "q_blocks").cast("int"))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = queries.select("space", "block", "q_block", "node", "vector").toDF("q_space", "at", "part", "q_node", "q_vector")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        y, found = _unit(right["vector"]), []
        own, other = left["q_node"].to_numpy(), right["node"].to_numpy()
        for start in range(0, len(own), 256):
            i, j = np.nonzero(_unit(left["q_vector"].iloc[start : start + 256]) @ y.T >= similarity)
            found.append((own[start + i], other[j]))
        a, b = (np.concatenate(c) for c in zip(*found, strict=True))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b]

    blocked = rows.select("space", "block", "q_block", "node", "vector").groupBy("space", "block", "q_block")
    return queries.groupBy("q_space", "at", "part").cogroup(blocked).applyInPandas(compare, "a long, b long").distinct()


def recall(vectors: DataFrame, asked: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> tuple[int, int]:
    """How many links the nodes ``asked`` have, and how many were found."""
    true = true_links(vectors, asked, similarity)
    one = true.join(pairs.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count("*"), F.count("hit")).first()
    return int(one[0]), int(one[1])


def completed(vectors: DataFrame, asked: DataFrame, pairs: DataFrame, similarity: float, stage: Staging) -> DataFrame:
    """``pairs`` with every link of the spaces in which a link of the nodes ``asked`` is missing."""
    missed = true_links(vectors, asked, similarity).join(pairs, ["a", "b"], "left_anti").select(F.col("a").alias("node")).distinct()
    spaces = stage.save(vectors.join(missed, "node").select("space").distinct(), "missed")
    whole = stage.save(vectors.join(spaces, "space", "left_semi"), "compared-whole")
    return stage.save(pairs.unionByName(true_links(whole, whole, similarity)).distinct(), "completed-pairs")


def linked_vectors(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null label link when their cosine is at least ``similarity``; n_links counts the other rows linked
    directly, component_id is the smallest id reachable, kept marks the row that has it. A vector that is null, empty, zero or has a
    null or non-finite component links with nothing, nor does a row without id; vectors of different length do not
    link. Rows that repeat an id with the same vector and label count as links of each other. An empty table gives no rows.
    Equal vectors of a label are one node of the graph. Of the links of audited nodes at least FLOOR are found.
    """
    stage = staging(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("string").alias("label")
    )
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _valid(F.col("vector"))
    space = F.when(usable, F.concat_ws("/", F.size("vector").cast("string"), "label"))
    rows = stage.save(rows.withColumn("space", space).drop("label"), "rows")
    nodes = rows.filter("space is not null").groupBy("space", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    # An id may stand for several vectors, so a node has a number of its own.
    nodes = stage.save(nodes.withColumnRenamed("node", "name").withColumn("node", F.monotonically_increasing_id()), "nodes")
    graph = nodes.select("space", "node", "vector")
    asked = nodes.filter(F.col("name") % AUDITED == 0).select(*graph.columns)
    overlap, beam = OVERLAP, BEAM
    for round_ in range(ROUNDS):
        pairs = _found(graph, overlap, beam, similarity, stage, f"round-{round_}")
        links, hits = recall(graph, asked, pairs, similarity)
        if hits >= LEAST_RECALL * links:
            break
        overlap, beam = overlap + 1, beam * 2
    else:
        if hits < FLOOR * links:
            pairs = completed(graph, asked, pairs, similarity, stage)
    both = pairs.union(pairs.select("b", "a")).toDF("node", "other")
    copies = nodes.select(F.col("node").alias("other"), "copies")
    others = both.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("others"))
    joined = stage.save(components(pairs, stage), "components")
    named = nodes.drop("vector").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stage.save(named.join(others, "node", "left"), "named")
    smallest = stage.save(named.groupBy("component").agg(F.min("name").alias("component_id")), "smallest")
    named = named.join(smallest, "component").select(
        "node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id"
    )
    known = nodes.select("space", "vector", "node").join(named, "node").drop("node")
    known = stage.save(known, "known")
    return rows.join(known, ["space", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )

