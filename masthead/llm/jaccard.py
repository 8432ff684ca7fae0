"""Similarity join on word shingles with adaptive multi-match prefixes.

The shingles of a set of size n are put in an order that all sets share. Two sets that share t of them share at least l within
their first n - t + l, for every l. That is used twice:

1. In the order of the hashes. Each set sends a prefix, long enough for l = ``REACH`` * t, to the tasks that count in how
   many sets a shingle occurs. Only shingles found in two sets or more come back; a set with fewer of them than a
   partner needs has no partner and is done, which is what happens to nearly all texts.
2. Among these, rare ones first. Each set picks the number of matches k it asks for: a longer prefix costs more probes but fewer
   sets share k of its shingles, and the estimate uses the counts from step 1. Pairs that share the smaller of their k are verified
   on their whole sets.

Candidates are verified in two steps. First each set only with one set of each shingle, the most central and then some
others; sets found alike are joined to components. Then all remaining pairs that share enough, but only across components, as a further link
inside one changes nothing: there, prefixes are taken from the whole sets and only from shingles that occur in several
components. Equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masthead.llm.common import components, slabs, staging, utf8
from masthead.llm.shingles import fingerprints, shingle_sets
from masthead.sources.staging import Staging

PERCENT = 75  # similarity of linked texts
REACH = 0.2  # matches asked for in the first step, as a share of the least overlap
CENTRAL_ROUNDS = 2  # of the first kind of candidates, at most
CENTRES = 4  # sets per group picked in a round
SIZE_STEP = 1.05  # ratio of neighbouring classes of set sizes
MOST_MATCHES = 8  # largest k tried
VERIFY_COST = 20  # cost of verifying a candidate, in probes
POSTINGS = 1_000_000  # of a bucket, and of a task's buffer
COMMON_SHARE = 0.01  # shingles in more of a batch's texts are reported as possibly common
MOST_COMMON = 100_000  # a common shingle has more than one in so many of all postings
EVERYWHERE = 2**31 - 1

_PROFILE = "doc_id long, n long, node long, second long, common array<struct<token:long,n:long>>"


def _least(n: Column) -> Column:
    """The overlap that a set of size n must have with any partner."""
    return F.ceil(n * PERCENT / 100)


def first_prefix(n: np.ndarray | int):
    """Length of the first step's prefix, and the matches a partner of any size then has in it at least."""
    least = -(-n * PERCENT // 100)
    matches = np.maximum(1, np.ceil(REACH * least)).astype(np.int64)
    smallest = -(-least * PERCENT // 100)
    return n - least + matches, np.maximum(1, np.ceil(REACH * smallest)).astype(np.int64)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, limits = utf8(batch.column(1))
    for first, last in slabs(limits):
        yield first, last, *shingle_sets(data[limits[first] : limits[last]], limits[first : last + 1] - limits[first])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and fingerprints of each text's set; the first row of a batch also has the batch's common shingles."""
    for batch in batches:
        sizes, nodes, seconds, often = [], [], [], []
        for _, _, tokens, limits in _sets(batch):
            own = fingerprints(tokens, limits)
            sizes.append(np.diff(limits))
            nodes.append(own[0].view(np.int64))
            seconds.append(own[1].view(np.int64))
            value, count = np.unique(tokens, return_counts=True)
            often.append((value[count > 1], count[count > 1]))
        value = np.concatenate([v for v, _ in often]) if often else np.zeros(0, np.uint64)
        value, index = np.unique(value, return_inverse=True)
        count = np.bincount(index, np.concatenate([c for _, c in often]) if often else None, len(value)).astype(np.int64)
        many = count >= max(20, COMMON_SHARE * len(batch))
        found = [{"token": int(t), "n": int(c)} for t, c in zip(value[many].view(np.int64), count[many], strict=True)]
        common = pa.array([found, *[None] * (len(batch) - 1)][: len(batch)], pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())])))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (sizes, nodes, seconds)), common],
            ["doc_id", "n", "node", "second", "common"],
        )


def _buckets(texts: DataFrame, buckets: int, common: list[int]) -> DataFrame:
    """(bucket, blob) rows of 13-byte postings: the low 40 bits of a shingle, the node it occurs in.

    Common shingles go, with their node, to buckets dealt by node, as there is nothing to count about them.
    """
    known = np.array(sorted(common), np.int64).view(np.uint64)
    known.sort()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            token = np.concatenate([t for t, _ in held])
            node = np.concatenate([n for _, n in held])
            held.clear()
            bucket = ((token >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                everywhere = known[at] == token
                bucket[everywhere] = buckets + (node[everywhere] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            record = np.empty((len(order), 13), np.uint8)
            record[:, :5] = token[order].view(np.uint8).reshape(-1, 8)[:, :5]
            record[:, 5:] = node[order].view(np.uint8).reshape(-1, 8)
            name, start = np.unique(bucket[order], return_index=True)
            ends = [*start[1:].tolist(), len(order)]
            blobs = [record[a:b].tobytes() for a, b in zip(start.tolist(), ends, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(name, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for batch in batches:
            for _, _, tokens, limits in _sets(batch):
                sizes = np.diff(limits)
                nodes = fingerprints(tokens, limits)[0]
                fresh = np.zeros(len(sizes), bool)
                for i, node in enumerate(nodes.tolist()):
                    if sizes[i] and node not in seen:
                        seen.add(node)
                        fresh[i] = True
                length = np.where(fresh, first_prefix(sizes)[0], 0)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                inside = np.arange(len(tokens)) - limits[owner] < length[owner]
                held.append((tokens[inside], nodes[owner[inside]]))
            if sum(len(t) for t, _ in held) >= POSTINGS:
                yield flush()
        if sum(len(t) for t, _ in held):
            yield flush()

    return texts.mapInArrow(run, "bucket int, blob binary")


def _repeated(postings: DataFrame, buckets: int) -> DataFrame:
    """(node, token, df) of shingles that occur in two nodes or more; df is the number of nodes."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        record = np.frombuffer(b"".join(group.column("blob").to_pylist()), np.uint8).reshape(-1, 13)
        wide = np.zeros((len(record), 8), np.uint8)
        wide[:, :5] = record[:, :5]
        token = wide.view(np.uint64).ravel()
        node = np.ascontiguousarray(record[:, 5:]).view(np.int64).ravel()
        order = np.argsort(token)
        token, node = token[order], node[order]
        if bucket < buckets:
            same = np.zeros(len(token) + 1, bool)
            same[1:-1] = token[1:] == token[:-1]
            again = same[1:] | same[:-1]
            token, node = token[again], node[again]
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        new = np.ones(len(token), bool)  # copies of a text in several tasks count once
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node = token[new], node[new]
        _, index, count = np.unique(token, return_inverse=True, return_counts=True)
        df = count[index] if bucket < buckets else np.full(len(token), EVERYWHERE)
        kept = df > 1
        mark = np.uint64((bucket if bucket < buckets else buckets) << 40)
        return pa.table(
            {
                "node": node[kept],
                "token": (token[kept] + mark).view(np.int64),
                "df": pa.array(df[kept], pa.int32()),
            }
        )

    return postings.groupBy("bucket").applyInArrow(run, "node long, token long, df int")


def _prefixes(found: DataFrame) -> DataFrame:
    """(node, n, k, token, ...): the rarest shingles of each row's ``found`` (df, token), in which a partner must have k.

    ``found`` holds what can be shared with a partner at all, and a partner has ``needed`` of it: rows with fewer go. Which k pays
    is estimated from the counts: probes for a longer prefix, and verifications of what shares k of it.
    """
    return (
        found.withColumn("spare", F.size("found") - F.col("needed"))
        .filter("spare >= 0")
        .withColumn(
            "k",
            F.expr(
                f"""array_min(transform(sequence(1, int(least({MOST_MATCHES}, needed))), k -> struct(
                aggregate(slice(found, 1, int(spare) + k), 0d, (a, x) -> a + x.df - 1) * (1 + {VERIFY_COST} / k) as cost, k as k))).k"""
            ),
        )
        .withColumn("token", F.explode(F.expr("slice(found, 1, int(spare) + k).token")))
        .drop("found", "spare", "needed")
    )


def _first_found(repeated: DataFrame, classes: DataFrame) -> DataFrame:
    """The repeated shingles of each set's first prefix; hub is the mean of their counts, the highest where all is shared."""
    found = repeated.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    least = _least(F.col("n"))
    matches = F.greatest(F.lit(1), F.ceil(F.lit(REACH) * least))
    needed = F.greatest(F.lit(1), F.ceil(F.lit(REACH) * _least(least)))
    hub = F.expr("aggregate(found, 0d, (a, x) -> a + x.df)") / (F.col("n") - least + matches)
    return found.join(classes.select("node", "n"), "node").select("node", "n", "found", needed.alias("needed"), hub.alias("hub"))


def _sized(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("shared", shared)
        .filter(F.col("shared") * 100 >= (F.size("left") + F.size("right") - F.col("shared")) * PERCENT)
        .select("a", "b")
    )


def _whole_sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, tokens, limits in _sets(batch):
                nodes = fingerprints(tokens, limits)[0].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(nodes), lists], ["node", "tokens"])

    chosen = texts.join(wanted, "doc_id", "left_semi")
    return chosen.mapInArrow(run, "node long, tokens array<long>")


def _size_class(n: Column) -> Column:
    """The largest power of SIZE_STEP that is at most n, as exponent."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(SIZE_STEP)) + 1e-9)


def _candidates(prefixes: DataFrame, other: DataFrame, condition: Column, on: tuple | list = ("token",)) -> DataFrame:
    """Pairs (a, b) that share the smaller of their k; ``other`` has node_b, n_b and k_b."""
    return (
        prefixes.join(other, list(on))
        .filter(condition & _sized(F.col("n"), F.col("n_b")))
        .groupBy(F.col("node").alias("a"), F.col("node_b").alias("b"))
        .agg(F.count("*").alias("c"), F.first(F.least("k", "k_b")).alias("k"))
        .filter("c >= k")
        .select("a", "b")
    )


def _links(texts: DataFrame, classes: DataFrame, total: int, common: list[int], stage: Staging) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    buckets = max(128, int(total * 0.4) // POSTINGS)
    repeated = _repeated(_buckets(texts, buckets, common), buckets)
    prefixes = stage.save(_prefixes(_first_found(repeated, classes)), "prefixes")
    wanted = classes.join(prefixes.select("node").distinct(), "node", "left_semi").select("doc_id")
    sets = stage.save(_whole_sets(texts, wanted), "sets")

    found = stage.save(prefixes.withColumn("component", F.col("node")), "components-0")
    links = None
    for number in range(CENTRAL_ROUNDS):
        # The most central set of a shingle first, then some picked at random: large groups of similar sets come together.
        first = F.col("hub") if not number else F.xxhash64("node", F.pmod("token", F.lit(CENTRES)), F.lit(number))
        top = found.groupBy("token").agg(F.max(F.struct(first, "node", "n", "k", "component")).alias("top"), F.count("*").alias("c"))
        names = ("node", "n", "k", "component")
        top = top.filter("c > 1").select("token", *[F.col(f"top.{c}").alias(f"{c}_b") for c in names])
        near = _candidates(found, stage.save(top, f"centres-{number}"), F.col("component") != F.col("component_b"))
        own = stage.save(_verified(near, sets), f"central-links-{number}")
        if own.isEmpty() and number:
            break
        links = own if links is None else links.union(own)
        joined = components(links, stage, f"central-{number}").toDF("node", "component")
        found = prefixes.join(stage.save(joined, f"joined-{number}"), "node", "left")
        found = stage.save(found.withColumn("component", F.coalesce("component", "node")), f"components-{number + 1}")

    # What is left lies across components. Only shingles that occur in several of them can be shared there, and of these a set
    # must have as many as it must share, which leaves few sets; their whole sets are put in order anew.
    span = [F.min("component").alias("low"), F.max("component").alias("high")]
    several = stage.save(found.groupBy("token").agg(*span).filter("low < high").select("token"), "spanning")
    open_ = stage.save(found.join(several, "token", "left_semi").select("node", "n", "component").distinct(), "open")
    tokens = stage.save(open_.join(sets.dropDuplicates(["node"]), "node").withColumn("token", F.explode("tokens")).drop("tokens"), "open-sets")
    # The closer two sizes are, the more must be shared: partners are looked for by class of size.
    tokens = tokens.withColumn("size", _size_class(F.col("n")))
    each = tokens.groupBy("token", F.col("size").alias("size_b")).agg(F.count("*").alias("df"), *span)
    every = each.groupBy("token").agg(F.sum("df").alias("df"), F.min("low").alias("from"), F.max("high").alias("to"))
    each = each.drop("df").join(every.filter("from < to").drop("from", "to"), "token")
    apart = (F.col("low") != F.col("component")) | (F.col("high") != F.col("component"))
    within = F.col("size_b").between(_size_class(_least(F.col("n"))), _size_class(F.floor(F.col("n") * 100 / PERCENT)))
    found = tokens.join(stage.save(each, "spanning-in-open"), "token").filter(apart & within)
    found = found.groupBy("node", "n", "component", "size", "size_b")
    found = found.agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    smallest = F.greatest(_least(F.col("n")), F.ceil(F.pow(F.lit(SIZE_STEP), F.col("size_b")) - 1e-6))
    needed = F.greatest(_least(F.col("n")), F.ceil((F.col("n") + smallest) * PERCENT / (100 + PERCENT)))
    rest = stage.save(_prefixes(found.withColumn("needed", needed)), "rest")
    other = rest.select("token", F.col("size").alias("size_b"), F.col("size_b").alias("size"), *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "k", "component")])
    far = _candidates(rest, other, F.col("component") < F.col("component_b"), ["token", "size", "size_b"])
    return components(links.union(_verified(far, sets)), stage, "all")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when their sets of 5-word shingles have a Jaccard similarity of 0.75 or more; component_id is the smallest
    id reachable by links. Null, empty and blank texts have no shingles and no links. Rows that repeat an id share it: they
    are texts of their own, and a component is named by the smallest id of its texts. A row without id has no
    component and links with nothing. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stage = staging(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stage.save(texts.mapInArrow(_profile, _PROFILE), "profile")
    texts = texts.filter("doc_id is not null")
    key = ["node", "second", "n"]
    classes = rows.filter("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("doc_id"))
    classes = stage.save(classes, "classes")
    total = rows.agg(F.sum("n")).first()[0] or 0
    often = rows.select(F.explode("common").alias("c")).groupBy("c.token").agg(F.sum("c.n").alias("n"))
    # A text's shingles are distinct, so at most MOST_COMMON shingles can be this frequent.
    common = [r["token"] for r in often.filter(F.col("n") > max(POSTINGS, total // MOST_COMMON)).select("token").collect()]
    linked = stage.save(_links(texts, classes, total, common, stage), "linked")
    named = classes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stage.save(named, "named")
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stage.save(named.join(stage.save(smallest, "smallest"), "component").select(*key, "component_id"), "classes-named")
    return rows.drop("common").join(named, key, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
