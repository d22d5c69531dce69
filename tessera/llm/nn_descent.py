"""Embedding near-duplicates by NN-descent.

Vectors are compared within their label by cosine in double precision.  Equal vectors are
one class with a multiplicity and a number of its own.  Each class keeps a list of its ``K`` nearest
known classes, in labels of every size:

1. the lists start from a random-projection forest: in each tree the signs of a few fixed
   random directions name a leaf, and all classes of a leaf are compared with each other, large
   leaves block against block.  Two vectors at the threshold share a sign with probability
   1 - acos(threshold) / pi whatever the data, so the deeper the trees of a label, the more
   it gets: as many as let any one pair meet with probability ``MEET``;
2. a round brings together, for every class, its list, a sample of the lists that hold it,
   and itself; all of them are compared with each other (neighbours of neighbours) and every
   list keeps its best.  Rounds go on until few lists change;
3. where a list is saturated - all its entries are at the threshold or above - it may miss
   links.  The threshold edges found so far name connected components, and the lists are
   enlarged to all links inside the component, counted block against block;
4. recall is audited: the links of one class in ``AUDIT_SHARE`` of each label, and of at least
   about ``AUDIT`` classes (all of a smaller label), are counted by brute force against all vectors
   of the label.  While the found share, averaged over the linked classes of a label, is below
   ``MIN_RECALL``, K doubles, other trees are added to what is known and the rounds go on, ``RETRIES``
   times at most; a recall that is still lower then is told in a warning.  A label without a link in
   its sample rests on ``MEET`` alone.

Leaves, neighbourhoods and blocks are bounded, and so is what a task holds.  No pair is
written out in step 3, only counts and at most one edge a row and task.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and rows without label or vec_id link with nothing and are their own component (null without
a vec_id, kept then false); vectors of different lengths do not link; repeated rows are
vectors of their own, also several vectors under one vec_id; equal similarities are ordered by class;
vectors of any length fit, as blocks count rows; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, groups_of, read_table
from tessera.operators.sizing import materialise
from tessera.session import ship_package

THRESHOLD = 0.98
#: Trees of a label: at least TREES, and enough that a pair at the threshold meets with MEET.
K, TREES, LEAF, ROUNDS, MEET = 8, 4, 48, 3, 0.999
#: A round that changes fewer lists than this share is the last one.
CONVERGED = 0.01
#: Classes of a component that a task compares with as many others.
BLOCK = 512
AUDIT, AUDIT_SHARE, AUDIT_BLOCK, MIN_RECALL, GROW, RETRIES = 1000, 100, 4096, 0.99, 2, 5


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision (scaled down first, so no square overflows)."""
    x = raw.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def packed(vectors: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """vec_id, label, dim, vec (its doubles as bytes; null when it cannot link)."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.col(vec).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            out = []
            for ok, v in zip(b.column("label").is_valid().to_pylist(), b.column("v"), strict=True):
                x = None
                if ok and v.is_valid and len(v.values) and v.values.null_count == 0:
                    x = v.values.to_numpy(zero_copy_only=False)
                    x = (x + 0.0).tobytes() if np.isfinite(x).all() and x.any() else None
                out.append(x)
            vec = pa.array(out, pa.binary())
            dim = pa.array([None if x is None else len(x) // 8 for x in out], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), dim, vec],
                                             names=["vec_id", "label", "dim", "vec"])

    return rows.mapInArrow(run, "vec_id long, label string, dim int, vec binary")


def matrix(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("vec").to_pylist()), dtype=np.float64).reshape(table.num_rows, -1)


def compare(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(a, b, sim): for each group of (keys, id, worst, vec) and each of its classes the k best
    others that beat the worst entry of its list."""
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        for t in groups_of(batches, keys):
            if t.num_rows < 2:
                continue
            ids = t.column("id").to_numpy()
            worst = t.column("worst").to_numpy()
            x = unit(matrix(t))
            sim = x @ x.T
            sim[ids[:, None] == ids[None, :]] = -2
            few = min(k, len(ids) - 1)
            best = np.argpartition(-sim, few - 1, axis=1)[:, :few]
            value = np.take_along_axis(sim, best, axis=1)
            i, j = np.nonzero(value > worst[:, None])
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[best[i, j]]), pa.array(value[i, j])],
                                                 names=["a", "b", "sim"])

    return rows.mapInArrow(run, "a long, b long, sim double")


def forest_leaves(classes: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> DataFrame:
    """(label, dim, id, tree, leaf) of a random-projection forest; the number of trees follows
    the depth."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = F.greatest(F.lit(0), F.least(F.lit(40), F.ceil(F.log2(F.col("n") / leaf)))).cast("int")
    together = F.pow(F.lit(1 - math.acos(threshold) / math.pi), F.col("bits"))
    enough = F.ceil(math.log(1 - MEET) / F.log(1 - together))
    many = F.when(F.col("bits") == 0, F.lit(1)).otherwise(F.greatest(F.lit(trees), enough)).cast("int")
    sized = (classes.join(sizes.withColumn("bits", bits).withColumn("trees", many), ["label", "dim"])
             .select("label", "dim", "id", "vec", "bits", "trees"))

    def run(batches):
        for b in batches:
            dims, depth, grown = (b.column(c).to_numpy() for c in ("dim", "bits", "trees"))
            ids, vec = b.column("id").to_numpy(), b.column("vec").to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit(np.frombuffer(b"".join(vec[i] for i in at), dtype=np.float64).reshape(len(at), d))
                for t in range(grown[at].max()):
                    on = grown[at] > t
                    rows = at[on]
                    normal = np.random.default_rng((seed, t, int(d))).normal(size=(int(d), 40))
                    sign = (x[on] @ normal > 0).astype(np.int64) << np.arange(40)
                    code = np.where(np.arange(40) < depth[rows][:, None], sign, 0).sum(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("label").take(pa.array(rows)), pa.array(dims[rows], pa.int32()), pa.array(ids[rows], pa.int64()),
                         pa.array(np.full(len(rows), t), pa.int32()), pa.array(code, pa.int64())],
                        names=["label", "dim", "id", "tree", "leaf"])

    return materialise(sized.mapInArrow(run, "label string, dim int, id long, tree int, leaf long"), "rp-leaves", measure=False).df


def forest(classes: DataFrame, k: int, leaves: DataFrame) -> DataFrame:
    """First lists: all classes of each leaf compared, a large leaf block against block."""
    name = ["label", "dim", "tree", "leaf"]
    full = leaves.groupBy(*name).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (leaves.join(full, name).withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("id", "tree"), F.col("blocks")).cast("int")))
    # the task of two blocks also compares each of them within itself
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block")))
    tasks = (placed.withColumn("other", F.explode(others))
             .select(*name, "id", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    return compare(tasks.join(classes.select("id", "vec"), "id").withColumn("worst", F.lit(-2.0)), [*name, "i", "j"], k)


def keep_best(found: DataFrame, k: int) -> DataFrame:
    """(a, list): the k best entries of each class."""
    pairs = found.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return (pairs.withColumn("r", rank).where(F.col("r") <= k)
            .groupBy("a").agg(F.sort_array(F.collect_list(F.struct("sim", "b")), asc=False).alias("list")))


def descend(lists: DataFrame, classes: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of neighbours-of-neighbours comparisons."""
    lists = materialise(lists, "nn-lists", measure=False).df
    for r in range(rounds):
        edges = lists.select("a", F.explode("list").alias("e")).select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim"))
        pick = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(r))))
        back = edges.withColumn("r", pick).where(F.col("r") <= k).select(F.col("b").alias("u"), F.col("a").alias("id"))
        near = (edges.select(F.col("a").alias("u"), F.col("b").alias("id")).unionByName(back)
                .unionByName(lists.select(F.col("a").alias("u"), F.col("a").alias("id"))).distinct())
        worst = lists.select(F.col("a").alias("id"), F.when(F.size("list") >= k, F.element_at("list", -1)["sim"])
                             .otherwise(F.lit(-2.0)).alias("worst"))
        met = near.join(classes.join(worst, "id", "left").select("id", "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst")), "id")
        new = keep_best(edges.unionByName(compare(met, ["u"], k)), k)
        new = materialise(new, f"nn-round{r}", measure=False).df
        was = lists.select("a", F.transform("list", lambda x: x["b"]).alias("was"))
        total, changed = new.join(was, "a", "left").agg(
            F.count(F.lit(1)), F.sum((F.size(F.array_except(F.transform("list", lambda x: x["b"]),
                                                            F.coalesce("was", F.array().cast("array<long>")))) > 0).cast("long"))).first()
        lists = new
        if not total or (changed or 0) < CONVERGED * total:
            break
    return lists


def pair_counts(member: DataFrame, group: list[str], block: int, threshold: float) -> DataFrame:
    """(id, links, root): all classes of each group compared, block against block; for each
    class and task the rows linked to it there and one class it is connected with there."""
    sized = member.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    placed = (member.join(sized, group).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    spread = placed.select(*group, "id", "copies", "vec", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    keys = [*group, "i", "j"]
    tasks = (spread.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .select(*keys, "block", "id", "copies", "vec").repartition(*keys).sortWithinPartitions(*keys))

    def run(batches):
        for t in groups_of(batches, keys):
            ids, copies, part = (t.column(c).to_numpy() for c in ("id", "copies", "block"))
            x = unit(matrix(t))
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
            links, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
            for lo in range(0, len(left), BLOCK):
                rows = left[lo:lo + BLOCK]
                on = x[rows] @ x[right].T >= threshold
                if i == j:
                    on[np.arange(len(rows)), lo + np.arange(len(rows))] = False
                else:
                    links[right] += copies[rows] @ on
                links[rows] += on @ copies[right]
                for r in np.flatnonzero(on.any(axis=1)):
                    met = np.unique(np.append(root[right[on[r]]], root[rows[r]]))
                    if len(met) > 1:
                        root[np.isin(root, met)] = met[0]
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])],
                                             names=["id", "links", "root"])

    return tasks.mapInArrow(run, "id long, links long, root long")


def links_inside(classes: DataFrame, components: DataFrame, threshold: float) -> DataFrame:
    """(id, links): rows linked to each class inside its component, block against block."""
    member = classes.join(components.select(F.col("node").alias("id"), "component"), "id")
    return pair_counts(member, ["component"], BLOCK, threshold).groupBy("id").agg(F.sum("links").alias("links"))


def audit(classes: DataFrame, links: DataFrame, threshold: float) -> float:
    """Lowest label's share of links found, averaged over its sampled classes that have any."""
    name = ["label", "dim"]
    sizes = classes.groupBy(*name).agg(F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.lit(1), F.least(F.lit(AUDIT_SHARE), F.floor(F.col("n") / AUDIT)))
    rows = classes.join(sizes.withColumn("share", share), name)
    some = rows.where(F.pmod(F.xxhash64("id", F.lit("audit")), F.col("share")) == 0)
    i = F.ceil(F.col("n") / F.col("share") / AUDIT_BLOCK).cast("int")      # blocks of the sample and of all
    j = F.ceil(F.col("n") / AUDIT_BLOCK).cast("int")
    own = lambda n: F.pmod(F.xxhash64("id", F.lit("block")), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    keys = [*name, "i", "j"]
    asked = some.select(*name, own(i).alias("i"), every(j).alias("j"), F.lit(True).alias("asked"), "id", "copies", "vec")
    held = rows.select(*name, every(i).alias("i"), own(j).alias("j"), F.lit(False).alias("asked"), "id", "copies", "vec")
    tasks = asked.unionByName(held).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        for t in groups_of(batches, keys):
            ids, copies = (t.column(c).to_numpy() for c in ("id", "copies"))
            ask = t.column("asked").to_numpy()
            x = unit(matrix(t))
            to = np.flatnonzero(~ask)
            for lo in range(0, ask.sum(), BLOCK):
                at = np.flatnonzero(ask)[lo:lo + BLOCK]
                on = (x[at] @ x[to].T >= threshold) & (ids[at][:, None] != ids[to][None, :])
                yield pa.RecordBatch.from_arrays([t.column("label").take(pa.array(at)).combine_chunks(), t.column("dim").take(pa.array(at)).combine_chunks(),
                                                  pa.array(ids[at]), pa.array(on @ copies[to])], names=[*name, "id", "n"])

    true = (tasks.mapInArrow(run, "label string, dim int, id long, n long").groupBy(*name, "id").agg(F.sum("n").alias("n"))
            .where(F.col("n") > 0))
    got = true.join(links, "id", "left").withColumn("got", F.least("n", F.coalesce("links", F.lit(0))) / F.col("n"))
    lowest = got.groupBy(*name).agg(F.avg("got").alias("recall")).agg(F.min("recall")).first()[0]
    return 1.0 if lowest is None else lowest


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, k: int = K, key: str = "vec_id",
                    vec: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    ship_package(vectors.sparkSession)
    rows = materialise(packed(vectors, key, vec, label), "vectors", measure=False).df
    able = F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
    classes = rows.where(able).groupBy("label", "dim", "vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes", measure=False).df
    lists, tried = None, 0
    while True:
        met = forest(classes, k, forest_leaves(classes, threshold, seed=5 + tried))
        if lists is not None:
            met = met.unionByName(lists.select("a", F.explode("list").alias("e")).select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim")))
        lists = descend(keep_best(met, k), classes, k)
        near = lists.select("a", F.explode("list").alias("e")).where(F.col("e.sim") >= threshold)
        components = materialise(connected_components(near.select("a", F.col("e.b").alias("b")), "nn"), "nn-components", measure=False).df
        links = materialise(links_inside(classes, components, threshold), "nn-links", measure=False).df
        recall = audit(classes, links, threshold)
        if recall >= MIN_RECALL:
            break
        if tried == RETRIES:
            warnings.warn(f"near_duplicates: recall {recall:.4f} in the audit after {tried + 1} forests", stacklevel=2)
            break
        k, tried = k * GROW, tried + 1
    member = components.select(F.col("node").alias("id"), "component").join(classes.select("id", "rep"), "id")
    first = member.groupBy("component").agg(F.min("rep").alias("first"))
    named = member.join(first, "component").select("id", "first")
    info = (classes.join(named, "id", "left").join(links, "id", "left")
            .select("label", "dim", "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce("first", "rep").alias("component_id")))
    linked = rows.where(able).join(info, ["label", "dim", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~able).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id",
                                            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def embedding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
