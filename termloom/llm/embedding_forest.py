"""Near-duplicate vectors by a forest of random-projection trees with spill.

Trees are fitted on a bounded sample; every vector is then routed through every tree. At a node it
goes to the side of its projection, or to both if it lies close to the split. Vectors that meet in a
leaf of any tree are compared exactly. Leaves above a bound are compared in blocks spread over tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.components import components
from termloom.llm.storage import sampled, spread, stored

#: Vectors from which the splits are taken (collected, so bounded).
SAMPLE = 20_000
TREES = 14
LEAF = 256
#: Width of the strip that goes to both sides, in standard deviations of the projections.
SPILL = 0.3
#: Vectors per block of a leaf that is compared in parts.
BLOCK = 1024
SEED = 20


def fit_forest(points: np.ndarray, depth: int, trees: int, spill: float, seed: int) -> list[dict]:
    """Per tree: node number -> (direction, split, half width); children of node i are 2i and 2i+1."""
    rng, forest = np.random.default_rng(seed), []
    for _ in range(trees):
        nodes, todo = {}, [(1, np.arange(len(points)))]
        while todo:
            node, own = todo.pop()
            if node.bit_length() > depth:
                continue
            way = rng.normal(size=points.shape[1])
            way /= np.linalg.norm(way)
            along = points[own] @ way if len(own) else np.zeros(1)
            split, half = float(np.median(along)), float(spill * along.std())
            nodes[node] = (way, split, half)
            if len(own):
                todo += [(2 * node, own[along <= split + half]), (2 * node + 1, own[along >= split - half])]
            else:
                todo += [(2 * node, own), (2 * node + 1, own)]
        forest.append(nodes)
    return forest


def leaves_of(points: np.ndarray, nodes: dict) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows) of a tree; a row may lie in several leaves."""
    out, todo = [], [(1, np.arange(len(points)))]
    while todo:
        node, own = todo.pop()
        if not len(own):
            continue
        if node not in nodes:
            out.append((node, own))
            continue
        way, split, half = nodes[node]
        along = points[own] @ way
        todo += [(2 * node, own[along <= split + half]), (2 * node + 1, own[along >= split - half])]
    return out


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _route(shared):
    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 2000):
                part = pdf.iloc[at : at + 2000]
                for width, same in part.groupby(part.embedding.map(len)):
                    forest = shared.value.get(width, [{}])  # a length without trees is one leaf, compared in blocks
                    points = _unit(same.embedding)
                    for tree, nodes in enumerate(forest):
                        for leaf, rows in leaves_of(points, nodes):
                            some = same.iloc[rows]
                            yield pd.DataFrame({"label": some.label, "tree": tree, "leaf": leaf, "rep": some.rep, "embedding": some.embedding})

    return run


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, same in pdf.groupby(pdf.embedding.map(len)):
            left, right = same[same.side == 0], same[same.side == 1]
            if right.empty:
                right = left
            if left.empty:
                continue
            x, y = _unit(left.embedding), _unit(right.embedding)
            ids, others = left.rep.to_numpy(), right.rep.to_numpy()
            i, j = np.nonzero(x @ y.T >= threshold)
            a, b = np.minimum(ids[i], others[j]), np.maximum(ids[i], others[j])
            found.append(pd.DataFrame({"a": a, "b": b})[a < b])
        return pd.concat(found).drop_duplicates() if found else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return run


def link_vectors(vectors: DataFrame, threshold: float = 0.93, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors of one label link at cosine >= threshold. A NULL or zero vector, one with NULL or
    non-finite parts, and one without label link with nothing. Equal vectors are one class and all
    linked. Vectors of different length never link. vec_id must not repeat; an empty table gives no
    row; other columns are ignored.
    """
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "embedding", "label")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    valid = vectors.filter("label is not null and embedding is not null").filter(fine & some)
    valid = spread(valid).withColumn("embedding", F.col("embedding").cast("array<double>"))
    valid = valid.withColumn("k", F.xxhash64("embedding")).withColumn("k2", F.hash("embedding"))
    classes = valid.groupBy("label", "k", "k2").agg(F.min(F.struct("vec_id", "embedding")).alias("m"), F.count("*").alias("size"))
    classes = stored(classes.select("label", "k", "k2", F.col("m.vec_id").alias("rep"), F.col("m.embedding").alias("embedding"), "size"))

    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    depth = max(0, math.ceil(math.log2(most / leaf)))
    share = SAMPLE / max(1, classes.count())
    sample = classes.filter(sampled(share, SEED, "rep")).select("embedding")  # about SAMPLE rows
    widths: dict[int, list] = {}
    for row in sample.collect():
        widths.setdefault(len(row.embedding), []).append(row.embedding)
    for width in [r[0] for r in classes.select(F.size("embedding")).distinct().limit(100).collect()]:
        widths.setdefault(width, [])
    forests = {w: fit_forest(_unit(rows) if rows else np.zeros((0, w)), depth, trees, spill, SEED) for w, rows in widths.items()}
    shared = spark.sparkContext.broadcast(forests)

    label = vectors.schema["label"].dataType.simpleString()
    routed = classes.select("label", "rep", "embedding").mapInPandas(_route(shared), f"label {label}, tree int, leaf long, rep long, embedding array<double>")
    routed = stored(routed)
    sizes = routed.groupBy("label", "tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    parts = routed.join(sizes, ["label", "tree", "leaf"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parts = parts.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    parts = parts.withColumn("side", F.when(F.col("own") == F.col("i"), 0).otherwise(1))
    links = parts.groupBy("label", "tree", "leaf", "i", "j").applyInPandas(_compare(threshold), "a long, b long").distinct()
    links = stored(links)

    comps = components(links)
    sizes = classes.select("rep", "size")
    both = links.union(links.select("b", "a")).join(sizes.withColumnRenamed("rep", "b"), "b")
    degree = both.groupBy("a").agg(F.sum("size").alias("others")).withColumnRenamed("a", "rep")
    named = classes.join(degree, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("label", "k", "k2", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    mine = valid.select("vec_id", "label", "k", "k2").join(named, ["label", "k", "k2"]).select("vec_id", "links", "component")
    out = vectors.select("vec_id").join(mine, "vec_id", "left")
    root = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), root.alias("component_id"), (F.col("vec_id") == root).alias("kept"))
