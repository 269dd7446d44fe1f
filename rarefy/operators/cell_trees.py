"""Forests and boosted trees of MLlib, grown from cells in tasks of their own.

MLlib grows a tree level by level, each a job over all partitions: a boosted model of a hundred rounds is some
thousand jobs, and a forest holds a draw per row and tree. Cells (``cells.py``) are bounded by the bins, so a task holds
all of them and grows whole trees: a forest's side by side, a boosted model's one after the other. The splits are
MLlib's: largest fall of impurity over all bins (of a node's drawn features in a forest), as deep as ``maxDepth``.
A forest draws Poisson(rows) for a cell and tree, the sum of a Poisson(1) draw for each of its rows.

The nodes are written as MLlib saves them, and the model is loaded from there.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame

from ..session import checkpoint_dir, ship_package

#: more cells than these are left to MLlib (a task holds some 100 bytes of a cell)
FOREST_CELLS, BOOST_CELLS = 2_000_000, 400_000
#: trees that a task of a forest grows, about
TASK_TREES = 5

NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                   ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)])
_ROW = pa.schema([("treeID", pa.int32()), ("nodeData", _NODE)])


def _grown(bins, w, r, count, n_bins, depth, choose=None):
    """(nodes of one tree, each row's leaf). A node: [sum w, sum w r, sum w r r, rows, gain, feature, bin, left, right]; the
    split is the one after which the sum of squares about the mean of r is the least. ``choose``: features of k nodes, as a mask."""
    d, n = bins.shape
    wr = w * r
    nodes, leaf = [], np.zeros(n, np.int64)
    rows, at, ids = np.arange(n), np.zeros(n, np.int64), np.zeros(1, np.int64)  # rows that go on, their node's place in the level, its nodes
    nodes.append(None)
    for level in range(depth + 1):
        k = len(ids)
        sw, sr, srr, sn = (np.bincount(at, x, k) for x in (w, wr, wr * r, count))
        best, feature, cut = np.zeros(k), np.full(k, -1), np.zeros(k, np.int64)
        impure = srr / sw - (sr / sw) ** 2 > np.finfo(float).eps
        if level < depth and impure.any():
            mask = choose(k) if choose else None
            for j in range(d):
                key = at * n_bins + bins[j]
                lw = np.cumsum(np.bincount(key, w, k * n_bins).reshape(k, n_bins), 1)[:, :-1]
                lr = np.cumsum(np.bincount(key, wr, k * n_bins).reshape(k, n_bins), 1)[:, :-1]
                rw, rr = sw[:, None] - lw, sr[:, None] - lr
                ok = (lw > 1e-9 * sw[:, None]) & (rw > 1e-9 * sw[:, None])
                if mask is not None:
                    ok &= mask[:, j, None]
                gain = np.where(ok, lr ** 2 / np.where(ok, lw, 1.0) + rr ** 2 / np.where(ok, rw, 1.0), -math.inf)
                b = gain.argmax(1)
                g = (gain[np.arange(k), b] - sr ** 2 / sw) / sw
                more = impure & (g > best + 1e-15) & np.isfinite(g)
                best[more], feature[more], cut[more] = g[more], j, b[more]
        splits = feature >= 0
        first = len(nodes) + 2 * (np.cumsum(splits) - splits)
        for i in range(k):
            kids = (int(first[i]), int(first[i]) + 1) if splits[i] else (-1, -1)
            nodes[ids[i]] = [sw[i], sr[i], srr[i], int(sn[i]), float(best[i]), int(feature[i]), int(cut[i]), *kids]
        nodes += [None] * (2 * int(splits.sum()))
        leaf[rows] = ids[at]
        if not splits.any():
            break
        on = splits[at]
        if not on.all():
            rows, at, w, wr, r, count, bins = rows[on], at[on], w[on], wr[on], r[on], count[on], bins[:, on]
        right = bins[feature[at], np.arange(len(at))] > cut[at]
        at = 2 * (np.cumsum(splits) - splits)[at] + right
        ids = (first[splits][:, None] + np.array([0, 1])).ravel()
    return nodes, leaf


def _saved_nodes(tree: int, nodes, present, gini: bool):
    """A tree's nodes as MLlib saves them: in preorder, and with two leaves of one class as one leaf in a forest."""
    out = []

    def told(node):
        sw, sr, srr, n = node[:4]
        p = sr / sw
        if gini:
            return float(sr > sw - sr), 2 * p * (1 - p), [sw - sr, sr], n
        return p, max(srr / sw - p * p, 0.0), [sw, sr, srr], n

    def merged(i):
        """The class of a subtree whose leaves all have it, else None."""
        node = nodes[i]
        if node[5] < 0:
            return told(node)[0]
        a, b = merged(node[7]), merged(node[8])
        if gini and a is not None and a == b:
            node[5] = -1
            return a
        return None

    def put(i):
        node, at = nodes[i], len(out)
        prediction, impurity, stats, n = told(node)
        row = dict(id=at, prediction=prediction, impurity=impurity, impurityStats=stats, rawCount=n)
        out.append(dict(treeID=tree, nodeData=row))
        if node[5] < 0:
            row.update(gain=-1.0, leftChild=-1, rightChild=-1, split=dict(featureIndex=-1, leftCategoriesOrThreshold=[], numCategories=-1))
            return
        low, high = node[6], present[node[5]]
        high = high[high > low][0]  # the next bin that cells have; the cut is half way, as MLlib's
        row.update(gain=node[4] * (2 if gini else 1), split=dict(featureIndex=node[5], leftCategoriesOrThreshold=[(low + high) / 2], numCategories=-1))
        row["leftChild"] = len(out)
        put(node[7])
        row["rightChild"] = len(out)
        put(node[8])

    merged(0)
    put(0)
    return pa.RecordBatch.from_pylist(out, schema=_ROW)


def _forest(cells, cfg):
    def f(batches):
        bins, y, w, count = cells.value
        present = [np.unique(b) for b in bins]
        d, n_bins = len(bins), int(bins.max()) + 2
        few = math.ceil(math.sqrt(d))
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                rng = np.random.default_rng([cfg["seed"], tree])
                drawn = rng.poisson(count)
                on = np.flatnonzero(drawn)
                if not len(on):
                    drawn, on = count, np.arange(len(count))

                def choose(k, rng=rng):
                    return rng.random((k, d)).argsort(1).argsort(1) < few
                got = drawn[on]
                nodes, _ = _grown(bins[:, on], w[on] / count[on] * got, y[on], got, n_bins, cfg["depth"], choose)
                yield _saved_nodes(tree, nodes, present, True)
    return f


def _boosted(cells, cfg):
    def f(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y, w, count = cells.value
            present = [np.unique(b) for b in bins]
            n_bins = int(bins.max()) + 2
            sign = 2 * y - 1
            score, r = np.zeros(len(y)), sign
            for tree in range(cfg["rounds"]):
                nodes, leaf = _grown(bins, w, r, count, n_bins, cfg["depth"])
                yield _saved_nodes(tree, nodes, present, False)
                score += (1.0 if tree == 0 else cfg["step"]) * np.array([v[1] / v[0] for v in nodes])[leaf]
                r = 4 * sign / (1 + np.exp(2 * sign * score))  # minus the gradient of 2 log(1 + exp(-2 y F))
    return f


def suits(est, kind: str, n_cells: int) -> bool:
    """Whether the estimator's parameters and the number of cells are those grown here."""
    if n_cells > (FOREST_CELLS if kind == "rf" else BOOST_CELLS) or est.getMinInstancesPerNode() != 1 or est.getMinInfoGain() != 0 \
            or est.getMinWeightFractionPerNode() != 0 or est.getSubsamplingRate() != 1.0 or est.getMaxDepth() < 1:
        return False
    if kind == "rf":
        return est.getFeatureSubsetStrategy() == "auto" and est.getNumTrees() > 1 and est.getBootstrap() and est.getImpurity() == "gini"
    return est.getFeatureSubsetStrategy() == "all"


def _metadata(cls: str, spark, uid: str, est=None, **more) -> str:
    """Metadata as MLlib saves it."""
    plain = {} if est is None else {p.name: v for p, v in est._paramMap.items()}
    default = {} if est is None else {p.name: v for p, v in est._defaultParamMap.items()}
    return json.dumps({"class": f"org.apache.spark.ml.{cls}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                       "uid": uid, "paramMap": plain, "defaultParamMap": default, **more})


def grow(est, kind: str, cells: DataFrame, features, label: str, seed: int):
    """The fitted MLlib model of ``est`` (its featuresCol being the assembled ``features``); cells: label (0 or 1), features (bins), _w, _n."""
    spark = cells.sparkSession
    ship_package(spark)
    table = cells.select(label, "_w", "_n", *features).toArrow()
    bins = np.array([table.column(f).to_numpy() for f in features]).astype(np.uint8)
    y, w, count = (table.column(c).to_numpy().astype(t) for c, t in ((label, float), ("_w", float), ("_n", np.int64)))
    order = np.lexsort([y, *bins[::-1]])  # draws go by place, whatever the order that cells come in
    held = spark.sparkContext.broadcast((np.ascontiguousarray(bins[:, order]), y[order], w[order], count[order]))
    path = os.path.join(checkpoint_dir(spark), "rarefy-trees", uuid.uuid4().hex)
    try:
        if kind == "rf":
            trees = est.getNumTrees()
            tasks = max(1, min(trees, max(spark.sparkContext.defaultParallelism, -(-trees // TASK_TREES))))
            grown = _forest(held, {"seed": seed, "depth": est.getMaxDepth()})
        else:
            trees, tasks = est.getMaxIter(), 1
            grown = _boosted(held, {"rounds": trees, "depth": est.getMaxDepth(), "step": est.getStepSize()})
        spark.range(0, trees if kind == "rf" else 1, 1, tasks).mapInArrow(grown, NODES).write.parquet(os.path.join(path, "data"))
    finally:
        held.unpersist()
    cls, tree_cls, model = ("RandomForestClassificationModel", "classification.DecisionTreeClassificationModel", RandomForestClassificationModel) if kind == "rf" \
        else ("GBTClassificationModel", "regression.DecisionTreeRegressionModel", GBTClassificationModel)
    more = {"numClasses": 2} if kind == "rf" else {}
    sub = dict(more, numFeatures=len(features))
    spark.createDataFrame([(t, _metadata(tree_cls, spark, f"tree_{uuid.uuid4().hex[:12]}", **sub), 1.0 if kind == "rf" or t == 0 else est.getStepSize()) for t in range(trees)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(os.path.join(path, "treesMetadata"))
    spark.createDataFrame([(_metadata(f"classification.{cls}", spark, est.uid, est, numFeatures=len(features), numTrees=trees, **more),)],
                          "value string").coalesce(1).write.text(os.path.join(path, "metadata"))
    return model.load(path)
