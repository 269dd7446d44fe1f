"""Logistic regressions of many parameter classes and folds, fitted in the same passes over the rows.

MLlib fits one model at a time in up to a hundred short jobs, and sorts all rows anew for each ROC-AUC. Here
a pass sums loss, gradient and Hessian of all models that aren't done, and the driver takes a Newton step of each
(to the least of its quadratic model with the penalty where that has an L1 part). The objective is MLlib's: weighted mean of the logistic
loss, penalty on the coefficients of standardised features (weighted standard deviation of the model's training rows),
none on the intercept. It is convex, and the steps go on until none lowers it by more than ``TOL``.

ROC-AUC is exact: the scores of a model are dealt out by value, ties together, and pairs are counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: rows of a block, values of an array within a pass, scores that a task holds at once
BLOCK_ROWS, ARRAY_VALUES, TASK_SCORES = 8192, 1 << 19, 1 << 24
#: sums of a pass at most (doubles); beyond, models are fitted by MLlib
MOST_SUMS = 1 << 22
#: rows that the cuts between score ranges come from, and scores of a range, about
CUT_ROWS, RANGE_SCORES = 20_000, 500_000
TOL, MOST_PASSES, MOST_SWEEPS = 1e-12, 100, 300


def _pack(batches):
    for b in batches:
        x = b.column("x")
        values = x.flatten().to_numpy(zero_copy_only=False).astype("<f8", copy=False)
        d = len(values) // max(1, b.num_rows)
        group = b.column("g").to_numpy(zero_copy_only=False).astype("u1")
        starts = range(0, b.num_rows, BLOCK_ROWS)
        yield pa.RecordBatch.from_arrays([
            pa.array([group[i:i + BLOCK_ROWS].tobytes() for i in starts], pa.binary()),
            pa.array([values[i * d:(i + BLOCK_ROWS) * d].tobytes() for i in starts], pa.binary())], ["g", "x"])


def _unpack(rows):
    for r in rows:
        g = np.frombuffer(r[0], "u1")
        yield g, np.frombuffer(r[1], "<f8").reshape(len(g), -1)


def _blocks(folded: DataFrame, label: str):
    """RDD of (group, features): a row's group is twice its fold and its class."""
    rows = folded.select((F.col("fold") * 2 + F.col(label).cast("int")).cast("int").alias("g"), vector_to_array("features").alias("x"))
    packed = rows.mapInArrow(_pack, "g binary, x binary")
    cores = folded.sparkSession.sparkContext.defaultParallelism
    if folded.rdd.getNumPartitions() < cores:
        packed = packed.repartition(cores)
    return packed.rdd.mapPartitions(_unpack).persist(StorageLevel.MEMORY_AND_DISK)


def _merged(a, b):
    """Count, mean and squared deviations of two sets of rows."""
    n = a[0] + b[0]
    if not b[0]:
        return a
    shift = b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + shift ** 2 * (a[0] * b[0] / n)


def _about(d: int, every: int):
    """A partition's count, mean and squared deviations, and each so many-th row."""
    def f(blocks):
        total, some = (0, np.zeros(d), np.zeros(d)), []
        for g, x in blocks:
            m = x.mean(0)
            total = _merged(total, (len(x), m, ((x - m) ** 2).sum(0)))
            some.append(x[::every])
        yield total, np.concatenate(some) if some else np.zeros((0, d)), total[0]
    return f


def _moments(groups: int, mean, scale):
    """Per group: rows, and sums of the products of the scaled features and 1."""
    def f(blocks):
        out = np.zeros((groups, len(mean) + 1, len(mean) + 1))
        for g, x in blocks:
            z = _augmented(x, mean, scale)
            for k in np.unique(g):
                zk = z[g == k]
                out[k] += zk.T @ zk
        yield out
    return f


def _augmented(x, mean, scale):
    return np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)


def _pass(theta, weights, mean, scale):
    """Sums of loss, gradient and Hessian (upper triangle) of each model; theta: (features + 1, models), weights: (groups, models)."""
    upper = np.triu_indices(len(theta))
    step = max(256, ARRAY_VALUES // max(theta.shape[1], len(upper[0])))

    def f(blocks):
        loss, grad, hess = np.zeros(theta.shape[1]), np.zeros(theta.shape), np.zeros((len(upper[0]), theta.shape[1]))
        for g_all, x_all in blocks:
            for i in range(0, len(g_all), step):
                g, z = g_all[i:i + step], _augmented(x_all[i:i + step], mean, scale)
                y = (g & 1).astype(float)[:, None]
                w = weights[g]
                m = z @ theta
                e = np.exp(-np.abs(m))
                p = np.where(m >= 0, 1.0, e) / (1.0 + e)
                loss += (w * (np.log1p(e) + np.maximum(m, 0.0) - y * m)).sum(0)
                grad += z.T @ (w * (p - y))
                hess += (z[:, upper[0]] * z[:, upper[1]]).T @ (w * p * (1.0 - p))
        yield loss, grad, hess
    return f


def _sum(rdd, f):
    return rdd.mapPartitions(f).treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)) if isinstance(a, tuple) else a + b)


def _newton(g, h):
    """Steps -h^-1 g of all models; directions without curvature are left alone."""
    val, vec = np.linalg.eigh(h)
    least = 1e-14 * val[:, -1:]
    inv = np.where(val > least, 1.0 / np.where(val > least, val, 1.0), 0.0)
    return -np.einsum("mij,mj,mkj,mk->mi", vec, inv, vec, g)


def _descent(theta, g, h, l1, free):
    """Steps that lower g d + d h d / 2 + sum l1 |theta + d| of all models as far as it goes: a sweep over the coordinates sets
    signs and zeros, Newton steps lead to the least value with these signs (one that would change goes to zero)."""
    dim = theta.shape[1]
    z, q = theta.copy(), g.copy()
    diag = np.einsum("mii->mi", h)
    free = free & (diag > 0)
    safe = np.where(free, diag, 1.0)
    for _ in range(MOST_SWEEPS):
        most = 0.0
        for j in range(dim):
            u = safe[:, j] * z[:, j] - q[:, j]
            move = np.where(free[:, j], np.sign(u) * np.maximum(np.abs(u) - l1[:, j], 0.0) / safe[:, j] - z[:, j], 0.0)
            z[:, j] += move
            q += h[:, :, j] * move[:, None]
            most = max(most, float(np.max(move ** 2 * safe[:, j])))
        if most < 1e-18:
            break
        for _ in range(dim):
            sign = np.sign(z) * (l1 > 0)
            on = free & ((z != 0) | (l1 == 0))
            val, vec = np.linalg.eigh(np.where(on[:, :, None] & on[:, None, :], h, 0.0))
            # along a direction without curvature the step is long, and ends where a sign would change
            val = np.maximum(val, 1e-12 * val[:, -1:])
            way = np.where(on, -np.einsum("mij,mj,mkj,mk->mi", vec, 1.0 / val, vec, np.where(on, q + l1 * sign, 0.0)), 0.0)
            crosses = (sign != 0) & (np.sign(z + way) != sign)
            at = np.where(crosses, -z / np.where(crosses, way, 1.0), 2.0)
            t = np.minimum(at.min(1), 1.0)
            z = np.where(crosses & (at <= t[:, None]), 0.0, z + t[:, None] * way)
            q = g + np.einsum("mij,mj->mi", h, z - theta)
            if (t >= 1.0).all():
                break
    return z - theta


def _fitted(rdd, moments, lam, alpha, weights, mean, scale):
    """(models, features + 1) coefficients of the scaled features, intercept last. weights: (groups, models), 0 for held-out folds."""
    n_models, dim = len(lam), moments.shape[1]
    per_class = [np.einsum("gm,gij->mij", weights[c::2], moments[c::2]) for c in (0, 1)]
    both = per_class[0] + per_class[1]
    total = both[:, -1, -1]
    squares = np.einsum("gm,g->m", weights ** 2, moments[:, -1, -1])
    avg = both[:, -1, :-1] / total[:, None]
    spread = np.einsum("mii->mi", both)[:, :-1] - avg ** 2 * total[:, None]
    std = np.sqrt(np.maximum(spread, 0.0) / (total - squares / total)[:, None])
    std[spread <= 1e-12 * total[:, None]] = 0.0  # the same value in all rows of the model
    free = np.concatenate([std > 0, np.ones((n_models, 1), bool)], axis=1)
    l1, l2 = np.zeros((n_models, dim)), np.zeros((n_models, dim))
    l1[:, :-1], l2[:, :-1] = (lam * alpha)[:, None] * std, (lam * (1 - alpha))[:, None] * std ** 2
    lasso = alpha > 0
    upper = np.triu_indices(dim)

    # at first only the intercept: its sums follow from the moments
    share = per_class[1][:, -1, -1] / total
    theta = np.zeros((n_models, dim))
    theta[:, -1] = np.log(share / (1 - share))
    loss = -(share * np.log(share) + (1 - share) * np.log(1 - share))
    grad = (share[:, None] * both[:, -1, :] - per_class[1][:, -1, :]) / total[:, None]
    hess = (share * (1 - share) / total)[:, None, None] * both

    def objective(loss, theta):
        return loss + (l1 * np.abs(theta) + 0.5 * l2 * theta ** 2).sum(1)

    value, size = objective(loss, theta), np.ones(n_models)
    step, gain = np.zeros_like(theta), np.zeros(n_models)
    fresh, going = np.arange(n_models), np.ones(n_models, bool)
    for _ in range(MOST_PASSES):
        if len(fresh):  # models at a new point: their next step
            g = np.where(free[fresh], grad[fresh] + l2[fresh] * theta[fresh], 0.0)
            h = np.where(free[fresh][:, :, None] & free[fresh][:, None, :], hess[fresh], 0.0)
            h[:, np.arange(dim), np.arange(dim)] += l2[fresh]
            for kind, solve in ((~lasso[fresh], lambda k: _newton(g[k], h[k])),
                                (lasso[fresh], lambda k: _descent(theta[fresh[k]], g[k], h[k], l1[fresh[k]], free[fresh[k]]))):
                if kind.any():
                    step[fresh[kind]] = solve(np.flatnonzero(kind))
            moved = theta[fresh] + step[fresh]
            gain[fresh] = (g * step[fresh] + l1[fresh] * (np.abs(moved) - np.abs(theta[fresh]))).sum(1)
            size[fresh] = 1.0
            done = fresh[~(gain[fresh] < -TOL)]
            going[done] = False
        at = np.flatnonzero(going)
        if not len(at):
            break
        trial = theta[at] + size[at, None] * step[at]
        loss, grad_sum, hess_sum = _sum(rdd, _pass(np.ascontiguousarray(trial.T), np.ascontiguousarray(weights[:, at]), mean, scale))
        new = (loss / total[at]) + (l1[at] * np.abs(trial) + 0.5 * l2[at] * trial ** 2).sum(1)
        better = new <= value[at] + 1e-4 * size[at] * gain[at] + 1e-12 * np.abs(value[at])  # beyond, sums of many rows differ by rounding
        fresh = at[better]
        theta[fresh], value[fresh] = trial[better], new[better]
        grad[fresh] = (grad_sum.T / total[at, None])[better]
        full = np.zeros((better.sum(), dim, dim))
        full[:, upper[0], upper[1]] = (hess_sum.T / total[at, None])[better]
        full[:, upper[1], upper[0]] = full[:, upper[0], upper[1]]
        hess[fresh] = full
        short = at[~better]
        size[short] /= 2
        going[short[size[short] < 1e-6]] = False
    return theta


def _scores(x, theta, mean, scale):
    """(rows, models) margins, term by term: equal rows have equal scores wherever they are in a block."""
    out = np.broadcast_to(theta[-1], (len(x), theta.shape[1])).copy()
    z = (x - mean) / scale
    for j in range(z.shape[1]):
        out += z[:, j:j + 1] * theta[j]
    return out


def _dealt(theta, held, cuts, mean, scale, first):
    """Scores of a partition by model and range of values: for each of training and held-out rows of both classes (training
    negatives and positives, held-out ones) ascending different scores and how often they come."""
    def f(blocks):
        groups, scores = [], []
        for g, x in blocks:
            groups.append(g)
            scores.append(np.concatenate([_scores(x[i:i + 1024], theta, mean, scale) for i in range(0, len(x), 1024)]).T.copy())
        if not groups:
            return
        g = np.concatenate(groups)
        for m in range(theta.shape[1]):
            s = np.concatenate([b[m] for b in scores])
            kind = (g & 1) + 2 * (g >> 1 == held[m])
            parts = {}
            for k in range(4):
                v, times = np.unique(s[kind == k], return_counts=True)
                ends = np.searchsorted(v, cuts[m], side="left")
                for r, (a, b) in enumerate(zip([0, *ends], [*ends, len(v)])):
                    if b > a:
                        t = times[a:b]
                        parts.setdefault(r, [None] * 4)[k] = (v[a:b], None if t.max() == 1 else t)
            for r, found in parts.items():
                yield (first + m, r), found
    return f


def _pairs(neg, pos):
    """(negatives, positives, pairs in which the positive has the higher score, ties by half) of lists of (scores, times)."""
    def flat(found):
        v = np.concatenate([a for a, _ in found]) if found else np.zeros(0)
        t = np.concatenate([np.ones(len(a), np.int64) if k is None else k for a, k in found]) if found else np.zeros(0, np.int64)
        return v, t
    (vn, tn), (vp, tp) = flat(neg), flat(pos)
    order = np.argsort(vn)
    vn, upto = vn[order], np.concatenate([[0], np.cumsum(tn[order])])
    below, with_ties = upto[np.searchsorted(vn, vp, "left")], upto[np.searchsorted(vn, vp, "right")]
    return int(tn.sum()), int(tp.sum()), float((tp * (below + with_ties)).sum()) / 2


def _counted(records):
    by_key: dict = {}
    for key, found in records:
        kinds = by_key.setdefault(key, [[], [], [], []])
        for k, one in enumerate(found):
            if one is not None:
                kinds[k].append(one)
    for key, (n0, p0, n1, p1) in by_key.items():
        yield key, _pairs(n0, p0), _pairs(n1, p1)


def _aucs(rdd, theta, held, some, n, largest, mean, scale):
    """(held-out, training) ROC-AUC of each model; theta: (models, features + 1)."""
    ranges = max(1, -(-n // RANGE_SCORES))
    at_once = max(1, TASK_SCORES // max(1, largest))
    counts: dict = {}
    for a in range(0, len(theta), at_once):
        part = np.ascontiguousarray(theta[a:a + at_once].T)
        sample = np.sort(_scores(some, part, mean, scale), axis=0)
        cuts = [np.unique(sample[[len(sample) * r // ranges for r in range(1, ranges)], m]) for m in range(part.shape[1])]
        tasks = max(rdd.context.defaultParallelism, -(-n * part.shape[1] // (TASK_SCORES // 4)))
        dealt = rdd.mapPartitions(_dealt(part, held[a:a + at_once], cuts, mean, scale, a))
        for key, *found in dealt.partitionBy(tasks, lambda k, r=ranges: k[0] * r + k[1]).mapPartitions(_counted).collect():
            counts[key] = found
    out = []
    for m in range(len(theta)):
        pair = []
        for which in (1, 0):
            below, pos, won = 0, 0, 0.0
            for r in range(ranges):
                if (m, r) in counts:
                    neg_r, pos_r, won_r = counts[m, r][which]
                    won += won_r + below * pos_r
                    below, pos = below + neg_r, pos + pos_r
            pair.append(won / (below * pos))
        out.append(tuple(pair))
    return out


def fold_scores(maps: list[dict], class_weights: list[dict], folded: DataFrame, label: str, cv: int) -> list | None:
    """For each map of MLlib parameters (regParam, elasticNetParam) ([held-out ROC-AUC per fold], [training ROC-AUC per fold]). None
    where MLlib has to do it: a feature that is null or not finite, a fold without one of the classes, too many features.

    ``folded``: label (0 or 1), features (vector), fold; ``class_weights``: {class: weight} per map."""
    ship_package(folded.sparkSession)
    first = folded.select(F.size(vector_to_array("features")).alias("d")).first()
    n_models = len(maps) * cv
    if first is None or cv > 127 or n_models * (first["d"] + 1) * (first["d"] + 2) // 2 > MOST_SUMS:
        return None
    d = first["d"]
    rdd = _blocks(folded, label)
    try:
        n = rdd.map(lambda b: len(b[0])).sum()
        found = rdd.mapPartitions(_about(d, max(1, n // CUT_ROWS))).collect()
        total = (0, np.zeros(d), np.zeros(d))
        for t, _, _ in found:
            total = _merged(total, t)
        if not np.isfinite(total[1]).all() or not np.isfinite(total[2]).all():
            return None
        mean, scale = total[1], np.sqrt(total[2] / total[0])
        scale = np.where(scale > 0, scale, 1.0)
        moments = _sum(rdd, _moments(2 * cv, mean, scale))
        if (moments[:, -1, -1] == 0).any():
            return None
        held = np.tile(np.arange(cv), len(maps))
        weights = np.array([[0.0 if fold == f else float(w[c]) for w in class_weights for f in range(cv)] for fold in range(cv) for c in (0, 1)])
        lam, alpha = (np.repeat([m[k] for m in maps], cv).astype(float) for k in ("regParam", "elasticNetParam"))
        theta = _fitted(rdd, moments, lam, alpha, weights, mean, scale)
        some = np.concatenate([s for _, s, _ in found])
        aucs = _aucs(rdd, theta, held, some, n, max(k for *_, k in found), mean, scale)
    finally:
        rdd.unpersist()
    return [tuple([aucs[i * cv + f][k] for f in range(cv)] for k in (0, 1)) for i in range(len(maps))]
