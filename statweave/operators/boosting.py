"""Boosted regression trees on binned rows that fit one task.

The same trees as Spark's ``GBTRegressor`` (squared loss, 32 bins, all
features): the same split points, the same rows drawn for a tree, sums taken
in the same order, the same choice among equal gains.  Spark runs some jobs
for every level of every tree, so a search over many small fits waits on jobs;
here a fit is one task without jobs, and many run side by side.

Split points come from all training rows; Spark draws about 10,000 of them
where there are more.  Rows lie in blocks, one for each partition that they
came in, as Spark draws and sums by partition.
"""

from __future__ import annotations

import io
import json
import os
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Values (rows x features) of a fit that one task takes, at about six bytes.
TASK_VALUES = 64_000_000
# Rows that are summed at once, if no block has more.
CHUNK_ROWS = 32_768
MAX_BINS = 32
EPSILON = 2.220446049250313e-16
SEED = 42
_U64 = np.uint64


# ------------------------------------------------------------------ bins --
def split_points(values: np.ndarray, counts: np.ndarray, n_rows: int, max_bins: int = MAX_BINS) -> np.ndarray:
    """Split points of a feature from its distinct values in rising order: all
    midpoints if they are fewer than the bins, else the nearest to equal
    shares of the rows."""
    n_splits = min(max_bins, n_rows) - 1
    if len(values) < 2:
        return np.zeros(0)
    middle = (values[:-1] + values[1:]) / 2.0
    if len(middle) <= n_splits:
        return middle
    stride = n_rows / (n_splits + 1)
    seen = np.cumsum(counts).astype(float)
    out, target, at = [], stride, 0
    while at < len(middle):
        # The first value after which the next one is farther from the target.
        nearer = np.abs(seen[at:-1] - target) < np.abs(seen[at + 1:] - target)
        hit = int(nearer.argmax())
        if not nearer[hit]:
            break
        out.append(middle[at + hit])
        at, target = at + hit + 1, target + stride
    return np.array(out)


class Layout:
    """Where each feature's bins lie in a node's row of sums.  Features without
    splits have none; features of about as many bins lie side by side.
    ``common`` is each feature's most frequent bin, ``share`` its share of the
    rows."""

    def __init__(self, points: list[np.ndarray], common: list[int], share: list[float]):
        self.points = points
        self.used = np.array([f for f, p in enumerate(points) if len(p)], dtype=int)
        self.n_splits = np.array([len(points[f]) for f in self.used], dtype=int)
        width = 1 << np.ceil(np.log2(self.n_splits + 1)).astype(int)
        self.offset = np.zeros(len(self.used), dtype=int)
        self.groups = []  # (positions in ``used``, width, first bin, splits that exist)
        at = 0
        for w in sorted(set(width.tolist())):
            of = np.flatnonzero(width == w)
            self.offset[of] = at + w * np.arange(len(of))
            self.groups.append((of, w, at, np.arange(w - 1) < self.n_splits[of][:, None]))
            at += w * len(of)
        self.width, self.bins = width, at
        self.type = np.uint16 if at < 1 << 16 else np.int32
        # Features with one bin for more than half of the rows are sparse.
        self.common = np.array([common[f] for f in self.used], dtype=int)
        self.sparse = np.array([share[f] > 0.5 for f in self.used], dtype=bool)
        self.dense = np.flatnonzero(~self.sparse)

    def codes(self, features: np.ndarray) -> np.ndarray:
        """Bin numbers (used features x rows) within their feature."""
        out = np.empty((len(self.used), len(features)), np.uint8)
        for i, f in enumerate(self.used):
            out[i] = np.searchsorted(self.points[f], features[:, f], side="left")
        return out


# ------------------------------------------------------------ drawn rows --
def _murmur(data: bytes, seed: int) -> int:
    mask, h = 0xFFFFFFFF, seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) & mask
        h ^= k * 0x1B873593 & mask
        h = (h << 13 | h >> 19) & mask
        h = h * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


def drawn(first_seed: int, n_seeds: int, n_rows: int, rate: float) -> np.ndarray:
    """(seeds x rows) whether Spark's generator (XORShift) draws a row."""
    state = []
    for s in range(first_seed, first_seed + n_seeds):
        data = s.to_bytes(8, "big", signed=True)
        low = _murmur(data, 0x3C074A61)
        state.append(_murmur(data, low) << 32 | low)
    x = np.array(state, _U64)
    out = np.empty((n_rows, n_seeds), bool)
    # u = (next 26 bits << 27 + next 27 bits) / 2 ** 53, exact in whole numbers
    for i in range(n_rows):
        for bits in (26, 27):
            x ^= x << _U64(21)
            x ^= x >> _U64(35)
            x ^= x << _U64(4)
            part = x & _U64((1 << bits) - 1)
            value = part << _U64(27) if bits == 26 else value + part
        out[i] = value * 2.0 ** -53 < rate
    return np.ascontiguousarray(out.T)


# ----------------------------------------------------------------- trees --
class Tree(NamedTuple):
    """Nodes by heap number (the root is 1, children 2i and 2i + 1): position
    of the feature in the layout (-1: leaf), its split, gain and the sums
    (rows, y, y squared) of the node."""
    feature: np.ndarray
    split: np.ndarray
    gain: np.ndarray
    sums: np.ndarray

    def predictions(self) -> np.ndarray:
        n = self.sums[0]
        return np.where(n > 0, self.sums[1] / np.maximum(n, 1), 0.0)


def _impurity(n, s, q):
    m = np.maximum(n, 1)
    return np.where(n > 0, (q - s * s / m) / m, 0.0)


class Part:
    """Rows of one block that grow a tree: bin codes (with their offset) of
    every feature, and y; ``pairs`` are the rows and codes outside the most
    frequent bin of the features where that holds most rows."""

    def __init__(self, codes: np.ndarray, y: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]):
        self.codes, self.y, self.pairs = codes, y, pairs
        self.slot = np.zeros(len(y), np.intp)

    def take(self, keep: np.ndarray) -> Part:
        """The rows where ``keep`` holds."""
        row, code = self.pairs
        of = keep[row]
        part = Part(self.codes[:, keep], self.y[keep], ((np.cumsum(keep) - 1)[row[of]], code[of]))
        part.slot = self.slot[keep]
        return part


def _sums(parts: list[Part], layout: Layout, k: int) -> np.ndarray:
    """(2, k, bins): rows and y by node and bin, to rounding.  Slot ``k`` holds
    rows of finished nodes.  The most frequent bin of a sparse feature is what
    the others leave of the node."""
    size = (k + 1) * layout.bins
    out, total = np.zeros((2, size)), np.zeros((2, k + 1))
    for part in parts:
        low = part.slot * layout.bins
        at = np.add(part.codes[layout.dense], low, dtype=np.intp).ravel()
        out[0] += np.bincount(at, minlength=size)
        out[1] += np.bincount(at, np.tile(part.y, len(layout.dense)), size)
        row, code = part.pairs
        at = low[row] + code
        out[0] += np.bincount(at, minlength=size)
        out[1] += np.bincount(at, part.y[row], size)
        total[0] += np.bincount(part.slot, minlength=k + 1)
        total[1] += np.bincount(part.slot, part.y, k + 1)
    out = out.reshape(2, k + 1, layout.bins)
    for of, w, low, _ in layout.groups:
        bins = out[:, :, low:low + w * len(of)].reshape(2, k + 1, len(of), w)
        sparse = np.flatnonzero(layout.sparse[of])
        rest = total[..., None] - bins[:, :, sparse].sum(axis=3)
        out[:, :, layout.offset[of[sparse]] + layout.common[of[sparse]]] = rest
    return out[:, :k]


def _near_best(sums: np.ndarray, layout: Layout, nodes_q: np.ndarray) -> np.ndarray:
    """(nodes x features) whether a feature's best split may be the node's best,
    as far as sums in any order tell."""
    k = sums.shape[1]
    best = np.full((k, len(layout.used)), -np.inf)
    for of, w, low, exists in layout.groups:
        n, s = np.cumsum(sums[:, :, low:low + w * len(of)].reshape(2, k, len(of), w), axis=3)
        ln, ls = n[..., :-1], s[..., :-1]
        rn, rs = n[..., -1:] - ln, s[..., -1:] - ls
        with np.errstate(invalid="ignore", divide="ignore"):
            score = ls * ls / ln + rs * rs / rn
        score[~((ln >= 1) & (rn >= 1) & exists)] = -np.inf
        best[:, of] = score.max(axis=2)
    top = best.max(axis=1)
    with np.errstate(invalid="ignore"):
        return (best > -np.inf) & (best >= (top - 1e-9 * nodes_q)[:, None])


def _exact(parts: list[Part], layout: Layout, near: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """(3, pairs, widest): rows, y, y squared up to and with each bin, for the
    pairs of node and feature in ``near``; sums in the order of the rows."""
    w = int(layout.width.max())
    many = np.r_[near.sum(axis=1), 0]
    first = np.cumsum(many) - many
    size = len(feature) * w
    out = np.zeros((3, size))
    for part in parts:
        times = many[part.slot]
        row = np.repeat(np.arange(len(times)), times)
        pair = np.arange(len(row)) - np.repeat(np.cumsum(times) - times - first[part.slot], times)
        f = feature[pair]
        at = pair * w - layout.offset[f] + part.codes[f, row]
        y = part.y[row]
        out[0] += np.bincount(at, minlength=size)
        out[1] += np.bincount(at, y, size)
        out[2] += np.bincount(at, y * y, size)
    return np.cumsum(out.reshape(3, len(feature), w), axis=2)


def grow(parts: list[Part], layout: Layout, depth: int) -> Tree:
    """A tree over the rows of some blocks.  Sums of rows and y alone, of all
    features, tell which splits may be the best; only these are summed in the
    order of the rows, as Spark does, and compared."""
    size = 2 << depth
    tree = Tree(np.full(size, -1), np.zeros(size, int), np.full(size, -1.0), np.zeros((3, size)))
    total = [sum(len(p.y) for p in parts), sum(p.y.sum() for p in parts), sum((p.y * p.y).sum() for p in parts)]
    if not len(layout.used):
        tree.sums[:, 1] = total
        return tree
    nodes, squares = np.array([1]), np.array([total[2]])
    for level in range(depth):
        k = len(nodes)
        near = _near_best(_sums(parts, layout, k), layout, squares)
        if level == 0:  # the root's sums are those of the first split's sides
            near[0, 0] = True
        slot, feature = np.nonzero(near)
        if not len(slot):
            break
        sums = _exact(parts, layout, near, feature)
        if level == 0:
            left = sums[:, 0, 0]
            tree.sums[:, 1] = left + (sums[:, 0, -1] - left)
        left, right = sums[:, :, :-1], sums[:, :, -1:] - sums[:, :, :-1]
        n = left[0] + right[0]
        own = _impurity(*tree.sums[:, nodes[slot]])[:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = own - left[0] / n * _impurity(*left) - right[0] / n * _impurity(*right)
        exists = np.arange(gain.shape[1]) < layout.n_splits[feature][:, None]
        gain[~((left[0] >= 1) & (right[0] >= 1) & exists & (gain >= 0))] = -np.inf
        split = gain.argmax(axis=1)
        pair = np.arange(len(slot))
        gain = gain[pair, split]
        begins = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        top = np.repeat(np.maximum.reduceat(gain, begins), np.diff(np.r_[begins, len(slot)]))
        pair = np.minimum.reduceat(np.where(gain == top, pair, len(slot)), begins)  # the first of the best
        pair = pair[gain[pair] > 0]
        if not len(pair):
            break
        slot, f, split = slot[pair], feature[pair], split[pair]
        up = nodes[slot]
        tree.feature[up], tree.split[up], tree.gain[up] = f, split, gain[pair]
        children = np.stack([2 * up, 2 * up + 1], axis=1).ravel()
        tree.sums[:, children] = np.stack([left[:, pair, split], right[:, pair, split]], axis=2).reshape(3, -1)
        if level + 1 == depth:
            break
        opened = np.abs(_impurity(*tree.sums[:, children])) >= EPSILON
        nodes = children[opened]
        if not len(nodes):
            break
        squares = tree.sums[2, nodes]
        follow = np.full(2 * (k + 1), len(nodes))  # the slot of finished nodes
        into = np.full(len(children), len(nodes))
        into[opened] = np.arange(len(nodes))
        follow[2 * slot], follow[2 * slot + 1] = into[::2], into[1::2]
        of, limit = np.zeros(k + 1, int), np.zeros(k + 1, int)
        of[slot], limit[slot] = f, layout.offset[f] + split
        for b, part in enumerate(parts):
            p = part.slot
            code = part.codes[of[p], np.arange(len(p))]
            part.slot = follow[2 * p + (code > limit[p])]
            keep = part.slot < len(nodes)
            if np.count_nonzero(keep) < 0.8 * len(keep):
                parts[b] = part.take(keep)
    # Leaves of one parent with the same prediction are one leaf.
    value = tree.predictions()
    for i in range(size // 2 - 1, 0, -1):
        if tree.feature[i] >= 0 and tree.feature[2 * i] < 0 > tree.feature[2 * i + 1] and \
                value[2 * i] == value[2 * i + 1]:
            tree.feature[i], tree.gain[i] = -1, -1.0
    return tree


def predict(tree: Tree, codes: np.ndarray, layout: Layout, depth: int) -> np.ndarray:
    value = tree.predictions()
    if not len(layout.used):
        return np.full(codes.shape[1], value[1])
    size = len(tree.feature)
    inner = tree.feature >= 0
    start = np.where(inner, tree.feature, 0) * codes.shape[1]
    limit = np.where(inner, layout.offset[tree.feature] + tree.split, 0)
    child = np.repeat(np.arange(size), 2)
    child[np.repeat(inner, 2)] = (2 * np.flatnonzero(inner)[:, None] + [0, 1]).ravel()
    flat, row = codes.ravel(), np.arange(codes.shape[1])
    node = np.ones(codes.shape[1], np.intp)
    for _ in range(depth):
        node = child[2 * node + (flat[start[node] + row] > limit[node])]
    return value[node]


class Rows:
    """Binned rows of one fit: training rows by block, validation and test
    rows."""

    def __init__(self, layout: Layout, train: list[tuple[np.ndarray, np.ndarray]],
                 valid: list[tuple[np.ndarray, np.ndarray]], test: list[tuple[np.ndarray, np.ndarray]]):
        every = [*train, *valid, *test]
        ends = np.cumsum([0, *(len(y) for _, y in every)])
        self.layout = layout
        self.y = np.concatenate([y for _, y in every])
        self.codes = np.empty((len(layout.used), len(self.y)), layout.type)
        for (codes, _), low, high in zip(every, ends, ends[1:]):
            np.add(codes, layout.offset[:, None], out=self.codes[:, low:high], casting="unsafe")
        self.blocks = [slice(a, b) for a, b in zip(ends, ends[1:len(train) + 1])]
        sparse = np.flatnonzero(layout.sparse)
        usual = (layout.offset + layout.common)[sparse]
        # Small blocks are summed together.
        self.chunks, self.pairs = [], []
        for b in self.blocks:
            if self.chunks and b.stop - self.chunks[-1].start <= CHUNK_ROWS:
                b = slice(self.chunks.pop().start, b.stop)
            self.chunks.append(b)
        for b in self.chunks:
            codes = self.codes[sparse, b].T
            row, at = np.nonzero(codes != usual)
            self.pairs.append((row, codes[row, at]))
        self.valid = slice(ends[len(train)], ends[len(train) + len(valid)])
        self.test = slice(ends[len(train) + len(valid)], ends[-1])


def _mean(x: np.ndarray) -> float:
    """Summed in the order of the rows, as Spark does."""
    return float(np.cumsum(x)[-1] / len(x)) if len(x) else float("nan")


def boost(rows: Rows, depth: int, step: float, subsampling: float, most: int,
          seed: int = SEED) -> Iterator[tuple[Tree, float, float]]:
    """(tree, mean squared error on the validation rows, mean absolute error
    on the test rows) after every tree, up to ``most``."""
    lengths = [b.stop - b.start for b in rows.blocks]
    draws = None
    if subsampling < 1:
        draws = drawn(seed + 1, most + len(lengths) - 1, max(lengths), subsampling)
    prediction = np.zeros(len(rows.y))
    for m in range(most):
        target = 2.0 * (rows.y - prediction) if m else rows.y
        parts = [Part(rows.codes[:, b], target[b], pairs) for b, pairs in zip(rows.chunks, rows.pairs)]
        if draws is not None:
            keep = np.concatenate([draws[m + i, :n] for i, n in enumerate(lengths)])
            parts = [part.take(keep[b]) for b, part in zip(rows.chunks, parts)]
        tree = grow(parts, rows.layout, depth)
        prediction += (step if m else 1.0) * predict(tree, rows.codes, rows.layout, depth)
        error = rows.y - prediction
        yield tree, _mean(error[rows.valid] ** 2), _mean(np.abs(error[rows.test]))


# ------------------------------------------------------------- on Spark --
class Fold(NamedTuple):
    """Frames of one fit: vectors in ``features`` and the label."""
    train: DataFrame
    valid: DataFrame
    test: DataFrame | None = None


class Job(NamedTuple):
    """A fit of fold number ``fold``; ends after ``patience`` trees without a
    smaller loss."""
    fold: int
    depth: int
    step: float
    subsampling: float
    most: int
    patience: int


VALUES = "fold int, feature int, value array<double>, n array<long>"
POINTS = "fold int, feature int, points array<double>, common int, share double"
PACKED = "role int, part int, codes binary, y binary"
FITTED = "job int, losses array<double>, maes array<double>, nodes binary"


class Fit(NamedTuple):
    losses: list[float]
    maes: list[float]
    nodes: dict[str, np.ndarray]


def stop_at(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(trees of the best model, whether boosting stopped): the run ends when
    ``patience`` rounds in a row bring no smaller loss than the best so far."""
    best = 0
    for i, x in enumerate(losses):
        if x < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_a_task(*frames: DataFrame) -> bool:
    """Whether all rows together are few enough for one task."""
    n = sum(f.count() for f in frames)
    first = next((r for f in frames if (r := f.select("features").first())), None)
    return first is not None and n * len(first[0]) <= TASK_VALUES


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    y = batch.column(1).to_numpy(zero_copy_only=False)
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        raise ValueError("features and labels must be numbers")
    return x, y


def _batch(schema: str, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary(),
             "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[n], kinds[t]) for n, t in fields],
                                      names=[n for n, _ in fields])


def _plain(df: DataFrame, label: str) -> DataFrame:
    return df.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def layouts(folds: list[Fold], label: str) -> list[Layout]:
    """Split points of every fold's training rows, a task for each feature."""
    def values(fold):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    got = [np.unique(c, return_counts=True) for c in _arrays(b)[0].T]
                    yield _batch(VALUES, fold=[fold] * len(got), feature=range(len(got)),
                                 value=[v for v, _ in got], n=[n for _, n in got])
        return run

    def points(table: pa.Table) -> pa.Table:
        value = np.concatenate([c.flatten().to_numpy() for c in table.column("value").chunks])
        n = np.concatenate([c.flatten().to_numpy() for c in table.column("n").chunks])
        value, of = np.unique(value, return_inverse=True)
        n = np.bincount(of, n).astype(np.int64)
        at = split_points(value, n, int(n.sum()))
        rows = np.bincount(np.searchsorted(at, value, side="left"), n)
        return pa.Table.from_batches([_batch(
            POINTS, fold=[table.column("fold")[0].as_py()], feature=[table.column("feature")[0].as_py()],
            points=[at], common=[int(rows.argmax())], share=[float(rows.max() / n.sum())])])

    every = _union([_plain(f.train, label).mapInArrow(
        values(i), VALUES) for i, f in enumerate(folds)])
    got = every.groupBy("fold", "feature").applyInArrow(
        points, POINTS).orderBy("fold", "feature").collect()  # a row for each fold and feature
    out = []
    for i in range(len(folds)):
        of = [r for r in got if r.fold == i]
        if not of:
            raise ValueError("no training rows")
        out.append(Layout([np.array(r.points) for r in of], [r.common for r in of], [r.share for r in of]))
    return out


def fit_many(folds: list[Fold], label: str, jobs: list[Job]) -> list[Fit]:
    """All ``jobs``, each in a task of its own, in their order; the first begin
    first.  Rows are binned once a fold and come to the tasks packed, a block
    for each partition."""
    layout = layouts(folds, label)

    def pack(fold, role):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codes, ys = [np.empty((len(layout[fold].used), 0), np.uint8)], [np.empty(0)]
            for b in batches:
                if b.num_rows:
                    x, y = _arrays(b)
                    codes.append(layout[fold].codes(x))
                    ys.append(y.astype(float))
            yield _batch(PACKED, role=[role], part=[TaskContext.get().partitionId()],
                         codes=[np.concatenate(codes, axis=1).tobytes()], y=[np.concatenate(ys).tobytes()])
        return run

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[list] = [[], [], []]
        number = None
        for b in batches:
            for r in range(b.num_rows):
                number = b.column("job")[r].as_py()
                y = np.frombuffer(b.column("y")[r].as_buffer())
                codes = np.frombuffer(b.column("codes")[r].as_buffer(), np.uint8)
                codes = codes.reshape(len(layout[jobs[number].fold].used), len(y))
                blocks[b.column("role")[r].as_py()].append((b.column("part")[r].as_py(), codes, y))
        if number is None:
            return
        job = jobs[number]
        rows = Rows(layout[job.fold], *[[p[1:] for p in sorted(x, key=lambda p: p[0])] for x in blocks])
        del blocks
        trees, losses, maes = [], [], []
        for tree, loss, mae in boost(rows, job.depth, job.step, job.subsampling, job.most):
            trees.append(tree)
            losses.append(loss)
            maes.append(mae)
            if stop_at(losses, job.patience)[1]:
                break
        file = io.BytesIO()
        np.savez_compressed(file, **_nodes(trees[:stop_at(losses, job.patience)[0]], layout[job.fold]))
        yield _batch(FITTED, job=[number], losses=[losses], maes=[maes], nodes=[file.getvalue()])

    packed = []
    for i, fold in enumerate(folds):
        own = [n for n, job in enumerate(jobs) if job.fold == i]
        for role, frame in enumerate(fold):
            if own and frame is not None:
                packed.append(_plain(frame, label).mapInArrow(
                    pack(i, role), PACKED).withColumn("job", F.explode(F.lit(own))))
    got = _union(packed).repartitionById(len(jobs), F.col("job").cast("int")).mapInArrow(
        run, FITTED).collect()  # models
    out = {r.job: Fit(list(r.losses), list(r.maes), dict(np.load(io.BytesIO(r.nodes)))) for r in got}
    return [out[n] for n in range(len(jobs))]


NODES = ("tree", "id", "prediction", "impurity", "n", "s", "q", "gain", "left", "right", "feature", "point")


def _nodes(trees: list[Tree], layout: Layout) -> dict[str, np.ndarray]:
    """The trees' nodes, numbered in the order that Spark stores them."""
    out = []
    for t, tree in enumerate(trees):
        value, impurity = tree.predictions(), _impurity(*tree.sums)

        def walk(i: int, t=t, tree=tree, value=value, impurity=impurity) -> int:
            own = [t, len(out) - begin, value[i], impurity[i], *tree.sums[:, i], tree.gain[i], -1, -1, -1, 0.0]
            out.append(own)
            if tree.feature[i] >= 0:
                f = layout.used[tree.feature[i]]
                own[8], own[9] = walk(2 * i), walk(2 * i + 1)
                own[10], own[11] = f, layout.points[f][tree.split[i]]
            return own[1]
        begin = len(out)
        walk(1)
    return {name: np.array(c) for name, c in zip(NODES, zip(*out))}


def to_model(nodes: dict[str, np.ndarray], estimator: GBTRegressor) -> GBTRegressionModel:
    """Spark's model of these trees, by its stored form in the shared folder.  As
    in a cut model, the number of features is left open."""
    spark = SparkSession.active()
    path = scratch_path(spark, "boosted")
    params = {p.name: v for p, v in estimator.extractParamMap().items()}
    n_trees = int(nodes["tree"].max()) + 1
    tree_params = {k: params[k] for k in ("featuresCol", "labelCol", "predictionCol", "maxDepth", "seed")}

    def about(cls: str, uid: str, own: dict, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": 0,
                           "sparkVersion": spark.version, "uid": uid, "paramMap": own,
                           "defaultParamMap": {}, **more})
    spark.createDataFrame([(about("GBTRegressionModel", estimator.uid, params, numFeatures=-1,
                                  numTrees=n_trees),)], "value string").coalesce(1).write.text(
        os.path.join(path, "metadata"))
    spark.createDataFrame([(t, about("DecisionTreeRegressionModel", f"{estimator.uid}_{t}", tree_params),
                            params["stepSize"] if t else 1.0) for t in range(n_trees)],
                          "_1 int, _2 string, _3 double").write.parquet(os.path.join(path, "treesMetadata"))
    c = {k: F.col(k).cast("int") for k in ("tree", "id", "left", "right", "feature")}
    point = F.when(c["feature"] >= 0, F.array("point")).otherwise(F.array().cast("array<double>"))
    spark.createDataFrame(pa.table(nodes)).select(c["tree"].alias("treeID"), F.struct(
        c["id"].alias("id"), "prediction", "impurity", F.array("n", "s", "q").alias("impurityStats"),
        F.col("n").cast("long").alias("rawCount"), "gain", c["left"].alias("leftChild"),
        c["right"].alias("rightChild"), F.struct(
            c["feature"].alias("featureIndex"), point.alias("leftCategoriesOrThreshold"),
            F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData")).write.parquet(
        os.path.join(path, "data"))
    return GBTRegressionModel.load(path)
