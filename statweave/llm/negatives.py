"""Hard-negative mining with rotated one-bit codes.

Index.  A vector is rotated and kept as its signs (one bit a dimension)
together with the alignment of the sign vector with it: the length of its
projection on that direction.  What the projection leaves over is rotated anew
and coded the same way, ``STAGES`` times; the length of the last rest is kept.
Every row is coded, beside its exact integer vector.

Search.  An anchor's rotated vectors are cut into bit planes, so that its
product with a sign vector is a sum of popcounts.  The popcount estimates of
the stages add up to an estimate of the score; the exact score lies within

    sum of alignment * (error of the bit planes)
    + rest * sqrt(|q|^2 - (part of q along the last sign vector)^2),

the latter by Cauchy-Schwarz, since the rest is orthogonal to the last sign
vector.  The bound is deterministic, so a pair is left out only if its whole
interval misses the scores asked for; each pair that survives all stages is
scored on the integers.

Over the table.  Anchors are the query set: they are taken in batches of
bounded size, each broadcast to all tasks, which stream the index past it.  A
first pass finds every anchor's positives, a second one the best negatives in
the score band of each positive; tasks send their best few only, and Spark
merges them.  The results of a batch are written before the next one starts.

Defined cases: rows with a null label, a null vector or a null or non-finite
entry take no part; shorter vectors are filled up with zeros; entries beyond
+-2^22 after scaling count as that; rows are told apart by place, not by id, so
repeated rows are rows of their own; ties go to the smaller id, null ids last,
then to the earlier row; a row with a null id is no anchor but can be a
positive or negative; a positive without negatives in its band has no result;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .vectors import dense, dimension, finite, scaled_floor

SCALE, LIMIT = 256, 1 << 22
STAGES = 6
# Stages estimated for all pairs of a block; the others for survivors only.
DENSE_STAGES = 4
PLANES = 8
POSITIVES, NEGATIVES = 5, 3
# A negative's score in hundredths of the positive's.
BAND = (50, 95)
# Bytes of a batch of anchors (integer vectors, beside them planes as large).
BATCH_BYTES = 2 << 20
ANCHOR_BLOCK, ROW_BLOCK = 256, 2048
SEED = 20
NO_ID = np.iinfo(np.int64).max
LOWEST = np.iinfo(np.int64).min
INDEX = ("rid long, vec_id long, label int, anchor boolean, vector binary, codes binary, "
         "alignment binary, rest double, norm double")


# ---- codes -----------------------------------------------------------------

class Rotations:
    """Fixed random rotations, one a stage, for vectors of ``dim`` entries."""

    def __init__(self, dim: int):
        self.words = max(1, -(-dim // 64))
        self.dim, self.wide = dim, 64 * self.words
        rng = np.random.default_rng(SEED)
        self.stages = [np.linalg.qr(rng.normal(size=(self.wide, self.wide)))[0]
                       for _ in range(STAGES)]

    def widen(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x.astype(np.float64), ((0, 0), (0, self.wide - x.shape[1])))

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sign bits (rows, stages, words), alignments (rows, stages) as
        factors of the +-1 sign vectors, and the length of the last rest."""
        left = self.widen(x)
        codes = np.empty((len(x), STAGES, self.words), np.uint64)
        align = np.empty((len(x), STAGES))
        for s, rotation in enumerate(self.stages):
            left = left @ rotation
            bits = left > 0
            codes[:, s] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
            align[:, s] = np.abs(left).sum(axis=1) / self.wide
            left = left - np.where(bits, 1.0, -1.0) * align[:, s, None]
        return codes, align, np.sqrt((left * left).sum(axis=1))


class Anchors:
    """A block of anchors of one label, cut into bit planes for every stage."""

    def __init__(self, rotations: Rotations, number: np.ndarray, rid: np.ndarray, x: np.ndarray):
        self.number, self.rid, self.x = number, rid, x.astype(np.int64)
        q = rotations.widen(x)
        self.norm = np.sqrt((q * q).sum(axis=1))
        self.low, self.step, self.sum, self.error, self.planes = [], [], [], [], []
        for rotation in rotations.stages:
            q = q @ rotation
            low = q.min(axis=1)
            step = (q.max(axis=1) - low) / (2 ** PLANES - 1)
            step[step == 0] = 1.0
            level = np.rint((q - low[:, None]) / step[:, None])
            self.low.append(low)
            self.step.append(step)
            self.sum.append(q.shape[1] * low + step * level.sum(axis=1))
            self.error.append(np.abs(q - low[:, None] - step[:, None] * level).sum(axis=1))
            level = level.astype(np.uint8)
            self.planes.append(np.stack([
                np.packbits((level >> j) & 1, axis=1, bitorder="little").view(np.uint64)
                for j in range(PLANES)]))

    def products(self, s: int, codes: np.ndarray, a=None, r=None) -> np.ndarray:
        """Products with the sign vectors of stage ``s``: of all anchors with
        all rows, or of the pairs (a, r)."""
        pairs = a is not None
        kind = np.uint16 if codes.shape[2] <= 4 else np.uint32  # holds 255 * bits
        total = ones = kind(0)
        for w in range(codes.shape[2]):
            bits = codes[:, s, w]
            count = np.bitwise_count(bits)
            ones = ones + (count[r] if pairs else count).astype(kind)
            bits = bits[r] if pairs else bits[None, :]
            for j in range(PLANES):
                plane = self.planes[s][j, :, w]
                both = np.bitwise_count(bits & (plane[a] if pairs else plane[:, None]))
                total = total + (both.astype(kind) << kind(j))
        pick = (lambda v: v[a]) if pairs else (lambda v: v[:, None])
        return (2 * (pick(self.low[s]) * ones + pick(self.step[s]) * total) - pick(self.sum[s]))


class Rows:
    """Rows of one block of the index."""

    def __init__(self, batch: pa.RecordBatch, dim: int, words: int):
        def flat(name: str, kind) -> np.ndarray:
            col = batch.column(name)
            at = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
            return np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind)

        n = batch.num_rows
        self.rid = batch.column("rid").to_numpy()
        self.label = batch.column("label").to_numpy()
        self.null = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
        self.vec_id = batch.column("vec_id").fill_null(NO_ID).to_numpy()
        self.x = flat("vector", np.int32).reshape(n, dim)
        self.codes = flat("codes", np.uint64).reshape(n, STAGES, words)
        self.align = flat("alignment", np.float64).reshape(n, STAGES)
        self.rest, self.norm = batch.column("rest").to_numpy(), batch.column("norm").to_numpy()

    def take(self, rows: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        out.__dict__ = {k: v[rows] for k, v in self.__dict__.items()}
        return out

    def __len__(self) -> int:
        return len(self.rid)


def rest_after(rows: Rows, s: int) -> np.ndarray:
    """Length of what stages 0..s leave over: the last rest and the later
    alignments are orthogonal steps."""
    wide = 64 * rows.codes.shape[2]
    return np.sqrt(rows.rest ** 2 + wide * (rows.align[:, s + 1:] ** 2).sum(axis=1))


def survivors(q: Anchors, rows: Rows, allowed, wanted) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) whose score interval ``wanted`` cannot rule out.

    ``allowed`` is a mask of pairs or None; ``wanted(anchor, low, high)``
    says for intervals which may hold a score asked for (``anchor`` is None
    for the whole block)."""
    wide = 64 * rows.codes.shape[2]
    slack = 1e-9 * rows.norm
    est = spread = 0.0
    for s in range(DENSE_STAGES):
        dot = q.products(s, rows.codes)
        est = est + rows.align[:, s] * dot
        spread = spread + rows.align[:, s] * q.error[s][:, None]
    along = np.maximum(np.abs(dot) - q.error[s][:, None], 0) ** 2 / wide
    across = np.sqrt(np.maximum(q.norm[:, None] ** 2 - along, 0))
    half = spread + rest_after(rows, s) * across + slack * q.norm[:, None] + 1e-6
    keep = wanted(None, est - half, est + half)
    if allowed is not None:
        keep &= allowed
    a, r = np.nonzero(keep)
    est, spread = est[a, r], spread[a, r]
    for s in range(DENSE_STAGES, STAGES):
        if not a.size:
            break
        dot = q.products(s, rows.codes, a, r)
        est = est + rows.align[r, s] * dot
        spread = spread + rows.align[r, s] * q.error[s][a]
        along = np.maximum(np.abs(dot) - q.error[s][a], 0) ** 2 / wide
        across = np.sqrt(np.maximum(q.norm[a] ** 2 - along, 0))
        half = spread + rest_after(rows, s)[r] * across + slack[r] * q.norm[a] + 1e-6
        keep = wanted(a, est - half, est + half)
        a, r, est, spread = a[keep], r[keep], est[keep], spread[keep]
    return a, r


def integer_scores(q: Anchors, rows: Rows, a: np.ndarray, r: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    for at in range(0, len(a), 1 << 16):
        part = slice(at, at + (1 << 16))
        out[part] = np.einsum("ij,ij->i", q.x[a[part]], rows.x[r[part]].astype(np.int64))
    return out


class Best:
    """The best ``k`` entries of each group: score falling, id rising (nulls
    last), row rising."""

    def __init__(self, numbers: np.ndarray, k: int):
        self.numbers, self.k = numbers, k  # of the groups, as sent to Spark
        self.threshold = np.full(len(numbers), LOWEST)
        self.held = [np.zeros(0, np.int64) for _ in range(5)]

    def offer(self, group, score, null, vec_id, rid) -> None:
        if not len(group):
            return
        g, s, n, v, i = (np.concatenate([old, np.asarray(new, np.int64)])
                         for old, new in zip(self.held, (group, score, null, vec_id, rid)))
        order = np.lexsort((i, v, n, -s, g))
        g = g[order]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.r_[first, len(g)]))
        order, place = order[place < self.k], place[place < self.k]
        self.held = [col[order] for col in (np.concatenate([self.held[0], group]), s, n, v, i)]
        full = place == self.k - 1
        self.threshold[self.held[0][full]] = self.held[1][full]

    def batch(self, names: list[str]) -> pa.RecordBatch:
        g, s, n, v, i = self.held
        return pa.RecordBatch.from_arrays(
            [pa.array(self.numbers[g], pa.int64()), pa.array(s), pa.array(v, mask=n.astype(bool)),
             pa.array(i)], names=names)


# ---- tasks -----------------------------------------------------------------

def anchor_blocks(rotations: Rotations, batch: dict[str, np.ndarray]) -> list[tuple[int, Anchors]]:
    """Blocks of anchors of one label each, with their label."""
    out = []
    for label in np.unique(batch["label"]):
        at = np.flatnonzero(batch["label"] == label)
        for k in range(0, len(at), ANCHOR_BLOCK):
            part = at[k:k + ANCHOR_BLOCK]
            out.append((label, Anchors(rotations, part, batch["rid"][part], batch["x"][part])))
    return out


def row_blocks(batches: Iterator[pa.RecordBatch], dim: int, words: int) -> Iterator[Rows]:
    for b in batches:
        for at in range(0, b.num_rows, ROW_BLOCK):
            yield Rows(b.slice(at, ROW_BLOCK), dim, words)


def offer_positives(q: Anchors, rows: Rows, best: Best) -> None:
    """Rows of the anchors' label against the best positives so far."""
    def wanted(a, low, high):
        if a is not None:
            return high >= bound[a]
        if len(rows) > best.k:
            # As many rows as asked for reach this, the anchor itself apart.
            sure = np.partition(low, len(rows) - best.k - 1, axis=1)[:, len(rows) - best.k - 1]
            np.maximum(bound, sure, out=bound)
        return high >= bound[:, None]

    bound = best.threshold.astype(np.float64)
    a, r = survivors(q, rows, rows.rid[None, :] != q.rid[:, None], wanted)
    score = integer_scores(q, rows, a, r)
    best.offer(a, score, rows.null[r], rows.vec_id[r], rows.rid[r])


def offer_negatives(q: Anchors, rows: Rows, floor: np.ndarray, ceiling: np.ndarray,
                    best: Best) -> None:
    """Rows of other labels against the best of every band so far; ``floor``
    and ``ceiling`` (anchor, slot) bound the scores of a band."""
    low_end, high_end = floor[q.number], ceiling[q.number]
    slots = low_end.shape[1]
    bound = np.maximum(low_end, best.threshold.reshape(-1, slots))
    live = bound <= high_end
    if not live.any():
        return
    least = np.where(live, bound, NO_ID).min(axis=1).astype(np.float64)
    most = np.where(live, high_end, LOWEST).max(axis=1).astype(np.float64)

    def wanted(a, low, high):
        if a is None:
            return (high >= least[:, None]) & (low <= most[:, None])
        keep = np.zeros(len(a), bool)
        for j in range(slots):
            keep |= live[a, j] & (high >= bound[a, j]) & (low <= high_end[a, j])
        return keep

    a, r = survivors(q, rows, None, wanted)
    score = integer_scores(q, rows, a, r)
    pair, slot = np.nonzero((score[:, None] >= bound[a]) & (score[:, None] <= high_end[a]))
    a, r = a[pair], r[pair]
    best.offer(a * slots + slot, score[pair], rows.null[r], rows.vec_id[r], rows.rid[r])


# ---- over the table ----------------------------------------------------------

def build_index(rows: DataFrame, dim: int) -> DataFrame:
    """Integer vector, codes, alignments and rest of every row of (vec_id,
    label, anchor, embedding), written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations = Rotations(dim)
        for b in batches:
            x = scaled_floor(dense(b.column("embedding"), dim), SCALE, LIMIT)
            codes, align, rest = rotations.code(x)
            norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))

            def binary(m: np.ndarray, kind) -> pa.Array:
                return pa.array([row.tobytes() for row in np.ascontiguousarray(m, kind)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("rid", "vec_id", "label", "anchor")), binary(x, np.int32),
                 binary(codes, np.uint64), binary(align, np.float64), pa.array(rest), pa.array(norm)],
                names=["rid", "vec_id", "label", "anchor", "vector", "codes", "alignment", "rest",
                       "norm"])

    spark = rows.sparkSession
    path = scratch_path(spark, "one-bit-index")
    # The number of a row is its place among the input files' splits, and is
    # fixed once the index is written.
    (rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long"),
                 F.col("label").cast("int"), F.coalesce("anchor", F.lit(False)).alias("anchor"),
                 "embedding").mapInArrow(run, INDEX).write.parquet(path))
    return spark.read.parquet(path)


FOUND = "group_no long, score long, vec_id long, rid long"
FOUND_NAMES = ["group_no", "score", "vec_id", "rid"]


def _best_per_group(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("group_no").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("rid"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))


def _mine_batch(index: DataFrame, dim: int, batch: pa.Table) -> tuple[DataFrame, tuple]:
    """Result rows for one batch of anchors, and the broadcasts that they
    read."""
    spark = index.sparkSession
    words = max(1, -(-dim // 64))
    n = batch.num_rows
    data = {"label": batch["label"].to_numpy(), "rid": batch["rid"].to_numpy(),
            "x": np.frombuffer(b"".join(batch["vector"].to_pylist()), np.int32)
                   .reshape(n, dim)}
    shared = spark.sparkContext.broadcast(data)

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(label, q, Best(q.number, POSITIVES))
                  for label, q in anchor_blocks(Rotations(dim), shared.value)]
        for rows in row_blocks(batches, dim, words):
            of = {x: rows.take(np.flatnonzero(rows.label == x)) for x in np.unique(rows.label)}
            for label, q, best in blocks:
                if label in of:
                    offer_positives(q, of[label], best)
        for _, _, best in blocks:
            yield best.batch(FOUND_NAMES)

    found = _best_per_group(index.mapInArrow(positives, FOUND), POSITIVES)
    # At most POSITIVES rows an anchor of the batch.
    got = found.select("group_no", "rank", "score", "vec_id").toArrow()
    anchor, slot = got["group_no"].to_numpy(), got["rank"].to_numpy() - 1
    score = got["score"].to_numpy()
    floor = np.zeros((n, POSITIVES), np.int64)
    ceiling = np.full((n, POSITIVES), LOWEST)  # no such positive
    floor[anchor, slot] = -(-BAND[0] * score // 100)
    ceiling[anchor, slot] = BAND[1] * score // 100
    bands = spark.sparkContext.broadcast((floor, ceiling))

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.arange(POSITIVES)
        blocks = [(label, q, Best((q.number[:, None] * POSITIVES + slots).ravel(), NEGATIVES))
                  for label, q in anchor_blocks(Rotations(dim), shared.value)]
        floor, ceiling = bands.value
        for rows in row_blocks(batches, dim, words):
            others = {}
            for label, q, best in blocks:
                if label not in others:
                    others[label] = rows.take(np.flatnonzero(rows.label != label))
                if len(others[label]):
                    offer_negatives(q, others[label], floor, ceiling, best)
        for _, _, best in blocks:
            yield best.batch(FOUND_NAMES)

    ids = batch["vec_id"].to_numpy()
    pairs = spark.createDataFrame(pa.table({
        "group_no": pa.array(anchor * POSITIVES + slot), "anchor_id": pa.array(ids[anchor]),
        "positive_id": got["vec_id"], "positive_score": got["score"]}))
    # ``pairs`` has at most POSITIVES rows an anchor of the batch.
    out = (_best_per_group(index.mapInArrow(negatives, FOUND), NEGATIVES)
           .join(F.broadcast(pairs), "group_no")
           .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                   F.col("vec_id").alias("negative_id"), "positive_score",
                   F.col("score").alias("negative_score")))
    return out, (shared, bands)


RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def mine(rows: DataFrame) -> DataFrame:
    """Hard negatives of the rows of (vec_id, label, anchor, embedding) whose
    ``anchor`` is true: for each of an anchor's best rows of its own label the
    best rows of other labels that score within ``BAND`` hundredths of it."""
    spark = rows.sparkSession
    rows = finite(rows.filter(F.col("label").isNotNull()), "embedding")
    dim = dimension(rows, "embedding")
    index = build_index(rows, max(dim, 1))
    dim = max(dim, 1)
    anchors = index.filter(F.col("anchor") & F.col("vec_id").isNotNull()).select(
        "rid", "vec_id", "label", "vector")
    n = anchors.count()
    if not n:
        return spark.createDataFrame([], RESULT)
    batches = -(-n * dim * 4 // BATCH_BYTES)
    path = scratch_path(spark, "hard-negatives")
    for k in range(batches):
        part = anchors.filter(F.pmod(F.xxhash64("rid"), F.lit(batches)) == k).toArrow()
        if part.num_rows:
            out, held = _mine_batch(index, dim, part)
            out.write.parquet(f"{path}/batch={k}")
            for b in held:
                b.destroy()
    return spark.read.schema(RESULT).parquet(path).select(*[c.split()[0] for c in RESULT.split(", ")])


def report(rows: DataFrame) -> DataFrame:
    """Hard negatives over (vec_id, label, embedding): anchors are the ids
    divisible by 50; where the id is divisible by 7 the label moves on by one,
    modulo 10."""
    vec_id = F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", label.alias("label"), (vec_id % 50 == 0).alias("anchor"),
                            "embedding"))
