"""Whitening and hard negatives against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from statweave.llm import negatives, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, deviation string, rid long, x int"


def table(seed=0, n=300, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 10))
        v = (centres[label] + 0.4 * rng.normal(size=dim)) / 3
        rows.append((i, v.astype(np.float32).tolist(), label))
    nan, inf = float("nan"), float("inf")
    rows += [
        (50, rows[50][1], rows[50][2]),  # a repeated row
        (400, rows[50][1], rows[50][2]),  # the same vector under another id
        (None, rows[50][1], rows[50][2]), (None, rows[50][1], 3),
        (450, rows[7][1], None), (500, None, 1), (550, [0.1, None], 1), (600, [nan] * dim, 1),
        (650, [inf] + [0.1] * (dim - 1), 1), (700, [0.5, -0.25], 2), (750, [], 2),
        (800, [0.0] * dim, 4), (850, [0.0] * dim, 4),
    ]
    rows += [(900 + 7 * k, rows[3][1], 5) for k in range(30)]  # ties
    return [(*r, "d", 1, 2) for r in rows]


def write(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def clean(rows):
    return [r for r in rows if r[1] is not None and all(
        x is not None and np.isfinite(x) for x in r[1])]


def padded(rows, dim):
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r[1])] = np.array(r[1], np.float64)
    return out


# ---- hard negatives ---------------------------------------------------------

def mined(rows):
    rows = [r for r in clean(rows) if r[2] is not None]
    if not rows:
        return []
    x = np.floor(256 * padded(rows, max(1, max(len(r[1]) for r in rows)))).astype(np.int64)
    ids = [r[0] for r in rows]
    order = np.array([2 ** 62 if i is None else i for i in ids])
    label = np.array([(r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2] for r in rows])
    out = []
    for i, anchor in enumerate(ids):
        if anchor is None or anchor % 50:
            continue
        score = x @ x[i]
        by = np.lexsort((order, -score))
        positives = [j for j in by if j != i and label[j] == label[i]][:5]
        others = [j for j in by if label[j] != label[i]]
        for p in positives:
            found = [j for j in others if 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(anchor, ids[p], k + 1, ids[j], int(score[p]), int(score[j]))
                    for k, j in enumerate(found)]
    return out


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: [(x is None, x or 0) for x in r])


def same(rows, exp):
    return rows == sorted(exp, key=lambda r: [(x is None, x or 0) for x in r])


def test_negatives_query(spark, tmp_path):
    rows = table()
    got = result(queries.QUERIES["op11_one_bit_negatives"](spark, write(spark, rows, tmp_path)))
    assert len(got) > 20 and same(got, mined(rows))


@pytest.mark.parametrize("dim", [1, 70, 130])
def test_negatives_widths_in_batches(spark, tmp_path, monkeypatch, dim):
    monkeypatch.setattr(negatives, "BATCH_BYTES", 4 * dim * 4)  # about four anchors a batch
    monkeypatch.setattr(negatives, "ROW_BLOCK", 16)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 2)
    rows = table(dim, 260, dim)
    got = result(queries.QUERIES["op11_one_bit_negatives"](spark, write(spark, rows, tmp_path)))
    assert same(got, mined(rows))


def test_negatives_empty_and_without_anchor(spark, tmp_path):
    d = write(spark, [], tmp_path / "a")
    assert result(queries.QUERIES["op11_one_bit_negatives"](spark, d)) == []
    d = write(spark, [(1, [0.1, 0.2], 1, "", 1, 1), (2, [], 2, "", 1, 1)], tmp_path / "b")
    out = queries.QUERIES["op11_one_bit_negatives"](spark, d)
    assert result(out) == [] and out.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                                                 "positive_score", "negative_score"]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.sampled_from([1, 5, 64, 65, 200]),
       st.sampled_from([1, 100, negatives.LIMIT]))
def test_intervals_hold(seed, dim, reach):
    """Every interval contains the integer score, at every stage."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-reach, reach + 1, (30, dim))
    q = rng.integers(-reach, reach + 1, (7, dim))
    x[0], q[0] = 0, 0
    rotations = negatives.Rotations(dim)
    rows = object.__new__(negatives.Rows)
    rows.codes, rows.align, rows.rest = rotations.code(x)
    rows.x, rows.rid = x, np.arange(30)
    rows.norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    anchors = negatives.Anchors(rotations, np.arange(7), np.arange(7), q)
    exact = (q @ x.T).astype(float)

    def wanted(a, low, high):
        score = exact if a is None else exact[pairs]
        assert (low <= score).all() and (score <= high).all()
        return np.ones(low.shape, bool)

    pairs = np.nonzero(np.ones((7, 30), bool))
    a, r = negatives.survivors(anchors, rows, None, wanted)
    assert len(a) == 210
    assert (negatives.integer_scores(anchors, rows, a, r) == (q @ x.T)[a, r]).all()


# ---- whitening ----------------------------------------------------------------

MATRICES = {
    "random": np.cov(np.random.default_rng(1).normal(size=(200, 40)).T),
    "equal": np.eye(9), "pairs": np.diag([3.0, 3, 3, 1, 1, 0.5]), "one": np.array([[2.0]]),
    "two": np.array([[2.0, 1], [1, 2]]), "low rank": np.outer([1.0, 2, 3], [1.0, 2, 3]),
    "close": np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1)
    + np.diag(np.ones(20), -1),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_components(name):
    a = MATRICES[name]
    values, z = whitening.leading_components(a, 32)
    exp = np.linalg.eigvalsh(a)[::-1][:32]
    kept = exp[exp > 1e-12 * exp[0]]
    assert len(values) == len(kept) and np.allclose(values, kept, rtol=1e-12, atol=1e-13 * exp[0])
    assert np.abs(a @ z - z * values).max() < 1e-12 * exp[0]
    assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-12


def test_sturm_counts():
    rng = np.random.default_rng(2)
    d, e = rng.normal(size=12), rng.normal(size=11)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.concatenate([values - 1e-9, values + 1e-9])
    assert (whitening.sturm_counts(d, e, at) == (values[None] < at[:, None]).sum(axis=1)).all()


def test_whitening_query(spark, tmp_path):
    rows = clean(table(5, 300, 40))
    d = write(spark, table(5, 300, 40), tmp_path)
    out = queries.QUERIES["op13_sturm_whitening"](spark, d)
    got = out.toPandas()
    x = np.floor(64 * padded(rows, 40)) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert (got.n == n).all() and len(got) == 32 * n and got.identity_error.max() < 1e-10
    share = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(share, values[:32] / values.sum(), rtol=1e-10)
    exp = np.abs((x - s / n) @ vectors[:, :32] / np.sqrt(values[:32]))
    deviation = ((n * x - s) ** 2).sum(axis=1).astype(int)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    ids = [r[0] for r in rows]
    got_rows = sorted(((None if np.isnan(i) else int(i), int(v)) for i, v in
                       got[got.component == 1][["vec_id", "deviation"]].itertuples(index=False)), key=key)
    assert got_rows == sorted(zip(ids, deviation.tolist()), key=key)
    wide = got.dropna(subset=["vec_id"]).drop_duplicates(["vec_id", "component"]).pivot(
        index="vec_id", columns="component", values="whitened")
    for i, row in zip(ids, exp):
        if i is not None:
            assert np.allclose(np.abs(wide.loc[i]), row, atol=1e-6)


def test_whitening_empty_and_without_variance(spark, tmp_path):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for k, rows in enumerate([[], [(1, [0.5, 0.5], 1, "", 1, 1)] * 3, [(1, None, 1, "", 1, 1)],
                              [(1, [], 1, "", 1, 1)]]):
        out = queries.QUERIES["op13_sturm_whitening"](spark, write(spark, rows, tmp_path / str(k)))
        assert out.columns == columns and out.collect() == []


def test_whitening_huge_entries(spark):
    """Sums stay exact, and a deviation beyond 64 bits is null."""
    rows = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [2.0 ** 25, 2.0]), (4, [0.0, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {r.vec_id: r for r in whitening.whiten(df).collect()}
    assert out[1].deviation is None and out[4].n == 4
    x = np.array([[2.0 ** 31, 0], [-2.0 ** 31, 64], [2.0 ** 31, 128], [0, 16]])
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose(out[1].explained, values / values.sum(), rtol=1e-9)
    small = whitening.whiten(df.filter("vec_id > 3").union(spark.createDataFrame(
        [(5, [0.5, 0.0])], df.schema))).collect()
    assert {r.vec_id: r.deviation for r in small} == {4: 32 ** 2 + 16 ** 2, 5: 32 ** 2 + 16 ** 2}
