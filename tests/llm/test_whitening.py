"""Whitening against numpy on small inputs."""

from __future__ import annotations

import numpy as np
import pytest

from tradewind.llm import whitening
from tradewind.llm.registry import llm_queries

SCHEMA = "vec_id long, embedding array<float>, label int, number string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b") for i, v in rows], SCHEMA)


def plain(x):
    """(n, deviations, eigenvalues, centred) of longs, in numpy."""
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    values, vectors = np.linalg.eigh((off / n).T @ (off / n) / n)
    return n, (off * off).sum(axis=1), values[::-1], off / n, vectors[:, ::-1]


def held(found, x, ids, components):
    n, deviations, values, centred, vectors = plain(x)
    k = min(components, x.shape[1])
    assert len(found) == n * k and {r.n for r in found} == {n}
    whitened = np.zeros((n, k))
    of = {}
    for r in found:
        of.setdefault(r.vec_id, {})[r.component] = r
    for row, i in enumerate(ids):
        assert sorted(of[i]) == list(range(1, k + 1))
        assert {r.deviation for r in of[i].values()} == {int(deviations[row])}
        whitened[row] = [of[i][c].whitened for c in range(1, k + 1)]
        explained = np.array([of[i][c].explained for c in range(1, k + 1)])
        assert np.allclose(explained, values[:k] / values.sum(), rtol=1e-9)
    for c in range(k):
        expected = centred @ vectors[:, c] / np.sqrt(values[c])
        sign = 1 if expected @ whitened[:, c] > 0 else -1
        assert np.allclose(whitened[:, c], sign * expected, atol=1e-7)
    product = whitened.T @ whitened / n - np.eye(k)
    assert abs(np.abs(product).max() - found[0].identity_error) < 1e-9 and found[0].identity_error < 1e-9


@pytest.mark.parametrize("width, components", [(40, 32), (7, 3)])
def test_same_as_numpy(spark, monkeypatch, width, components):
    # Several row blocks and several column blocks.
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 16)
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(150, width)) * np.linspace(0.3, 6, width)).astype(np.float32)
    v[::3] = v[0]  # a third of all rows are one vector
    rows = list(enumerate(v.tolist()))
    bad = [(900, None), (901, [None] * width), (902, [float("nan")] + [0.0] * (width - 1)),
           (903, [float("-inf")] + [0.0] * (width - 1)), (904, [])]
    found = whitening.whiten(frame(spark, rows + bad).repartition(5), components=components).collect()
    x = np.floor(64 * v.astype(float)).astype(np.int64) + 1_000_000
    held(found, x, range(150), components)


def test_registered_query(spark, sample):
    rows = spark.read.parquet(f"{sample}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float)).astype(np.int64) + 1_000_000
    held(llm_queries()["op12_whitening"](spark, sample).collect(), x, [r.vec_id for r in rows], 32)


def test_no_rows_no_variance_and_other_lengths(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert len(same) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(3, 0, None, None, None)}
    # One of two directions varies.
    line = {(r.vec_id, r.component): r for r in whitening.whiten(frame(spark, [(1, [1.0, 1.0]), (2, [3.0, 1.0])])).collect()}
    assert [abs(line[i, 1].whitened) for i in (1, 2)] == [1.0, 1.0] and line[1, 2].whitened is None
    assert (line[1, 1].explained, line[1, 2].explained, line[1, 1].deviation) == (1.0, 0.0, 128 ** 2)
    with pytest.raises(ValueError, match="entries"):
        whitening.whiten(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))
