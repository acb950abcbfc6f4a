import math

import numpy as np
import pytest

from paddockflow.llm import whitening
from paddockflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n long, x string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows, scale=256, components=4):
    """(vec_id, x) of all sound rows, and the fit list's size, sums, eigenvalues and eigenvectors."""
    sound = [
        (i, [math.floor(scale * float(np.float32(c))) for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = np.array(sorted({tuple(x) for _, x in sound}), dtype=np.int64)
    centred = fit - fit.sum(axis=0) / len(fit)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    order = np.argsort(-values)[:components]
    return sound, len(fit), fit.sum(axis=0), values, values[order], vectors[:, order]


def check(got, rows, components=4):
    sound, n, sums, every, values, vectors = plain(rows, components=components)
    kept = int((values > 1e-9 * values[0]).sum())
    assert len(got) == len(sound) * kept
    want = {}
    for i, x in sound:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        want.setdefault(i, []).append((deviation, ((np.array(x) - sums / n) @ vectors) / np.sqrt(np.maximum(values, 1e-300))))
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and max(errors) <= 1e-9
    sign = {}
    for r in sorted(got, key=lambda r: -abs(r["whitened"])):
        k = r["component"] - 1
        assert r["n"] == n and abs(r["explained"] / (values[k] / every.sum()) - 1) < 1e-9
        mine = [w for d, w in want[r["vec_id"]] if d == r["deviation"]]
        assert mine
        near = min(mine, key=lambda w: abs(abs(w[k]) - abs(r["whitened"])))[k]
        if abs(near) > 1e-6:
            assert sign.setdefault(k, np.sign(near * r["whitened"])) == np.sign(near * r["whitened"])
        assert abs(abs(near) - abs(r["whitened"])) < 1e-8
    return kept


def run(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], SCHEMA)
    got = whitening.whitened(table, **options)
    assert got.columns == COLUMNS
    return got.collect()


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op12_embedding_whitening"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert check(got.collect(), rows) == 4


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(200, 6)) * [9, 5, 3, 2, 1, 0.5])]
    rows += [(i, rows[0][1]) for i in range(300, 500)]  # copies count once
    rows += [(7, rows[3][1]), (None, rows[5][1]), (600, [-0.001] * 6), (601, [-0.0] * 6)]
    odd = [(700, None), (701, []), (702, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (703, [float("nan")] * 6)]
    odd += [(704, [float("inf")] * 6), (705, [-float("inf")] + [0.0] * 5)]
    assert check(run(spark, rows + odd), rows) == 4
    assert {r["vec_id"] for r in run(spark, rows + [(800, [1.0, 2.0])])} == {i for i, _ in rows}


def test_less_rank_and_repeated_eigenvalues(spark):
    line = [(i, [float(i), 2.0 * i, -float(i)]) for i in range(40)]
    assert check(run(spark, line), line) == 1
    plane = [(10 * i + j, [float(i), float(j), 0.0, 1.0, 5.0]) for i in range(10) for j in range(10)]
    got = run(spark, plane)  # both eigenvalues are the same: any basis of the plane
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-9
    assert all(abs(r["explained"] - 0.5) < 1e-12 for r in got)
    cross = [(2 * i + s, [float(3 * (1 - 2 * s)) if i == k else 0.0 for k in range(5)]) for i in range(5) for s in (0, 1)]
    got = run(spark, cross)
    assert {r["component"] for r in got} == {1, 2, 3, 4} and max(r["identity_error"] for r in got) < 1e-9
    assert all(abs(r["explained"] - 0.2) < 1e-12 for r in got)


def test_nothing_to_whiten(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0])] * 3) == []
    assert run(spark, [(1, None), (2, [])]) == []
    with pytest.raises(Exception, match="or more after scaling"):
        run(spark, [(1, [1e30]), (2, [0.0])])


def test_early_stop_keeps_a_hidden_copy_of_an_eigenvalue(spark):
    """Forty dimensions, of which two share the largest variance."""
    draw = np.random.default_rng(8)
    base = draw.choice([-1.0, 1.0], size=(400, 40)) * np.array([64, 64, 32, 16, *[0.5] * 36])
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, -base]))]
    check(run(spark, rows), rows)
