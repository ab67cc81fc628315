import numpy as np

from millrace.llm import multiindex

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and good(a[1]) and good(b[1]) and a[2] is not None and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                near[i, j] = x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold
    least = [r[0] for r in rows]
    for _ in range(n):
        least = [min([least[i], *(least[j] for j in np.flatnonzero(near[i]))]) for i in range(n)]
    return {rows[k][0]: (int(near[k].sum()), least[k], least[k] == rows[k][0]) for k in range(n)}


def cases():
    rng = np.random.default_rng(7)
    rows = []
    for label in (1, 2):
        for _ in range(12):
            centre = rng.normal(size=16)
            for _ in range(rng.integers(1, 12)):
                rows.append((len(rows), (centre + rng.normal(size=16) * rng.choice([0, 0.05, 0.15])).astype(np.float32).tolist(), label))
    one = rows[0][1]
    odd = [None, [], [0.0] * 16, [float("nan")] + one[1:], [float("inf")] + one[1:], [None] + one[1:], one[:8], one]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)]
    rows += [(2000, one, None), (2001, one, None), (2002, [x * 3 for x in one], 1)]
    return rows


def test_against_brute_force(spark, rows_of):
    rows = cases()
    table = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'x' as node", "1 as copies").repartition(3)
    expected = brute(rows)
    for cell in (multiindex.CELL, 3):
        found = rows_of(multiindex.link_vectors(table, cell=cell))
        assert {k: v[0] for k, v in found.items()} == expected


def test_nothing_usable(spark):
    table = spark.createDataFrame([(1, None, 1), (None, [1.0, 0.0], 1), (2, [1.0], None)], SHAPE)
    found = sorted(((r.vec_id or 0), r.n_links, r.kept) for r in multiindex.link_vectors(table).collect())
    assert found == [(0, 0, True), (1, 0, True), (2, 0, True)]
    assert multiindex.link_vectors(table.limit(0)).count() == 0


def test_traversal_is_ascending_and_whole():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.random(9), rng.random(7)
        cells = multiindex.traverse(a, b, 0.8)
        sums = [a[i] + b[j] for i, j in cells]
        assert sums == sorted(sums)
        assert set(cells) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= 0.8}


def test_borders_never_hide_a_match():
    rng = np.random.default_rng(5)
    words, x = rng.normal(size=(20, 6)), rng.normal(size=(400, 6))
    own, bound = multiindex._bounds(x, words)
    for i in range(0, 400, 7):
        d = ((x - x[i]) ** 2).sum(1)
        assert (bound[i][own] <= d + 1e-9).all()
