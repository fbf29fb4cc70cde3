import numpy as np

from tickloom.llm import pivots


def test_near_copies_of_one_vector_find_each_other(spark):
    rng = np.random.default_rng(3)
    n = 1500
    points = rng.normal(size=(n, 64))
    centre = rng.normal(size=64)
    points[: n // 3] = centre + 0.22 * rng.normal(size=(n // 3, 64))
    unit = pivots.normalised(points)
    near = unit @ unit.T >= pivots.COSINE
    np.fill_diagonal(near, False)
    schema = "vec_id bigint, label int, embedding array<double>"
    rows = [(i, 0, v) for i, v in enumerate(points.tolist())]
    table = spark.createDataFrame(rows, schema)
    found = {r.vec_id: r.n_links for r in pivots.near_vectors(table).collect()}
    wanted = near.sum(axis=1)
    assert wanted.sum() > n
    assert all(found[i] <= wanted[i] for i in range(n))
    assert sum(found.values()) >= 0.97 * wanted.sum()
