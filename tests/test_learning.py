"""Online learners: the k-means update equals the textbook weighted mean,
a dying cluster is split, and regression recovers a known line."""
import numpy as np

from tidewater.operators.learning import KMeansModel, LinearModel, cluster_sums, least_squares, regression_moments


def test_kmeans_update_rule(spark):
    pts = [(0.0, 0.0), (0.2, 0.0), (10.0, 10.0), (10.0, 12.0), (11.0, 11.0)]
    df = spark.createDataFrame(pts, "a double, b double")
    m = KMeansModel.from_centres([[0.0, 0.0], [10.0, 10.0]], weight=2.0, decay=0.5)
    m.train_batch(df, ["a", "b"])
    # weights 2*0.5=1, then + 2 and + 3 points
    np.testing.assert_allclose(m.weights, [3.0, 4.0])
    np.testing.assert_allclose(m.centres[0], (np.array([0.0, 0.0]) * 1 + [0.2, 0.0]) / 3)
    np.testing.assert_allclose(m.centres[1], (np.array([10.0, 10.0]) * 1 + [31.0, 33.0]) / 4)


def test_kmeans_dead_cluster_is_split():
    m = KMeansModel.from_centres([[0.0, 0.0], [5.0, 5.0]], weight=0.0)
    m.update([(0, 4, [4.0, 0.0])])
    assert m.weights[0] == m.weights[1] == 2.0
    assert np.allclose(m.centres[0], [1.0, 0.0]) and np.allclose(m.centres[1], [1.0, 0.0])


def test_cluster_sums_nearest_first_on_ties(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    got = {r.cluster: (r.n, r.sum_x) for r in cluster_sums(df, ["x"], [[2.0], [2.0]]).collect()}
    assert got == {0: (2, 4.0)}


def test_regression_recovers_line(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal(2000)
    y = -0.995 * x + 0.01 * rng.standard_normal(2000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    mom = regression_moments(df, ["x"], "y").first().asDict()
    slope, icpt = least_squares(mom)
    assert abs(slope + 0.995) < 0.01 and abs(icpt) < 0.01
    m = LinearModel.zeros(1, iterations=200, step=1.0, tolerance=1e-9)
    for part in df.randomSplit([1.0] * 4, seed=3):
        m.train_batch(part, ["x"], "y")
    assert abs(m.weights[0] + 0.995) < 0.05 and abs(m.intercept) < 0.05
