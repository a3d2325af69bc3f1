import numpy as np

from ledgerline.llm import nearest as n


def _exact(rows, query, k):
    found = sorted((float(n.distances(np.array([v], float), np.array(query[1], float))[0]), i) for i, v in rows if i != query[0])
    return found[:k]


def test_same_neighbours_as_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 24)) * 3
    rows = [(i, (centres[i % 6] + rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(30)]  # ties
    monkeypatch.setattr(n, "VECTOR_BLOCK", 400)
    monkeypatch.setattr(n, "QUERY_BLOCK", 7)
    index, centre = n.build_index(n.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    asked = index.filter("vec_id % 100 = 0").selectExpr("vec_id AS query_id", "embedding")
    got = n.search(index, centre, asked).collect()
    for query in (r for r in rows if r[0] % 100 == 0):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query[0])
        assert [(r[2], r[1]) for r in mine] == _exact(rows, query, n.K)
        assert [r[0] for r in mine] == list(range(1, n.K + 1))


def test_estimates_are_within_their_bounds():
    rng = np.random.default_rng(2)
    x, q = rng.standard_normal((5000, 48)), rng.standard_normal((10, 48))
    centre, turn = x.mean(axis=0), n.rotation(48)
    square, error = n.estimates(*n.codes(x, centre, turn), (q - centre) @ turn)
    true = ((x[None] - q[:, None]) ** 2).sum(axis=2)
    assert (abs(square - true) <= error).mean() > 0.9999
    assert abs((square - true).mean()) < 0.05 * true.mean()


def test_messy(spark, monkeypatch, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0])]
    rows += [(6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = n.query(spark, str(tmp_path)).collect()
    # Only the rows 0, 1, 1, 100, 100 take part; fewer than ten candidates are all returned.
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [
        (0, 1, 100), (0, 2, 100), (0, 3, 1), (0, 4, 1), (100, 1, 0), (100, 2, 1), (100, 3, 1),
    ]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, rank int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert n.query(spark, str(tmp_path)).count() == 0
