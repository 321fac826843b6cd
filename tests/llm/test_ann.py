import numpy as np

from txlake.llm import ann

ROWS = "vec_id long, embedding array<float>, label int, node string, shard string, id string"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "k", "k", "k") for i, v in vectors], ROWS)


def brute(vectors, k, every):
    good = {}
    for i, v in vectors:
        if i is None or v is None or None in v or len(v) != 8:
            continue
        x = np.array(v, dtype=np.float32).astype(float)
        if np.isfinite(x).all() and x.any():
            good[(i, x.tobytes())] = x
    out = {}
    for q, key in good:
        if q % every == 0:
            near = sorted((-float((good[q, key] * x).sum()), i) for (i, _), x in good.items() if i != q)[:k]
            out.setdefault((q, key), [(i, -s) for s, i in near])
    return {q: near for (q, _), near in out.items()}


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for n, (rank, i, s) in enumerate(sorted(x), 1) if rank == n] for q, x in out.items()}


def test_exact_where_shards_are_small(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(150)]
    same = vectors[0][1]
    vectors += [(200 + i, same) for i in range(60)]
    vectors += [(500, None), (520, [0.0] * 8), (540, [1.0] * 7 + [None]), (560, [1.0] * 7 + [float("nan")]), (580, [float("inf")] * 8), (600, [1.0] * 3), (None, same), (20, vectors[20][1])]
    got, want = result(ann.nearest(make(spark, vectors), k=10, every=10, shard_points=40)), brute(vectors, 10, 10)
    assert set(got) == set(want)
    hits = 0
    for q in want:
        assert len(got[q]) == 10
        hits += len({i for i, _ in got[q]} & {i for i, _ in want[q]})
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
    assert hits >= 0.98 * 10 * len(want)
    # All 61 copies tie; the smallest ids come first.
    copies = [i for i, _ in got[200] if i == 0 or i > 200]
    assert copies and copies == [0, *range(201, 261)][: len(copies)]


def test_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 8))
    vectors = [(i, (centres[i % 10] + 0.5 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(3000)]
    got, want = result(ann.nearest(make(spark, vectors), shard_points=1000)), brute(vectors, 20, 20)
    found = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert found >= 0.95


def test_few_and_none(spark):
    got = result(ann.nearest(make(spark, [(20, [1.0, 0.0]), (3, [2.0, 0.0]), (40, [1.0, 1.0])]), k=5))
    assert got == {20: [(3, 2.0), (40, 1.0)], 40: [(3, 2.0), (20, 1.0)]}
    assert ann.nearest(make(spark, [])).count() == 0
    assert ann.nearest(make(spark, [(20, [1.0, 0.0])])).count() == 0
    assert ann.nearest(make(spark, [(21, [1.0, 0.0]), (22, [1.0, 0.5])])).count() == 0


def test_pruning_keeps_diverse_edges():
    points = np.array([[1, 0, 0], [0.9, np.sqrt(1 - 0.81), 0], [0.89, np.sqrt(1 - 0.89**2), 0], [0.6, 0, 0.8]], dtype=np.float32)
    kept = ann.robust_prune(np.array([0]), np.array([[1, 2, 3, 1, 0, -1]]), points, 3, 1.2)
    assert kept.tolist() == [[1, 3, -1]]


def test_recall_beside_long_vectors(spark):
    """One vector of length 1e4 among unit vectors, and lengths over four orders of magnitude."""
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(3000, 8))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for lengths in (np.where(np.arange(3000) == 7, 1e4, 1.0), 10 ** rng.uniform(-2, 2, size=3000)):
        vectors = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(unit * lengths[:, None])]
        got, want = result(ann.nearest(make(spark, vectors), shard_points=1000)), brute(vectors, 20, 20)
        found = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
        assert found >= 0.95


def test_every_number_of_components(spark):
    """Each query meets the vectors of its own number of components; none is left out for being rarer."""
    rng = np.random.default_rng(4)
    vectors = [(i, rng.normal(size=(8, 5, 3)[i % 3]).astype(np.float32).tolist()) for i in range(240)] + [(1000, [1.0, 2.0])]
    got = result(ann.nearest(make(spark, vectors), k=10, every=10, shard_points=100))
    want = {}
    for q, v in vectors:
        near = sorted((-float(np.dot(np.array(v), np.array(w))), i) for i, w in vectors if i != q and len(w) == len(v))[:10]
        if q % 10 == 0 and near:
            want[q] = [i for _, i in near]
    assert set(got) == set(want) and len(want) == 24
    assert np.mean([len({i for i, _ in got[q]} & set(want[q])) / 10 for q in want]) >= 0.98


def test_bands_and_added_coordinate():
    vecs = np.array([[1e4, 0.0], [1.0, 0.0], [0.6, 0.8], [2600.0, 0.0], [1e-200, 0.0]])
    bands = ann.length_bands(vecs)
    assert bands[0] == bands[3] == 0 and bands[1] == bands[2] > 0 and bands[4] > bands[1]
    # Two short vectors beside a long one keep their distance.
    points = ann._same_length(vecs[:3]) * 1e4
    assert np.isclose(((points[1] - points[2]) ** 2).sum(), 0.4**2 + 0.8**2)
