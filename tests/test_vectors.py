import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphvec.errors import CollectionNotFound, EngineInitialization, InvalidValue
from graphvec.functions.vectors import PROFILES
from graphvec.operators import hybrid, vector
from graphvec.schema import POINTS
from graphvec.sources.collections import CollectionStore


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 8)).astype(np.float32)
    v[7] = v[3]
    rows = [(f"p{i:02d}", None, v[i].tolist(), f'{{"n":{i}}}') for i in range(60)] + [("zero", None, [0.0] * 8, "{}"), ("none", None, None, None)]
    return spark.createDataFrame(rows, POINTS), v.astype(np.float64)


def exact(v, q, k):
    c = (v @ q) / np.linalg.norm(v, axis=1) / np.linalg.norm(q)
    return sorted(((-round(x, 12), f"p{i:02d}") for i, x in enumerate(c)))[:k]


def test_search_orders_ties_by_id_and_leaves_out_zero_vectors(points):
    df, v = points
    got = vector.search(df, v[3].tolist(), limit=100).collect()
    assert [r["id"] for r in got] == [i for _, i in exact(v, v[3], 100)] and len(got) == 60
    assert [r["id"] for r in got[:2]] == ["p03", "p07"]


@pytest.mark.parametrize(("limit", "clamp", "n"), [(0, False, 0), (-1, False, 0), (None, False, 15), (0, True, 1), (10_001, True, 60), (3, False, 3)])
def test_limits(points, limit, clamp, n):
    df, v = points
    assert vector.search(df, v[0].tolist(), limit=limit, clamp=clamp).count() == n


def test_search_needs_a_text_or_a_vector(points):
    with pytest.raises(InvalidValue):
        vector.search(points[0])


def test_batch_search_equals_search_in_any_blocking(spark, points):
    df, v = points
    q = spark.createDataFrame([(i, v[i].tolist()) for i in range(9)], "qid int, vector array<double>")
    for block in (2048, 4):
        got = vector.batch_search(df, q, 5, block=block).orderBy("qid", "rank").collect()
        assert [(r["qid"], r["id"]) for r in got] == [(i, p) for i in range(9) for _, p in exact(v, v[i], 5)]
    near = sum(c < -0.999 for i in range(9) for c, _ in exact(v, v[i], 5))  # each finds itself, 3 and 7 each other
    assert near == 11 and vector.batch_search(df, q, 5, min_cosine=0.999).count() == near
    assert vector.batch_search(df, q, 0).count() == 0


def test_similarity_edges_equal_brute_force(points):
    df, v = points
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    c = u @ u.T
    want = {(f"p{i:02d}", f"p{j:02d}") for i in range(60) for j in range(i + 1, 60) if c[i, j] > 0.5}
    for rows in (2000, 16):
        got = vector.similarity_edges(df, 0.5, rows).collect()
        assert {(r["u"], r["v"]) for r in got} == want and len(got) == len(want)


def test_approximate_search_recall(spark, points):
    df, v = points
    q = spark.createDataFrame([(i, v[i].tolist()) for i in range(20)], "qid int, vector array<double>")
    near = {(r["qid"], r["id"]) for r in vector.approximate_search(df.where("vector is not null"), q, 5).collect()}
    want = {(i, p) for i in range(20) for _, p in exact(v, v[i], 5)}
    assert len(near & want) >= 0.9 * len(want)


def test_profiles(spark):
    r = spark.range(1).select(*[f(F.lit(0.5)).alias(n) for n, f in PROFILES.items()]).first()
    assert (r["distance"], r["redis_norm"]) == (0.5, 0.75)
    assert r["opensearch"] == pytest.approx(1 - 1 / 1.5) and r["azure"] == pytest.approx(1 / 1.5)


def test_upsert_replaces_whole_rows(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, payload string")
    new = spark.createDataFrame([("a", None, 1), ("c", "1", 1), ("c", "2", 2)], "id string, payload string, seq int")
    once = vector.upsert(old, new)
    assert {tuple(r) for r in once.collect()} == {("a", None), ("b", "y"), ("c", "2")}
    assert {tuple(r) for r in vector.upsert(once, new).collect()} == {tuple(r) for r in once.collect()}


@pytest.mark.parametrize("adapter, found", [("qdrant", {"1"}), ("redis", {"1"}), ("azureaisearch", {"1", "2"})])
def test_store_searches_for_many_texts(spark, tmp_path, adapter, found):
    store = CollectionStore(spark, str(tmp_path / "c"), adapter=adapter)
    rows = spark.createDataFrame([("1", "quantum computer", ["name"]), ("2", "quantum sandwich of cheese", ["name"])], "id string, name string, index_fields array<string>")
    asked = spark.createDataFrame([(7, "Quantum computer"), (8, None)], "qid int, text string")
    assert store.batch_search("Entity_name", asked).isEmpty() and store.hybrid_search("Entity_name", asked).isEmpty()
    store.index_data_points("Entity", "name", rows)
    got = store.batch_search("Entity_name", asked, with_vectors=True).collect()
    assert {r["id"] for r in got} == found and all(r["qid"] == 7 and json.loads(r["payload"])["id"] == r["id"] and r["vector"] for r in got)
    both = store.hybrid_search("Entity_name", asked, 1).collect()
    assert [(r["qid"], r["id"], r["rank"], round(r["score"], 9)) for r in both] == [(7, "1", 1, round(2 / 61, 9))]


def test_collection_store(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path / "c"), adapter="qdrant", prefix="T")
    assert not store.has_collection("Entity_name") and store.search("Entity_name", text="x").count() == 0
    rows = spark.createDataFrame([("1", "quantum computer", ["name"]), ("2", "cheese sandwich", ["name"])], "id string, name string, index_fields array<string>")
    store.index_data_points("Entity", "name", rows)
    store.index_data_points("Entity", "name", rows)
    assert store.read("Entity_name").count() == 2
    assert store.search("Entity_name", text="Quantum computer", limit=1).first()["id"] == "1"
    with pytest.raises(CollectionNotFound):
        store.create_data_points("missing", store.read("Entity_name").withColumn("seq", F.lit(1)))
    assert store.retrieve("Entity_name", spark.createDataFrame([("1",), ("9",)], "id string")).count() == 1
    assert store.delete_data_points("Entity_name", spark.createDataFrame([("1",), ("9",)], "id string")) == 1
    other = CollectionStore(spark, str(tmp_path / "c"), prefix="U")
    other.create_collection("a b")
    assert not other.has_collection("a-b")
    store.prune()
    assert not store.has_collection("Entity_name") and other.read("a b").count() == 0
    assert list((tmp_path / "c" / "data").iterdir()) == []
    with pytest.raises(CollectionNotFound):
        CollectionStore(spark, str(tmp_path / "c"), adapter="opensearch").search("none", text="x")
    with pytest.raises(EngineInitialization):
        CollectionStore(spark, "")


def test_rank_fusion(spark):
    left = spark.createDataFrame([(0, "a", 1), (0, "b", 2)], "qid int, id string, rank int")
    right = spark.createDataFrame([(0, "b", 1), (0, "c", 2)], "qid int, id string, rank int")
    got = hybrid.fuse(left, right, 2).orderBy("rank").collect()
    assert [r["id"] for r in got] == ["b", "a"] and got[0]["score"] == pytest.approx(1 / 61 + 1 / 62)


def test_approximate_search_of_an_empty_collection(spark):
    from graphvec.operators import vector

    none = spark.createDataFrame([], "id bigint, vector array<float>")
    asked = spark.createDataFrame([(1, [1.0, 2.0])], "qid bigint, vector array<float>")
    assert vector.approximate_search(none, asked.limit(0)).count() == 0


def test_approximate_search_shuffles_no_pairs(spark):
    """Rows of near buckets in some table, as counted by hand, and no join of queries with rows."""
    r = np.random.default_rng(3)
    v, q = r.normal(size=(60, 6)), r.normal(size=(5, 6))
    schema = lambda key: f"{key} bigint, vector array<double>"
    rows, asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], schema("id")), spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], schema("qid"))
    found = vector.approximate_search(rows, asked, 60, tables=2, bits=5, block=2)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    planes = np.random.default_rng(42).normal(size=(2, 5, 6))
    sides = lambda x: np.einsum("nd,tbd->ntb", x, planes) > 0
    near = ((sides(q)[:, None] != sides(v)[None]).sum(axis=3) <= 1).any(axis=2)
    assert {(x["qid"], x["id"]) for x in found.collect()} == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


def test_search_holds_a_slice_of_the_scores():
    """The best and their ties from a slice of queries; rows without a cosine are none."""
    score = np.array([[0.1, 0.5, 0.5, np.nan], [np.nan, np.nan, np.nan, 0.2]])
    row, col = vector._best(score, 1)
    assert list(zip(row.tolist(), col.tolist())) == [(0, 1), (0, 2), (1, 3)] and vector.SCORE_ROWS * 10_000 * 8 < 1 << 23
