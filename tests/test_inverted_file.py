import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphvec.operators import inverted_file, vector


def clustered(n=3000, dim=16, groups=30, seed=1):
    r = np.random.default_rng(seed)
    return r.normal(size=(groups, dim))[r.integers(0, groups, n)] + 0.3 * r.normal(size=(n, dim))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    v = clustered()
    rows = [(i, [float(x) for x in y]) for i, y in enumerate(v)] + [(5000, None), (5001, [0.0] * 16)]
    points = spark.createDataFrame(rows, "id int, vector array<float>").repartition(4)
    path = str(tmp_path_factory.mktemp("ivf") / "index")
    return points, path, inverted_file.build(points, path)


def test_recall_and_rows_read(spark, index):
    points, path, about = index
    asked = points.where("id % 100 = 0").select(F.col("id").alias("qid"), "vector")
    want = {(r["qid"], r["id"]): r["cosine"] for r in vector.batch_search(points, asked, 5).collect()}
    got = {(r["qid"], r["id"]): r["cosine"] for r in inverted_file.search(spark, path, asked, 5).collect()}
    assert len(set(got) & set(want)) >= 0.9 * len(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-6) for k in set(got) & set(want))
    read = inverted_file.rows_read(spark, path, asked).agg(F.avg("share")).first()[0]
    assert read < 0.2 and about["rows"] == 3000


def test_all_cells_find_all(spark, index):
    points, path, about = index
    asked = points.where("id < 30").select(F.col("id").alias("qid"), "vector").unionByName(spark.createDataFrame([(99, None)], "qid int, vector array<float>"))
    want = {(r["qid"], r["id"]) for r in vector.batch_search(points, asked, 3).collect()}
    for block in (7, 2048):
        assert {(r["qid"], r["id"]) for r in inverted_file.search(spark, path, asked, 3, about["cells"], block).collect()} == want


def test_only_probed_cells_are_read(spark, index):
    points, path, _ = index
    plan = inverted_file.search(spark, path, points.where("id = 1").select(F.col("id").alias("qid"), "vector"), 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell", plan)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_tiny_indexes(spark, tmp_path, n):
    points = spark.createDataFrame([(str(i), [1.0, float(i)]) for i in range(n)], "id string, vector array<float>")
    about = inverted_file.build(points, str(tmp_path / "i"))
    asked = spark.createDataFrame([("q", [1.0, 0.1])], "qid string, vector array<float>")
    got = inverted_file.search(spark, str(tmp_path / "i"), asked, 2).collect()
    assert about["rows"] == n and len(got) == min(n, 2) and (not got or min(got, key=lambda r: r["rank"])["id"] == "0")


def test_a_store_keeps_an_index_until_its_collection_changes(spark, tmp_path):
    from graphvec.sources.collections import CollectionStore

    v = clustered(300)
    points = spark.createDataFrame([(str(i), None, [float(x) for x in y], "{}", 0) for i, y in enumerate(v)], "id string, text string, vector array<float>, payload string, seq int")
    store = CollectionStore(spark, str(tmp_path / "c"), adapter="azureaisearch", buckets=2)
    store.create_data_points("p", points)
    asked = points.where("id < '15'").select(F.col("id").alias("qid"), "vector")
    found = lambda **k: {(r["qid"], r["id"], r["payload"]) for r in store.batch_search("p", asked, 4, **k).collect()}
    exact = found()
    assert store._index("p") is None and found(indexed=True) == exact
    assert store.build_index("p")["rows"] == 300
    path = store._index("p")
    assert path and len(found(indexed=True) & exact) >= 0.9 * len(exact)
    assert store.log.vacuum() == 1 and len(found(indexed=True) & exact) >= 0.9 * len(exact)
    store.delete_data_points("p", points.where("id = '0'"))
    assert store._index("p") is None and all(i != "0" for _, i, _ in found(indexed=True))
    assert store.log.names() == ["p", "p#index"] and store.has_collection("p")
