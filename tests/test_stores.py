import json

import pytest

from graphvec.schema import EDGES, NODES
from graphvec.sources.graph_store import GraphStore, read_node_link, write_node_link
from graphvec.streaming import upserts
from graphvec.sources.collections import CollectionStore


def small(spark):
    n = spark.createDataFrame([("a", 0, "X", "A", None, {"p": "1"}), ("b", 1, "Y", None, None, {})], NODES)
    return n, spark.createDataFrame([("a", "b", "r", 0, "r", None, None, {})], EDGES)


def test_node_link_round_trip(spark, tmp_path):
    n, e = small(spark)
    write_node_link(n, e, str(tmp_path / "g"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    doc = json.loads(text)
    assert [x["id"] for x in doc["nodes"]] == ["a", "b"] and doc["links"][0]["key"] == "r"
    n2, e2 = read_node_link(spark, str(tmp_path / "g"))
    assert {(r["id"], r["type"], r["ord"]) for r in n2.collect()} == {("a", "X", 0), ("b", "Y", 1)}
    assert e2.first()["dst"] == "b" and n2.where("id = 'a'").first()["props"]["p"] == "1"


def test_node_link_times_and_ids(spark, tmp_path):
    u = "ABCDEF00-1111-2222-3333-444444444444"
    doc = {"nodes": [{"id": u, "updated_at": 1700000000000}, {"id": "x", "updated_at": "2024-01-02T03:04:05+00:00"}, {"id": "y"}], "links": []}
    (tmp_path / "g.json").write_text(json.dumps(doc))
    n, e = read_node_link(spark, str(tmp_path / "g.json"))
    assert [r["id"] for r in n.orderBy("ord").collect()] == [u.lower(), "x", "y"] and n.where("updated_at is null").count() == 1 and e.count() == 0
    (tmp_path / "bad.json").write_text(json.dumps({"nodes": [{"id": "x", "updated_at": "soon"}], "links": []}))
    with pytest.raises(Exception, match="unreadable time"):
        read_node_link(spark, str(tmp_path / "bad.json"))[0].collect()
    (tmp_path / "worse.json").write_text("not json")
    with pytest.raises(Exception):
        read_node_link(spark, str(tmp_path / "worse.json"))[0].collect()
    assert (tmp_path / "worse.json").read_text() == "not json"


def test_graph_store(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "s"))
    assert store.load()[0].count() == 0
    store.save(*small(spark))
    n, e = store.load()
    assert n.count() == 2 and e.count() == 1
    assert store.query("SELECT count(*) FROM nodes JOIN edges ON id = src").first()[0] == 1
    store.delete()
    assert store.load()[0].count() == 0 and [p.name for p in (tmp_path / "s").iterdir()] == ["commits"]
    store.delete()


def test_streamed_upserts(spark, tmp_path):
    n, e = small(spark)
    n.write.parquet(str(tmp_path / "in"))
    store = GraphStore(spark, str(tmp_path / "s"))
    source = spark.readStream.schema(NODES).parquet(str(tmp_path / "in"))
    upserts.stream_graph(source, None, store, str(tmp_path / "cp"))
    assert store.load()[0].count() == 2
    points = spark.createDataFrame([("1", "t", [1.0, 0.0], "{}", 0)], "id string, text string, vector array<float>, payload string, seq int")
    points.write.parquet(str(tmp_path / "p"))
    c = CollectionStore(spark, str(tmp_path / "c"))
    upserts.stream_points(spark.readStream.schema(points.schema).parquet(str(tmp_path / "p")), c, "x", str(tmp_path / "cp2")).awaitTermination()
    assert c.read("x").count() == 1


def test_windowed_counts(spark, tmp_path):
    spark.sql("SELECT timestamp '2024-01-01 00:10:00' AS ts, 'a' AS event_type, 1.0D AS value UNION ALL SELECT timestamp '2024-01-01 00:50:00', 'a', 2.0D").write.parquet(str(tmp_path / "e"))
    q = upserts.windowed_counts(spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "e")))
    run = q.writeStream.outputMode("complete").format("memory").queryName("windowed").trigger(availableNow=True).start()
    run.awaitTermination()
    assert [(r["n"], r["value"]) for r in spark.table("windowed").collect()] == [(2, 3.0)]
