import pytest

from graphvec.schema import EDGES, NODES
from graphvec.sources.collections import CollectionStore
from graphvec.sources.commits import CommitRefused, Table, VersionedTables
from graphvec.sources.graph_store import NODE_TABLE, GraphStore, graph_store, use_graph_adapter
from graphvec.errors import EngineInitialization
from graphvec.operators.mutate import upsert_nodes


def nodes(spark, *rows):
    return spark.createDataFrame([(i, k, t, None, None, {"p": p}) for k, (i, t, p) in enumerate(rows)], NODES)


def rows(df):
    return {(r["id"], r["type"], tuple(sorted(r["props"].items()))) for r in df.collect()}


def test_two_writers_lose_nothing(spark, tmp_path):
    """The second writer commits while the first one is at work: the first starts again."""
    a, b = (VersionedTables(spark, str(tmp_path / "t"), 4) for _ in "ab")
    a.replace({"nodes": (NODE_TABLE, nodes(spark, ("x", "A", "1"), ("y", "A", "1")))})
    met = []

    def merge(old, new):
        if not met:  # before the first writer can commit
            met.append(1)
            b.apply({"nodes": (NODE_TABLE, nodes(spark, ("x", "B", "2"), ("z", "C", "2")), None)})
        return upsert_nodes(old, new)

    version = a.apply({"nodes": (Table(NODES, ["id"], merge), nodes(spark, ("x", None, "3"), ("w", "D", "3")), None)})
    assert version == 3 and met == [1]
    assert rows(a.read("nodes", NODE_TABLE)) == {("x", "B", (("p", "3"),)), ("y", "A", (("p", "1"),)), ("z", "C", (("p", "2"),)), ("w", "D", (("p", "3"),))}


def test_a_writer_that_is_always_late_is_refused(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))

    def change(tables):
        assert t._commit(t.version() + 1, tables, None)
        return tables, None

    with pytest.raises(CommitRefused):
        t.commit(change)


def test_an_unfinished_commit_counts_for_nothing(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"))
    t.replace({"nodes": (NODE_TABLE, nodes(spark, ("x", "A", "1")))})
    (tmp_path / "t" / "commits" / f"{2:020d}.json").write_text('{"tables"')
    assert rows(t.read("nodes", NODE_TABLE)) == {("x", "A", (("p", "1"),))}
    assert t.apply({"nodes": (NODE_TABLE, nodes(spark, ("y", "B", "1")), None)}) == 3
    assert t.read("nodes", NODE_TABLE).count() == 2


def test_a_change_rewrites_its_buckets_only(spark, tmp_path):
    t = VersionedTables(spark, str(tmp_path / "t"), 8)
    t.replace({"nodes": (NODE_TABLE, nodes(spark, *[(f"n{i}", "A", "1") for i in range(100)]))})
    before = t.entry(1)["tables"]["nodes"]
    t.apply({"nodes": (NODE_TABLE, nodes(spark, ("n5", "B", "2")), None)})
    after = t.entry(2)["tables"]["nodes"]
    assert len(before) == 8 and sum(before[k] != after[k] for k in before) == 1
    assert t.read("nodes", NODE_TABLE).count() == 100 and t.read("nodes", NODE_TABLE).where("type = 'B'").count() == 1


def test_every_version_is_kept_and_can_be_replayed(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), 4)
    edge = lambda *pairs: spark.createDataFrame([(s, d, "r", 0, "r", None, None, {}) for s, d in pairs], EDGES)
    store.save(nodes(spark, ("a", "A", "1"), ("b", "A", "1")), edge(("a", "b")))
    store.merge(nodes(spark, ("c", "C", "1"), ("a", None, "2")), edge(("b", "c"), ("c", "c")))
    store.merge(edges=edge(("c", "a")))
    store.delete_nodes(spark.createDataFrame([("c",), ("nobody",)], "id string"))
    store.merge(nodes(spark, ("c", "again", "9")))
    want = [None, {"a", "b"}, {"a", "b", "c"}, {"a", "b", "c"}, {"a", "b"}, {"a", "b", "c"}]
    ends = [None, {("a", "b")}, {("a", "b"), ("b", "c"), ("c", "c")}, {("a", "b"), ("b", "c"), ("c", "c"), ("c", "a")}, {("a", "b")}, {("a", "b")}]
    for v in range(1, 6):
        n, e = store.load(v)
        assert {r["id"] for r in n.collect()} == want[v] and {(r["src"], r["dst"]) for r in e.collect()} == ends[v]
        for since in range(1, v + 1):
            assert rows(store.log.replay("nodes", NODE_TABLE, since, v)) == rows(n)
    feed = store.log.changes("nodes", NODE_TABLE, 0)
    assert [(v, u is not None, d is not None) for v, u, d in feed] == [(2, True, False), (4, False, True), (5, True, False)]
    assert store.log.vacuum(1) > 0 and {r["id"] for r in store.load()[0].collect()} == want[5]


def test_points_of_two_writers(spark, tmp_path):
    a, b = (CollectionStore(spark, str(tmp_path / "c"), adapter="opensearch", buckets=2) for _ in "ab")
    point = lambda i: spark.createDataFrame([(i, "t", [1.0, 0.0], "{}", 0)], "id string, text string, vector array<float>, payload string, seq int")
    a.create_data_points("x", point("1"))
    b.create_data_points("x", point("2"))
    a.create_data_points("y", point("3"))
    v = a.log.version()
    assert b.delete_data_points("x", point("1")) == 1
    assert {r["id"] for r in a.read("x").collect()} == {"2"} and {r["id"] for r in a.read("x", v).collect()} == {"1", "2"} and a.read("y").count() == 1


def test_graph_adapters(spark, tmp_path):
    use_graph_adapter("own", GraphStore)
    assert graph_store("own", spark, str(tmp_path / "g")).load()[0].count() == 0
    with pytest.raises(EngineInitialization):
        graph_store("none", spark, "x")
