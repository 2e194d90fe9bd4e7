"""Graph operators on hand-made graphs: parallel edges, self-loops, dangling ends, ties."""

import itertools
import random
import uuid
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphvec.errors import NodesetFilterNotSupported
from graphvec.operators import lineage, metrics, mutate, walk
from graphvec.operators.components import components
from graphvec.schema import EDGES, NODES


def nodes(spark, *rows):
    return spark.createDataFrame([(i, n, t, name, None, props) for n, (i, t, name, props) in enumerate(rows)], NODES)


def edges(spark, *rows):
    return spark.createDataFrame([(s, d, k, n, k, None, None, {}) for n, (s, d, k) in enumerate(rows)], EDGES)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "id string")


@pytest.fixture(scope="module")
def graph(spark):
    n = nodes(spark, ("a", "X", "A", {"c": '"1"'}), ("b", "X", "B", {}), ("c", "Y", "C", {"c": "1"}), ("d", "Y", None, None), ("e", "Y", "E", {}))
    e = edges(spark, ("a", "b", "r"), ("a", "b", "s"), ("b", "a", "r"), ("c", "c", "r"), ("a", "ghost", "r"), ("d", "e", "r"))
    return n, e


def test_upsert_merges_attributes_and_a_null_wins(spark):
    old = nodes(spark, ("a", "X", "A", {"p": "1", "q": "2"}))
    new = spark.createDataFrame([("a", 5, None, "A2", None, {"q": None, "r": "3"}), ("z", 6, "T", "Z", None, {}), ("a", 7, None, None, None, {"r": "4"})], NODES)
    got = {r["id"]: r for r in mutate.upsert_nodes(old, new).collect()}
    assert got["a"]["props"] == {"p": "1", "q": None, "r": "4"} and (got["a"]["type"], got["a"]["name"], got["a"]["ord"]) == ("X", "A2", 0)
    assert got["z"]["props"] == {}
    again = mutate.upsert_nodes(mutate.upsert_nodes(old, new), new).collect()
    assert {r["id"]: r["props"] for r in again} == {i: r["props"] for i, r in got.items()}


def test_upsert_edges_is_keyed_by_the_triple(spark, graph):
    _, e = graph
    after = mutate.upsert_edges(e, edges(spark, ("a", "b", "r"), ("a", "b", "t")))
    assert after.count() == e.count() + 1
    assert after.where("src = 'a' AND key = 'r' AND dst = 'b'").first()["updated_at"] is not None
    with pytest.raises(Exception, match="needs source"):
        mutate.upsert_edges(e, edges(spark, ("a", None, "r"))).count()


def test_edges_from_tuples_checks_all_rows_first(spark):
    u = uuid.uuid4()
    rows = mutate.edges_from_tuples(spark, [(u, "b", "r"), ("a", "b", "r", {"w": 1, "relationship_name": "r"})]).collect()
    assert rows[0]["src"] == str(u) and rows[1]["props"]["w"] == "1" and rows[1]["relationship_name"] == "r"
    assert mutate.edges_from_tuples(spark, []).count() == 0
    for bad in ([("a", "b")], [("a", 3, "r")]):
        with pytest.raises(ValueError):
            mutate.edges_from_tuples(spark, bad)


def test_delete_and_cut(spark, graph):
    n, e = graph
    left, rest = mutate.delete_nodes(n, e, ids(spark, "a", "nobody"))
    assert {r["id"] for r in left.collect()} == {"b", "c", "d", "e"}
    assert {(r["src"], r["dst"]) for r in rest.collect()} == {("c", "c"), ("d", "e")}
    assert mutate.cut_from_predecessors(e, ids(spark, "b"), "r").count() == 5
    assert mutate.cut_to_successors(e, ids(spark, "a"), "r").count() == 4


def test_lookups_keep_duplicates(spark, graph):
    n, e = graph
    want = spark.createDataFrame([("a", "b", "r"), ("a", "b", "r"), ("b", "b", "r")], "src string, dst string, key string")
    assert walk.has_edges(e, want).count() == 2
    assert walk.extract_nodes(n, ids(spark, "a", "a", "x")).count() == 2
    assert walk.has_nodes(n, ids(spark, "a", "x")).count() == 1


def test_traversals(spark, graph):
    n, e = graph
    assert Counter(r["side"] for r in walk.incident_edges(e, ids(spark, "c")).collect()) == {"in": 1, "out": 1}
    assert [r["id"] for r in walk.predecessors(n, e, ids(spark, "b")).collect()] == ["a"]
    assert [r["id"] for r in walk.successors(n, e, ids(spark, "a"), "s").collect()] == ["b"]
    assert Counter(r["id"] for r in walk.neighbors(n, e, ids(spark, "a")).collect()) == {"b": 2}
    assert walk.neighbors(n, e, ids(spark, "a"), dedupe=True).count() == 1
    assert walk.neighbors(n, e, ids(spark, "nobody")).count() == 0
    assert walk.connections(n, e, ids(spark, "a")).count() == 3
    assert walk.connections(n, e, ids(spark, "c")).count() == 2


def test_components_and_metrics(spark, graph):
    n, e = graph
    labels = {r["id"]: r["component"] for r in metrics.component_labels(n, e).collect()}
    assert labels == {"a": "a", "b": "a", "ghost": "a", "c": "c", "d": "d", "e": "d"}
    assert {r["id"] for r in metrics.disconnected_nodes(n, e).collect()} == {"c", "d", "e"}
    m = metrics.graph_metrics(n, e).first()
    assert (m["num_nodes"], m["num_edges"], m["num_connected_components"], m["num_selfloops"]) == (6, 6, 3, 1)
    assert m["mean_degree"] == 2.0 and m["diameter"] == -1 and m["sizes_of_connected_components"] == [3, 1, 2]
    o = metrics.graph_metrics(n, e, include_optional=True).first()
    assert o["diameter"] is None and o["avg_shortest_path_length"] is None and o["avg_clustering"] == 0.0


def test_sizes_of_any_number_of_components(spark, monkeypatch):
    """There was a most, a million, over which the list was null."""
    monkeypatch.setattr(metrics, "MAX_LISTED", 10, raising=False)
    n = spark.range(45_000, numPartitions=3).select(F.col("id").cast("string").alias("id"), (F.col("id") * 7919 % 45_001).alias("ord"))
    e = n.where("ord % 5 = 0 AND ord < 40000").select(F.col("id").alias("src"), F.concat(F.lit("+"), "id").alias("dst"), F.lit("r").alias("key"), "ord")
    m = metrics.graph_metrics(n, e).first()
    order = sorted(i * 7919 % 45_001 for i in range(45_000))
    assert m["num_connected_components"] == 45_000
    assert m["sizes_of_connected_components"] == [2 if o % 5 == 0 and o < 40_000 else 1 for o in order]


def test_equal_components_go_by_insertion_order(spark):
    n = nodes(spark, ("z", "X", None, {}), ("y", "X", None, {}), ("a", "X", None, {}), ("b", "X", None, {}))
    e = edges(spark, ("a", "b", "r"), ("z", "y", "r"))
    assert {r["id"] for r in metrics.disconnected_nodes(n, e).collect()} == {"a", "b"}


def test_empty_graph(spark):
    n, e = nodes(spark), edges(spark)
    assert metrics.disconnected_nodes(n, e).count() == 0
    m = metrics.graph_metrics(n, e, include_optional=True).first()
    assert m["num_nodes"] == 0 and m["diameter"] is None and m["avg_clustering"] is None


def test_distances_and_clustering_of_one_component(spark):
    e = edges(spark, ("a", "b", "r"), ("b", "c", "r"), ("c", "a", "r"), ("c", "d", "r"))
    m = metrics.graph_metrics(nodes(spark), e, include_optional=True).first()
    assert m["diameter"] == 2 and m["avg_shortest_path_length"] == pytest.approx(16 / 12)
    assert m["avg_clustering"] == pytest.approx((1 + 1 + 1 / 3 + 0) / 4)


def test_long_chain_components(spark):
    e = spark.range(300).select((F.col("id") * 7919 % 301).alias("u"), ((F.col("id") + 1) * 7919 % 301).alias("v"))
    assert {r["component"] for r in components(e).collect()} == {0}


def test_filters(spark, graph):
    n, e = graph
    kept, between = lineage.filter_graph(n, e, [{"type": ["X"]}, {"type": ["Y"]}])
    assert {r["id"] for r in kept.collect()} == {"a", "b"} and between.count() == 3
    assert between.first()["relationship_type"] == "UNKNOWN"
    assert {r["id"] for r in lineage.filter_graph(n, e, [{"name": [None]}])[0].collect()} == {"d"}
    assert {r["id"] for r in lineage.filter_graph(n, e, [{"c": ["1"]}])[0].collect()} == {"c"}
    assert lineage.filter_graph(n, e, [{}])[0].count() == 5
    with pytest.raises(NodesetFilterNotSupported):
        lineage.nodeset_subgraph(n, e, "X", ["A"])
    assert {r["id"] for r in lineage.nodeset_subgraph(n, e, "X", ["A"], extension=True)[0].collect()} == {"a", "b"}


def test_degree_one(spark):
    n = nodes(spark, ("a", "Entity", "A", {}), ("b", "Entity", "B", {}), ("c", "Entity", "C", {}))
    e = edges(spark, ("a", "b", "r"), ("b", "c", "r"), ("c", "c", "r"))
    assert [r["id"] for r in metrics.degree_one_nodes(n, e, "Entity").collect()] == ["a"]
    with pytest.raises(ValueError):
        metrics.degree_one_nodes(n, e, "Chunk")


def test_document_lineage(spark):
    n = nodes(spark, ("d1", "TextDocument", "text_h", {}), ("d2", "PdfDocument", "text_h", {}))
    e = edges(spark, ("c1", "d1", "is_part_of"), ("c2", "d1", "is_part_of"), ("c3", "d2", "is_part_of"), ("c1", "x", "contains"), ("c2", "x", "contains"),
              ("c1", "y", "contains"), ("c3", "y", "contains"), ("x", "t", "is_a"), ("x", "u", "instance_of"), ("y", "u", "is_a"), ("s", "c1", "made_from"))
    docs = lineage.find_documents(n, "h")
    assert [r["document"] for r in docs.collect()] == ["d1"]
    got = Counter((r["part"], r["id"]) for r in lineage.document_subgraph(e, docs).collect())
    assert got == {("document", "d1"): 1, ("chunks", "c1"): 1, ("chunks", "c2"): 1, ("orphan_entities", "x"): 2, ("orphan_types", "t"): 1, ("made_from_nodes", "s"): 1}
    assert lineage.document_subgraph(e, docs, dedupe=True).where("part = 'orphan_entities'").count() == 1
    named = n.where("id <> 't'").select("id", "type", "name")
    for kind, more in (("EntityType", {("orphan_types", "t"): 1}), ("Entity", {})):
        rows = lineage.document_subgraph(e, docs, nodes=named.unionAll(spark.createDataFrame([("t", kind, "T")], named.schema))).collect()
        assert Counter((r["part"], r["id"]) for r in rows) == Counter({k: v for k, v in got.items() if k[0] != "orphan_types"}) + Counter(more)
        assert {r["name"] for r in rows if r["part"] == "orphan_types"} == ({"T"} if more else set()) and {r["type"] for r in rows if r["part"] == "document"} <= set(lineage.DOCUMENT_TYPES)
    assert lineage.find_documents(n, "none").count() == 0


def test_streamed_components_after_each_batch(spark, tmp_path):
    """Equal to a recomputation after each of five batches, one of which comes twice."""
    import random

    from graphvec.operators.components import components
    from graphvec.streaming.components import StreamedComponents, stream_components

    r = random.Random(3)
    edges = [(str(r.randint(0, 150)), str(r.randint(0, 150))) for _ in range(110)] + [("7", "7"), ("900", "900"), (None, "5"), ("hub", "1")]
    batches = [edges[i::5] for i in range(5)]
    store, seen = StreamedComponents(spark, str(tmp_path / "c"), 4), []
    for k, batch in enumerate([*batches, batches[2]]):
        df = spark.createDataFrame(batch, "u string, v string")
        if k == 3:
            df.write.parquet(str(tmp_path / "in"))
            stream_components(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), store, str(tmp_path / "cp")).awaitTermination()
        else:
            store.add(df)
        seen += batch
        known = {x for e in seen if None not in e for x in e}
        found = {x["node"]: x["component"] for x in components(spark.createDataFrame([e for e in seen if None not in e], "u string, v string")).collect()}
        got = store.current().collect()
        assert {x["node"]: x["component"] for x in got} == {n: found.get(n, n) for n in known} and len(got) == len(known)


def test_walk_mass_and_packing(spark):
    from graphvec.operators import completion

    edges = [("e1", "a"), ("e1", "b"), ("e2", "b"), ("b", "c"), ("c", "c"), ("hub", "a")] + [("hub", f"n{i}") for i in range(50)]
    df = spark.createDataFrame([(u, v, "r") for u, v in edges], "src string, dst string, key string")
    seeds = spark.createDataFrame([(1, "e1"), (1, "e2"), (1, "e2"), (2, "alone")], "qid int, id string")
    got = {(x["qid"], x["id"]): x["mass"] for x in completion.walk_mass(seeds, df, 0.2, 0.01, 4).collect()}
    near = {}
    for u, v in edges:
        if u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    mass, rest = {}, {"e1": 0.5, "e2": 0.5}
    for _ in range(4):
        new = {}
        for n, x in rest.items():
            if x >= 0.01 * len(near[n]):
                mass[n] = mass.get(n, 0) + 0.2 * x
                for m in near[n]:
                    new[m] = new.get(m, 0) + 0.8 * x / len(near[n])
            else:
                new[n] = new.get(n, 0) + x
        rest = new
    want = {(1, n): mass.get(n, 0) + rest.get(n, 0) for n in {*mass, *rest}}
    assert {k: pytest.approx(v) for k, v in want.items()} == {k: v for k, v in got.items() if k[0] == 1} and got[2, "alone"] == 1.0
    assert sum(v for (q, _), v in got.items() if q == 1) == pytest.approx(1)
    texts = spark.createDataFrame([("b", "one two three"), ("a", "four five"), ("e1", ""), ("c", "x " * 99)], "id string, text string")
    m = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.2), (1, "e1", 0.9), (1, "c", 0.1), (1, "zz", 0.8), (2, "c", 1.0)], "qid int, id string, mass double")
    assert [(x["id"], x["place"], x["words"]) for x in completion.pack(m, texts, 6).orderBy("qid", "place").collect()] == [("e1", 1, 0), ("b", 2, 3), ("a", 3, 2)]


def test_nodes_with_and_without_ids(spark):
    from graphvec.operators.walk import get_nodes
    from graphvec.schema import NODES

    n = spark.createDataFrame([("a", 0, "X", "A", None, {"id": "own"}), ("b", 1, "Y", None, None, {})], NODES)
    ids = spark.createDataFrame([("a",), ("a",), ("z",)], "id string")
    assert [x["id"] for x in get_nodes(n, ids).collect()] == ["own", "own"] and {x["id"] for x in get_nodes(n).collect()} == {"own", "b"}


def test_path_totals_equal_distances(spark):
    import random

    r = random.Random(5)
    e = [(f"n{i}", f"n{i + 1}") for i in range(70)] + [(f"n{r.randint(0, 70)}", f"n{r.randint(0, 70)}") for _ in range(12)] + [("far", "away")]
    df = spark.createDataFrame([(u, v, "r") for u, v in e], "src string, dst string, key string")
    pairs = metrics.simple_pairs(df)
    ids = spark.createDataFrame([(x,) for x in {x for p in e for x in p} | {"alone"}], "id string")
    want = metrics.distances(pairs, ids).agg(F.max("d"), F.sum("d")).first()
    assert metrics.path_totals(pairs, ids) == tuple(want)
    assert metrics.path_totals(pairs, ids, 3) == tuple(metrics.distances(pairs, ids, 3).agg(F.max("d"), F.sum("d")).first())
    near = metrics.approximate_paths(ids.withColumn("ord", F.lit(0)), df.withColumn("ord", F.lit(0)), 12).first()
    n = metrics.distances(pairs, ids).where("d > 0").count()
    assert near["avg_shortest_path_length"] == pytest.approx(want[1] / n, rel=0.1) and near["reached_pairs"] == pytest.approx(n, rel=0.1)


@pytest.mark.parametrize("part, block, depth", [(16, 64, None), (40, 128, 2), (65_536, 64, None)])
def test_path_totals_in_parts_and_blocks(spark, part, block, depth):
    """The same distances however nodes and sources are dealt, links one way, and some nodes that are no source."""
    r = random.Random(8)
    links = {(r.randrange(150), r.randrange(150)) for _ in range(500)} | {(i, i + 1) for i in range(150, 154)}
    ahead = {u: {v for x, v in links if x == u} for u in range(156)}
    met = []
    for start in range(0, 156, 2):
        seen = near = {start}
        d = 0
        while near and (depth is None or d < depth):
            d += 1
            near = set().union(*(ahead[u] for u in near)) - seen
            seen = seen | near
            met += [d] * len(near)
    df = spark.createDataFrame([(u, v) for u, v in sorted(links) if u != v], "u bigint, v bigint")
    ids = spark.createDataFrame([(i,) for i in range(0, 156, 2)], "id bigint")
    assert metrics.path_totals(df, ids, depth, part, block) == (max(met), sum(met))
    assert metrics.path_totals(df, ids.where("id < 0")) == (0, 0)


@pytest.mark.parametrize("group_edges", [10, 60, 1_000_000])
def test_triangles_in_groups_of_parts(spark, group_edges):
    """The same triangles for any number of parts, for numbers and texts, with more than 2^26 pairs of nodes as well."""
    r = random.Random(4)
    links = {tuple(sorted(r.sample(range(40), 2))) for _ in range(200)}
    want = {}
    for x, y, z in itertools.combinations(range(40), 3):
        if {(x, y), (x, z), (y, z)} <= links:
            for k in (x, y, z):
                want[k] = want.get(k, 0) + 1
    df = spark.createDataFrame(sorted(links), "u bigint, v bigint")
    assert {x["id"]: x["t"] for x in metrics.triangles(df, group_edges).collect()} == want
    named = df.select(F.format_string("n%02d", "u").alias("u"), F.format_string("n%02d", "v").alias("v"))
    assert {int(x["id"][1:]): x["t"] for x in metrics.triangles(named, group_edges).collect()} == want


def test_triangles_send_no_wedges(spark):
    """A star of 2,000 rays has two million wedges and one triangle; none of them is a row."""
    df = spark.range(1, 2001).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v")).unionAll(spark.range(1).select(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))
    t = metrics.triangles(df)
    assert "SortMergeJoin" not in (plan := t._jdf.queryExecution().executedPlan().toString()) and "BroadcastHashJoin" not in plan
    assert {x["id"]: x["t"] for x in t.collect()} == {0: 1, 1: 1, 2: 1}
    found = metrics._triangles(np.array([0, 0, 1]), np.array([1, 2, 2]), *[np.zeros(3, int)] * 2, 0, 0, 0, 10_000)
    assert found[:4].tolist() == [1, 1, 1, 0]


def test_connections_read_each_edge_once(spark, graph, tmp_path):
    """Few ids and many give the same rows, with repeated nodes, loops and unknown ids; of many, an edge travels once to either end."""
    n, e = graph
    n = n.unionAll(nodes(spark, ("b", "X", "B2", {})))
    asked = ids(spark, "a", "a", "c", "ghost", "nobody", None)
    e.write.parquet(str(tmp_path / "links"))
    stored = spark.read.parquet(str(tmp_path / "links"))
    name = {"a": ["A"], "b": ["B", "B2"], "c": ["C"], "d": [None], "e": ["E"]}
    rows = [(x["src"], x["dst"], x["key"]) for x in e.collect()]
    want = Counter((at, s, sn, k, d, dn) for s, d, k in rows for at in (d, s) if at in ("a", "c", "ghost") for sn in name.get(s, []) for dn in name.get(d, []))
    for few in (walk.FEW, 0):
        got = walk.connections(n, stored, asked, few)
        assert Counter((x["node"], x["src"], x["src_name"], x["key"], x["dst"], x["dst_name"]) for x in got.collect()) == want
    assert want["c", "c", "C", "r", "c", "C"] == 2
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


@pytest.mark.parametrize("sharing", [False, True])
def test_orphans_of_repeated_and_shared_chunks(spark, sharing):
    """As by definition, with repeated edges and documents, chunks without a document, and chunks of two documents."""
    r = random.Random(12)
    belongs = [(f"c{c}", f"d{c % 6}") for c in range(40) for _ in range(1 + c % 2)] + ([(f"c{c}", f"d{c % 5}") for c in range(0, 40, 3)] if sharing else [])
    holds = [(f"c{r.randrange(44)}", f"e{r.randrange(60)}") for _ in range(90)] * 2 + [(f"c{c}", f"own{c}") for c in range(40)] + [(None, "own1"), ("c2", None)]
    kinds = [(f"own{c}", f"t{c % 9}") for c in range(40)] + [(f"e{c}", f"t{c % 4}") for c in range(60)]
    asked = ["d0", "d1", "d2", "d3", "d3", "none"]
    want, types = Counter(), set()
    for d in asked:
        want["document", d, d] += 1
        mine = [c for c, x in belongs if x == d]
        want.update(("chunks", d, c) for c in mine)
        only = {e for _, e in holds if e and all(c in mine for c, x in holds if x == e)}
        want.update(("orphan_entities", d, e) for m in mine for c, e in holds if c == m and e in only)
        types |= {("orphan_types", d, t) for _, t in kinds if all(e in only for e, x in kinds if x == t)}
    e = edges(spark, *[(c, d, "is_part_of") for c, d in belongs], *[(c, x, "contains") for c, x in holds], *[(x, t, "is_a") for x, t in kinds])
    docs = spark.createDataFrame([(d,) for d in asked], "document string")
    got = Counter((x["part"], x["document"], x["id"]) for x in lineage.document_subgraph(e, docs).collect())
    assert got == want + Counter(types) and sum(n for k, n in got.items() if k[0] == "orphan_entities") > 20
    once = Counter((x["part"], x["document"], x["id"]) for x in lineage.document_subgraph(e, docs, dedupe=True).collect())
    assert once == Counter(got.keys())


def test_all_documents_search_their_words_once(spark):
    from graphvec.plans import catalog

    plan = catalog.QUERIES["document_subgraph_all"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "[a-z]{5,}" not in plan
