import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphvec.operators import ingest, skew
from graphvec.operators.ordering import earlier
from graphvec.sources.collections import CollectionStore
from graphvec.sources.graph_store import GraphStore


def texts(r, n=40):
    words = ["graph", "store", "vector", "index", "naïve", "of", "the", "spark", "query", "plan"]
    out = [None, "", " \n", "word " * 500, "One. Two! three?\n\nfour", "no end " * 30]
    return out + [" ".join(r.choice(["knowledge graph", *words]) + r.choice(["", "", ".", ".\n", "!"]) for _ in range(r.randint(1, 300))) for _ in range(n)]


def slow_units(text, size):
    out, words, at = [], 0, 0
    for s in re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", text or ""):
        for u in re.findall(ingest.piece(size), s):
            out.append((u, words, at))
            words, at = words + len(u.split()), at + len(u)
    return out


@pytest.mark.parametrize("size, overlap", [(7, 2), (40, 40), (120, 0)])
def test_chunks(spark, size, overlap):
    t = texts(random.Random(1))
    docs = spark.createDataFrame([*enumerate(t), (None, "x"), (4, "A smaller text.")], "doc_id bigint, text string").repartition(3)
    t[4] = "A smaller text."
    cut = ingest.units(docs, size)
    got = {(r["doc_id"], r["c"]): (r["start"], r["text"]) for r in ingest.chunks(cut, size, overlap).collect()}
    want = {}
    for d, text in enumerate(t):
        units = slow_units(text, size)
        assert "".join(u for u, _, _ in units) == (text or "")
        for c in {w // size for _, w, _ in units}:
            own = [x for x in units if x[1] // size == c]
            before = [x for x in units if x[1] // size == c - 1 and x[1] >= c * size - overlap]
            want[d, c] = (own[0][2], "".join(x[0] for x in before + own))
    assert got == want
    assert {c for d, c in want if d == 3} == set(range(math.ceil(500 / size)))


def test_collocations_equal_brute_force(spark):
    t = texts(random.Random(2), 60)
    cut = ingest.units(spark.createDataFrame(list(enumerate(t)), "doc_id bigint, text string"), 40)
    got = {(r["a"], r["b"]): (r["n"], r["llr"]) for r in ingest.collocations(ingest.word_pairs(cut), 3, 5.0).collect()}
    counts = Counter()
    for text in t:
        for u, _, _ in slow_units(text, 40):
            w = re.findall(ingest.TERM, u.lower())
            counts.update(zip(w, w[1:]))
    total, first, second = sum(counts.values()), Counter(), Counter()
    for (a, b), n in counts.items():
        first[a] += n
        second[b] += n
    want = {}
    for (a, b), n in counts.items():
        rows = [(n, first[a] * second[b]), (first[a] - n, first[a] * (total - second[b])), (second[b] - n, (total - first[a]) * second[b]), (total - first[a] - second[b] + n, (total - first[a]) * (total - second[b]))]
        llr = 2 * sum(k * math.log(k * total / e) for k, e in rows if k)
        if n >= 3 and llr >= 5 and n * total > first[a] * second[b]:
            want[a, b] = (n, pytest.approx(llr, abs=1e-5))
    assert got == want and ("knowledge", "graph") in got


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_split_join(spark, most):
    rows = [(1, i) for i in range(60)] + [(2, i) for i in range(20)] + [(k, 0) for k in range(3, 30)] + [(None, 1)]
    left, right = spark.createDataFrame(rows, "k int, x int").repartition(3), spark.createDataFrame([(k, f"v{k}") for k in range(0, 25)], "k int, v string")
    got = Counter(tuple(r) for r in skew.split_join(left, right, ["k"], most=most).select("k", "x", "v").collect())
    assert got == Counter((k, x, f"v{k}") for k, x in rows if k is not None and k < 25)


def test_ingest_into_stores(spark, tmp_path):
    docs = spark.createDataFrame([(d, "The knowledge graph holds facts. A knowledge graph links them.\nEnd of it.") for d in range(4)], "doc_id bigint, text string")
    graph, collections = GraphStore(spark, str(tmp_path / "g")), CollectionStore(spark, str(tmp_path / "c"))
    for _ in range(2):  # a second run changes nothing
        ingest.ingest(docs, graph, collections, size=5, min_count=3, min_llr=1.0)
        nodes, edges = graph.load()
        kinds = {r["type"]: r["n"] for r in nodes.groupBy("type").agg(F.count("*").alias("n")).collect()}
        assert kinds["TextDocument"] == 4 and kinds["TextSummary"] == 4 and nodes.where("name = 'knowledge graph'").count() == 1
        assert edges.where("key = 'contains' and dst = 'ent:knowledge graph'").count() == 8
        assert edges.join(nodes, edges.src == nodes.id, "left_anti").count() == edges.join(nodes, edges.dst == nodes.id, "left_anti").count() == 0
    assert collections.search("Entity_name", text="knowledge graph", limit=1).first()["id"] == "ent:knowledge graph"
    assert collections.read("TextSummary_text").count() == 4
    empty = ingest.ingest_graph(docs.limit(0))
    assert [f.count() for f in empty] == [0, 0, 0]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_earlier_carries_values_and_sums_over_ranges(spark, keys):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]) if keys else "a", i, r.choice([None, None, None, i]), r.randint(0, 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, o int, v int, w int").repartition(5)
    got = {(x["k"], x["o"]): (x["last"], x["total"]) for x in earlier(df, keys, ["o"], "v", "w").collect()}
    want, last, total = {}, {}, Counter()
    for k, o, v, w in rows:
        want[k, o] = (last.get(k), total[k])
        last[k] = v if v is not None else last.get(k)
        total[k] += w
    assert got == want


def test_mentions_by_broadcast_and_by_shuffle(spark):
    """The same mentions, once a unit, whether entities are few or many, with a heavy one among them."""
    rows = [(k, "red apple red apple. " + ("green pear." if k % 3 else "blue plum.")) for k in range(12)]
    cut = ingest.units(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = spark.createDataFrame([("red", "apple", 240_000), ("green", "pear", 5)], "a string, b string, n bigint")
    want = sorted((k, 0, "red", "apple") for k in range(12)) + [(k, 1, "green", "pear") for k in range(12) if k % 3]
    for few in (10, 1):
        made = ingest.mentions(cut, found, few)
        assert sorted((x["doc_id"], x["u"], x["a"], x["b"]) for x in made.collect()) == sorted(want)
    assert "Exchange" not in ingest.distinct_pairs(spark.createDataFrame([(1, 0, 0, "a b")], "doc_id int, c int, u int, unit string"))._jdf.queryExecution().executedPlan().toString()


def test_many_entities_meet_no_shuffle_of_pairs(spark):
    """Of more than `few` entities only a filter and its mistakes meet the pairs; full filters make mistakes, and none stays."""
    from graphvec.operators import bloom

    rows = [(k, f"red apple {'abc'[k % 3] * 4} {'xyz'[k // 3 % 3] * 5}. green pear red apple.") for k in range(40)]
    own = ingest.units(spark.createDataFrame(rows, "doc_id bigint, text string")).groupBy("doc_id", "c").agg(F.collect_list(F.struct("u", "unit")).alias("units"))
    found = spark.createDataFrame([("red", "apple", 80), ("green", "pear", 40), ("apple", "aaaa", 14)], "a string, b string, n bigint")
    pairs = ingest.chunk_pairs(own)
    want = ingest.among(pairs, found).collect()
    assert sum(x["again"] for x in want) == 40 and len(want) == 40 * 3 + 14
    made = ingest.among(pairs, found, 2)
    assert "SortMergeJoin" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(made.collect()) == sorted(want)
    assert sorted(ingest.among(pairs, found, 2, ingest.pair_counts(pairs)).collect()) == sorted(want)
    passes = bloom.member(spark.range(300_000).select(F.xxhash64("id").alias("h")), 300_000, 1024)
    assert spark.range(300_000).where(~passes(F.xxhash64("id"))).count() == 0
    passes = bloom.member(spark.range(300_000).select(F.xxhash64("id").alias("h")), 300_000)
    assert spark.range(300_000).where(~passes(F.xxhash64("id"))).count() == 0 and spark.range(10**6, 2 * 10**6).where(passes(F.xxhash64("id"))).count() < 200
