"""The registered queries over the driver's tables, and the SQL that must agree with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.functions import text as text_functions
from graphvec.functions.vectors import PROFILES, cosine
from graphvec.operators import completion, crawl, hybrid, ingest, inverted_file, lineage, metrics, mutate, postings, retrieve, vector, walk, web_text
from graphvec.plans import fixtures
from graphvec.plans.fixtures import table
from graphvec.sources.collections import CollectionStore
from graphvec.storage import materialize, new_path
from graphvec.streaming.components import StreamedComponents

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- vectors -------------------------------------------------------------------------------

def _points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.to_json(F.struct("label")).alias("payload"))


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").where("vec_id % 100 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))


@query("""WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], q.v) AS c FROM embeddings, q)
SELECT id, round(1 - c, 6) AS score FROM s ORDER BY c DESC, id LIMIT 15""")
def vector_search_top15(spark, d):
    p = _points(spark, d)
    q = p.where("id = 0").first()["vector"]
    return vector.search(p, q).withColumn("score", F.round("score", 6))


_BATCH = """WITH s AS (SELECT q.vec_id AS qid, e.vec_id AS id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS c
FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0),
r AS (SELECT qid, id, c, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id) AS rank FROM s)
SELECT qid, id, round(c, 6) AS cosine, rank FROM r WHERE rank <= {k}"""


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("qid", "id", F.round("cosine", 6).alias("cosine"), F.col("rank").cast("bigint").alias("rank"))


@query(_BATCH.format(k=3))
def vector_batch_top3(spark, d):
    return _ranked(vector.batch_search(_points(spark, d), _queries(spark, d), 3))


@query(_BATCH.format(k=15) + " AND c > 0.3")
def vector_batch_threshold(spark, d):
    return _ranked(vector.batch_search(_points(spark, d), _queries(spark, d), None, 0.3))


@query("""WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id AS id, list_cosine_similarity(embedding::DOUBLE[], q.v) AS c FROM embeddings, q)
SELECT id, round(1 - c, 6) AS distance, round((1 + c) / 2, 6) AS redis_norm, round(1 - 1 / (2 - c), 6) AS opensearch, round(1 / (2 - c), 6) AS azure FROM s""")
def vector_score_profiles(spark, d):
    p = _points(spark, d)
    q = F.lit([float(x) for x in p.where("id = 0").first()["vector"]])
    s = p.select("id", cosine(F.col("vector"), q).alias("c"))
    return s.select("id", *[F.round(f(F.col("c")), 6).alias(n) for n, f in PROFILES.items()])


@query("""SELECT o_orderkey AS n, o_custkey AS id, '{"label":"' || c_mktsegment || '"}' AS payload, 0.0::DOUBLE AS score FROM orders JOIN customer ON c_custkey = o_custkey""")
def vector_retrieve(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.to_json(F.struct(F.col("c_mktsegment").alias("label"))).alias("payload"))
    return vector.retrieve(c, table(spark, d, "orders").select(F.col("o_orderkey").alias("n"), F.col("o_custkey").alias("id")))


@query("""WITH n AS (SELECT o_custkey AS id, arg_max(o_orderpriority, o_orderkey) AS payload FROM orders GROUP BY 1)
SELECT coalesce(n.id, c_custkey) AS id, coalesce(n.payload, c_mktsegment) AS payload FROM customer FULL JOIN n ON n.id = c_custkey""")
def vector_upsert_latest(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("payload"))
    return vector.upsert(c, table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("payload"), F.col("o_orderkey").alias("seq")))


@query("SELECT c_custkey AS id, c_mktsegment AS payload FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def vector_delete(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("payload"))
    return vector.delete(c, table(spark, d, "orders").select(F.col("o_custkey").alias("id")))


@query("""SELECT c_custkey AS id, c_mktsegment AS payload FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')""")
def vector_delete_some(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("payload"))
    urgent = table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'")
    return vector.delete(c, urgent.select(F.col("o_custkey").alias("id")))


@query(r"""WITH a AS (SELECT page_id, trim(regexp_replace(regexp_replace(lower(url), '[^a-z0-9-]', '-', 'g'), '-+', '-', 'g'), '-') AS x FROM pages),
b AS (SELECT page_id, CASE WHEN regexp_matches(x, '^[0-9]') THEN 'idx-' || x ELSE x END AS x FROM a),
c AS (SELECT page_id, CASE WHEN length(x) > 128 THEN rtrim(substr(x, 1, 128), '-') ELSE x END AS x FROM b)
SELECT page_id, CASE WHEN x = '' THEN 'default-index' ELSE x END AS name FROM c""")
def collection_name_sanitize(spark, d):
    return table(spark, d, "pages").select("page_id", text_functions.collection_name(F.col("url")).alias("name"))


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def payload_json_get(spark, d):
    return table(spark, d, "events").select("event_id", F.variant_get(text_functions.payload(F.col("props")), "$.k", "bigint").alias("k"))


@query("""SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, event_type AS type, user_id AS third, 'say "(None, True)"' AS note FROM events""")
def payload_literals(spark, d):
    """Payloads that were stored as Python literals, with quotes and brackets within texts."""
    k = F.variant_get(text_functions.payload(F.col("props")), "$.k", "string")
    text = F.concat(F.lit("{'k': "), k, F.lit(", 'type': '"), "event_type", F.lit("', \"it's\": (True, None, "), F.col("user_id").cast("string"), F.lit(",), 'note': 'say \"(None, True)\"',}"))
    rows = table(spark, d, "events").select("event_id", text.alias("text")).select("event_id", text_functions.payload(F.col("text")).alias("p"))
    get = lambda path, kind, name: F.variant_get("p", path, kind).alias(name)
    return rows.select("event_id", get("$.k", "bigint", "k"), get("$.type", "string", "type"), get("$[\"it's\"][2]", "bigint", "third"), get("$.note", "string", "note"))


#: backend -> score, what it keeps, whether a payload gets the id
_STORED = {"redis": ("(1 + c) / 2", "1 - c < 0.1", False), "qdrant": ("1 - c", "c > 0.9", True), "opensearch": ("1 - 1 / (2 - c)", "true", False), "azureaisearch": ("1 / (2 - c)", "true", True)}


@query("""WITH s AS (SELECT q.vec_id AS qid, e.vec_id AS id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS c FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id::VARCHAR) AS rank FROM s QUALIFY rank <= 5)
""" + " UNION ALL ".join(f"SELECT '{a}' AS adapter, qid, id::VARCHAR AS id, round({score}, 6) AS score, rank, json_object('label', label{", 'id', id::VARCHAR" if has_id else ''})::VARCHAR AS payload FROM r WHERE {keep}" for a, (score, keep, has_id) in _STORED.items()))
def store_batch_search(spark, d):
    """A batch of searches in a store of each backend: thresholds, scores and what the payload holds."""
    points = _points(spark, d).select(F.col("id").cast("string").alias("id"), F.lit(None).cast("string").alias("text"), "vector", "payload", F.lit(0).alias("seq"))
    out = None
    for adapter in _STORED:
        store = CollectionStore(spark, new_path(spark, "store"), adapter=adapter)
        store.create_collection("points")
        store.create_data_points("points", points)
        hits = store.batch_search("points", _queries(spark, d), 5).select(F.lit(adapter).alias("adapter"), "qid", "id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"), "payload")
        # members by name, as JSON objects have no order
        hits = hits.withColumn("payload", F.to_json(F.struct(F.get_json_object("payload", "$.label").cast("int").alias("label"), F.get_json_object("payload", "$.id").alias("id"))))
        out = hits if out is None else out.unionAll(hits)
    return out


_HYBRID = ("""WITH d AS (SELECT doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[a-z]{2,}') AS t FROM documents),
n AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM d),
tf AS (SELECT id, len, token, count(*) AS tf FROM (SELECT id, len(t) AS len, unnest(t) AS token FROM d) GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY 1),
q AS (SELECT DISTINCT item_id AS qid, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS token FROM benchmark),
b AS (SELECT qid, id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS s FROM tf JOIN df USING (token) JOIN q USING (token), n GROUP BY 1, 2),
l AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS rank FROM b QUALIFY rank <= 15),
dv AS (SELECT doc_id AS id, """ + fixtures.LETTER_SQL + """ AS v FROM documents), qv AS (SELECT item_id AS qid, """ + fixtures.LETTER_SQL + """ AS v FROM benchmark),
c AS (SELECT qid, id, list_cosine_similarity(dv.v, qv.v) AS c FROM dv, qv WHERE list_sum(dv.v) > 0),
r AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id) AS rank FROM c QUALIFY rank <= 15),
f AS (SELECT qid, id, sum(1.0::DOUBLE / (60 + rank)) AS s FROM (SELECT * FROM l UNION ALL SELECT * FROM r) GROUP BY 1, 2),
g AS (SELECT qid, id, s, row_number() OVER (PARTITION BY qid ORDER BY round(s, 12) DESC, id) AS rank FROM f)
SELECT qid, id, round(s, 9) AS score, rank FROM g WHERE rank <= 15""")


@query(_HYBRID)
def hybrid_rrf(spark, d):
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    left = hybrid.bm25(docs.select(F.col("doc_id").alias("id"), "text"), items.select(F.col("item_id").alias("qid"), "text"), 15)
    right = vector.batch_search(docs.select(F.col("doc_id").alias("id"), fixtures.letter_vector("text").alias("vector")),
                                items.select(F.col("item_id").alias("qid"), fixtures.letter_vector("text").alias("vector")), 15)
    return hybrid.fuse(left, right, 15).select("qid", "id", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query(_HYBRID)
def hybrid_stored(spark, d):
    """hybrid_rrf with its ranking by words from a stored index."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    path = new_path(spark, "postings")
    postings.build(docs.select(F.col("doc_id").alias("id"), "text"), path)
    left = postings.bm25(spark, path, items.select(F.col("item_id").alias("qid"), "text"), 15)
    right = vector.batch_search(docs.select(F.col("doc_id").alias("id"), fixtures.letter_vector("text").alias("vector")),
                                items.select(F.col("item_id").alias("qid"), fixtures.letter_vector("text").alias("vector")), 15)
    return hybrid.fuse(left, right, 15).select("qid", "id", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query("SELECT vec_id AS qid, 5::BIGINT AS n_exact, true AS mean_recall_at_least_0_9 FROM embeddings WHERE vec_id % 100 = 0")
def ann_lsh_recall(spark, d):
    """Exact hits of each query, and whether the approximate search finds nine tenths of all."""
    exact = vector.batch_search(_points(spark, d), _queries(spark, d), 5)
    near = vector.approximate_search(_points(spark, d), _queries(spark, d), 5)
    hit = exact.join(near.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left").groupBy("qid").agg(F.count("hit").alias("found"), F.count("*").alias("n_exact"))
    enough = hit.agg((F.sum("found") >= 0.9 * F.sum("n_exact")).alias("mean_recall_at_least_0_9"))
    return hit.select("qid", "n_exact").join(F.broadcast(enough))  # one row


@query("SELECT vec_id AS qid, 5::BIGINT AS n_exact, true AS mean_recall_at_least_0_9 FROM embeddings WHERE vec_id % 100 = 0")
def vector_index_recall(spark, d):
    """Exact hits of each query, and whether a stored index finds nine tenths of all."""
    path = new_path(spark, "vector-index")
    inverted_file.build(_points(spark, d), path)
    exact = vector.batch_search(_points(spark, d), _queries(spark, d), 5)
    near = inverted_file.search(spark, path, _queries(spark, d), 5)
    hit = exact.join(near.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left").groupBy("qid").agg(F.count("hit").alias("found"), F.count("*").alias("n_exact"))
    enough = hit.agg((F.sum("found") >= 0.9 * F.sum("n_exact")).alias("mean_recall_at_least_0_9"))
    return hit.select("qid", "n_exact").join(F.broadcast(enough))  # one row


# --- graph upserts and deletes -------------------------------------------------------------

@query("""WITH a AS (SELECT user_id, event_id, 'last_type' AS attr, event_type AS value FROM events
UNION ALL SELECT user_id, event_id, 'last_' || event_type, floor(value * 1000)::BIGINT::VARCHAR FROM events
UNION ALL SELECT user_id, event_id, 'k', json_extract_string(props, '$.k') FROM events)
SELECT 'user:' || user_id AS id, attr, arg_max(value, event_id) AS value FROM a GROUP BY user_id, attr""")
def graph_upsert_nodes(spark, d):
    e = table(spark, d, "events")
    k = F.variant_get(text_functions.payload(F.col("props")), "$.k", "string")
    rows = e.select(F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("id"), F.col("event_id").alias("seq"), F.inline(F.array(
        F.struct(F.lit("last_type").alias("attr"), F.col("event_type").alias("value")),
        F.struct(F.concat(F.lit("last_"), "event_type").alias("attr"), F.floor(F.col("value") * 1000).cast("string").alias("value")),
        F.struct(F.lit("k").alias("attr"), k.alias("value")))))
    return mutate.latest_attributes(rows, ["id"])


@query("""SELECT 'order:' || l_orderkey AS src, 'part:' || l_partkey AS dst, 'line_' || l_linenumber AS key,
arg_max(l_quantity, (l_shipdate, l_suppkey, l_quantity, l_extendedprice)) AS quantity FROM lineitem GROUP BY ALL""")
def graph_upsert_edges_multikey(spark, d):
    li = table(spark, d, "lineitem")
    ident = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rows = li.select(ident("order:", "l_orderkey").alias("src"), ident("part:", "l_partkey").alias("dst"), ident("line_", "l_linenumber").alias("key"),
                     F.lit("quantity").alias("attr"), F.col("l_quantity").alias("value"), F.struct("l_shipdate", "l_suppkey", "l_quantity", "l_extendedprice").alias("seq"))
    return mutate.latest_attributes(rows, ["src", "dst", "key"]).select("src", "dst", "key", F.col("value").alias("quantity"))


def _props(*columns: str):
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])


@query("""WITH o AS (SELECT 'cust:' || o_custkey AS id, min(o_orderkey) AS ord, arg_max(o_orderpriority, o_orderkey) AS priority, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1),
c AS (SELECT 'cust:' || c_custkey AS id, c_custkey AS ord, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT coalesce(c.id, o.id) AS id, coalesce(c.ord, o.ord) AS ord, CASE WHEN c.id IS NOT NULL THEN 'Customer' END AS type, c_name AS name, c_mktsegment AS segment, priority, status
FROM c FULL JOIN o ON c.id = o.id""")
def graph_merge_nodes(spark, d):
    """Orders as updates of a graph that holds some of their customers."""
    c, o = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").withColumn("segment", F.col("c_mktsegment")), table(spark, d, "orders")
    o = o.withColumns({"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus")})
    node = lambda key, kind, name, props: [
        F.concat(F.lit("cust:"), F.col(key).cast("string")).alias("id"), F.col(key).cast("bigint").alias("ord"), F.lit(kind).cast("string").alias("type"), name.cast("string").alias("name"),
        F.lit(None).cast("timestamp").alias("updated_at"), props.alias("props")]
    old = c.select(*node("c_custkey", "Customer", F.col("c_name"), _props("segment")))
    rows = o.select(F.col("o_orderkey"), *node("o_custkey", None, F.lit(None), _props("priority", "status"))).withColumn("ord", F.col("o_orderkey").cast("bigint")).drop("o_orderkey")
    return mutate.upsert_nodes(old, rows).select("id", "ord", "type", "name", *[F.try_element_at("props", F.lit(k)).alias(k) for k in ("segment", "priority", "status")])


@query("""WITH l AS (SELECT 'order:' || l_orderkey AS src, 'part:' || l_partkey AS dst, 'holds' AS key, l_orderkey * 1000000 + l_linenumber * 10000 + (ascii(l_returnflag) - 65) * 100 + ascii(l_linestatus) - 65 AS ord, l_returnflag, l_linestatus, l_linenumber FROM lineitem),
o AS (SELECT src, dst, key, min(ord) AS ord, arg_max(l_returnflag, ord) AS flag FROM l WHERE l_linenumber <= 2 GROUP BY ALL),
n AS (SELECT src, dst, key, min(ord) AS ord, arg_max(l_linestatus, ord) AS status FROM l WHERE l_linenumber >= 2 GROUP BY ALL)
SELECT coalesce(o.src, n.src) AS src, coalesce(o.dst, n.dst) AS dst, coalesce(o.key, n.key) AS key, coalesce(o.ord, n.ord) AS ord, flag, status
FROM o FULL JOIN n ON o.src = n.src AND o.dst = n.dst""")
def graph_merge_edges(spark, d):
    """The later lines of orders as updates of a graph that holds the first two of each."""
    li = table(spark, d, "lineitem").withColumns({"flag": F.col("l_returnflag"), "status": F.col("l_linestatus")})
    ident = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edge = lambda props: [
        ident("order:", "l_orderkey").alias("src"), ident("part:", "l_partkey").alias("dst"), F.lit("holds").alias("key"), F.expr("bigint(l_orderkey) * 1000000 + l_linenumber * 10000 + (ascii(l_returnflag) - 65) * 100 + ascii(l_linestatus) - 65").alias("ord"),
        *[F.lit(None).cast("string").alias(c) for c in ("relationship_name", "relationship_type")], F.lit(None).cast("timestamp").alias("updated_at"), props.alias("props")]
    none = F.create_map().cast("map<string,string>")
    old = mutate.upsert_edges(li.limit(0).select(*edge(none)), li.where("l_linenumber <= 2").select(*edge(_props("flag"))))
    new = mutate.upsert_edges(old, li.where("l_linenumber >= 2").select(*edge(_props("status"))))
    return new.select("src", "dst", "key", "ord", *[F.try_element_at("props", F.lit(k)).alias(k) for k in ("flag", "status")])


def _commerce(sql: str) -> str:
    return f"WITH {fixtures.COMMERCE} {sql}"


def _ids(spark, d, name: str, prefix: str, key: str, where: str | None = None) -> DataFrame:
    t = table(spark, d, name)
    return (t.where(where) if where else t).select(F.concat(F.lit(prefix + ":"), F.col(key).cast("string")).alias("id"))


@query(_commerce(""", gone AS (SELECT 'cust:' || c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT src, dst, key FROM edges WHERE NOT EXISTS (SELECT 1 FROM gone WHERE id = src) AND NOT EXISTS (SELECT 1 FROM gone WHERE id = dst)"""))
def graph_delete_nodes(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    return mutate.delete_nodes(n, e, _ids(spark, d, "customer", "cust", "c_custkey", "c_mktsegment = 'BUILDING'"))[1].select("src", "dst", "key")


@query(_commerce(""", gone AS (SELECT 'cust:' || c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM gone)"""))
def graph_delete_nodes_left(spark, d):
    """The node side of graph_delete_nodes."""
    n, e = fixtures.commerce_graph(spark, d)
    return mutate.delete_nodes(n, e, _ids(spark, d, "customer", "cust", "c_custkey", "c_mktsegment = 'BUILDING'"))[0].select("id")


@query(_commerce("SELECT src, dst, key FROM edges WHERE NOT (key = 'located_in' AND dst LIKE 'nation:%')"))
def graph_cut_predecessors(spark, d):
    _, e = fixtures.commerce_graph(spark, d)
    return mutate.cut_from_predecessors(e, _ids(spark, d, "nation", "nation", "n_nationkey"), "located_in").select("src", "dst", "key")


@query(_commerce("""SELECT src, dst, key FROM edges WHERE NOT (key = 'line_1' AND EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND src = 'order:' || o_orderkey))"""))
def graph_cut_successors(spark, d):
    _, e = fixtures.commerce_graph(spark, d)
    return mutate.cut_to_successors(e, _ids(spark, d, "orders", "order", "o_orderkey", "o_orderstatus = 'F'"), "line_1").select("src", "dst", "key")


# --- lookups and traversals ----------------------------------------------------------------

@query(_commerce("""SELECT w.* FROM (SELECT 'cust:' || o_custkey AS src, 'order:' || o_orderkey AS dst, unnest(['placed', 'line_1']) AS key FROM orders) w SEMI JOIN edges USING (src, dst, key)"""))
def graph_has_edges(spark, d):
    _, e = fixtures.commerce_graph(spark, d)
    o = table(spark, d, "orders")
    wanted = o.select(F.concat(F.lit("cust:"), F.col("o_custkey").cast("string")).alias("src"), F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("dst"),
                      F.explode(F.array(F.lit("placed"), F.lit("line_1"))).alias("key"))
    return walk.has_edges(e, wanted)


@query(_commerce("SELECT o_orderkey AS pos, 'cust:' || o_custkey % 2000 AS id FROM orders WHERE 'cust:' || o_custkey % 2000 IN (SELECT id FROM nodes)"))
def graph_has_nodes(spark, d):
    n, _ = fixtures.commerce_graph(spark, d)
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("cust:"), (F.col("o_custkey") % 2000).cast("string")).alias("id"))
    return walk.has_nodes(n, ids).select("pos", "id")


@query(_commerce("SELECT o_orderkey AS pos, id, type, name FROM orders JOIN nodes ON id = 'cust:' || o_custkey"))
def graph_extract_nodes(spark, d):
    n, _ = fixtures.commerce_graph(spark, d)
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("cust:"), F.col("o_custkey").cast("string")).alias("id"))
    return walk.extract_nodes(n, ids).select("pos", "id", "type", "name")


@query(_commerce("""SELECT src, dst, key, dst AS node, 'in' AS side FROM edges WHERE dst LIKE 'nation:%' UNION ALL SELECT src, dst, key, src, 'out' FROM edges WHERE src LIKE 'nation:%'"""))
def graph_get_edges(spark, d):
    _, e = fixtures.commerce_graph(spark, d)
    return walk.incident_edges(e, _ids(spark, d, "nation", "nation", "n_nationkey"))


@query(_commerce("SELECT DISTINCT dst AS node, id, type, name FROM edges JOIN nodes ON src = id WHERE key = 'line_1' AND dst LIKE 'part:%'"))
def graph_predecessors(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    return walk.predecessors(n, e, _ids(spark, d, "part", "part", "p_partkey"), "line_1").select("node", "id", "type", "name")


@query(_commerce("SELECT DISTINCT src AS node, id, type, name FROM edges JOIN nodes ON dst = id WHERE src LIKE 'order:%'"))
def graph_successors(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    return walk.successors(n, e, _ids(spark, d, "orders", "order", "o_orderkey")).select("node", "id", "type", "name")


@query(_commerce("""SELECT node, id, type, name FROM (SELECT DISTINCT dst AS node, src AS o FROM edges WHERE dst LIKE 'nation:%' OR dst LIKE 'region:%'
UNION ALL SELECT DISTINCT src, dst FROM edges WHERE src LIKE 'nation:%' OR src LIKE 'region:%') JOIN nodes ON o = id"""))
def graph_neighbors(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    ids = _ids(spark, d, "nation", "nation", "n_nationkey").unionAll(_ids(spark, d, "region", "region", "r_regionkey"))
    return walk.neighbors(n, e, ids).select("node", "id", "type", "name")


@query(_commerce(""", f AS (SELECT src, a.name AS src_name, key, dst, b.name AS dst_name FROM edges JOIN nodes a ON a.id = src JOIN nodes b ON b.id = dst)
SELECT dst AS node, * FROM f WHERE dst LIKE 'order:%' UNION ALL SELECT src, * FROM f WHERE src LIKE 'order:%'"""))
def graph_connections(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    return walk.connections(n, e, _ids(spark, d, "orders", "order", "o_orderkey")).drop("relationship_name")


# --- subgraphs -----------------------------------------------------------------------------

def _documents(sql: str) -> str:
    return f"WITH {fixtures.DOCUMENT_GRAPH} {sql}"


@query(_commerce(""", seed AS (SELECT id FROM nodes WHERE type = 'region' AND name IN ('ASIA', 'EUROPE')),
near AS (SELECT id FROM seed UNION SELECT src FROM edges WHERE dst IN (FROM seed) UNION SELECT dst FROM edges WHERE src IN (FROM seed))
SELECT src, dst, key FROM edges WHERE src IN (FROM near) AND dst IN (FROM near)"""))
def graph_nodeset_subgraph(spark, d):
    n, e = fixtures.commerce_graph(spark, d)
    return lineage.nodeset_subgraph(n, e, "region", ["ASIA", "EUROPE"], extension=True)[1].select("src", "dst", "key")


@query(_documents("""SELECT src, dst, key, 'UNKNOWN' AS relationship_type FROM edges
WHERE src IN (SELECT id FROM nodes WHERE type IN ('TextDocument', 'DocumentChunk')) AND dst IN (SELECT id FROM nodes WHERE type IN ('TextDocument', 'DocumentChunk'))"""))
def graph_filter_attrs(spark, d):
    n, e = fixtures.document_graph(spark, d)
    return lineage.filter_graph(n, e, [{"type": ["TextDocument", "DocumentChunk"]}])[1].select("src", "dst", "key", "relationship_type")


@query(_documents("""SELECT id, name FROM nodes JOIN (SELECT x FROM (SELECT src AS x FROM edges UNION ALL SELECT dst FROM edges) GROUP BY x HAVING count(*) = 1) ON x = id WHERE type = 'EntityType'"""))
def graph_degree_one(spark, d):
    n, e = fixtures.document_graph(spark, d)
    return metrics.degree_one_nodes(n, e, "EntityType").select("id", "name")


_SUBGRAPH = _documents(""", chunks AS (SELECT dst AS document, src AS chunk FROM edges WHERE key = 'is_part_of'),
ent AS (SELECT document, dst AS entity FROM chunks JOIN edges ON src = chunk AND key = 'contains'),
used AS (SELECT entity, count(DISTINCT document) AS n FROM ent GROUP BY 1),
orphans AS (SELECT document, entity FROM ent JOIN used USING (entity) WHERE n = 1),
kinds AS (SELECT dst AS kind, src AS entity FROM edges WHERE key = 'is_a'),
kind_total AS (SELECT kind, count(*) AS n FROM kinds GROUP BY 1),
own AS (SELECT document, kind, count(*) AS n FROM (SELECT DISTINCT * FROM orphans) JOIN kinds USING (entity) GROUP BY 1, 2)
SELECT document, part, id FROM (
  SELECT id AS document, 'document' AS part, id FROM nodes WHERE type = 'TextDocument'
  UNION ALL SELECT document, 'chunks', chunk FROM chunks
  UNION ALL SELECT document, 'orphan_entities', entity FROM orphans
  UNION ALL SELECT document, 'orphan_types', own.kind FROM own JOIN kind_total USING (kind) WHERE own.n = kind_total.n
  UNION ALL SELECT document, 'made_from_nodes', src FROM chunks JOIN edges ON dst = chunk AND key = 'made_from')""")


@query(_SUBGRAPH + " WHERE document = 'doc:497'")
def document_subgraph(spark, d):
    n, e = fixtures.document_graph(spark, d, written=True)
    return lineage.document_subgraph(e, lineage.find_documents(n, "497"))


@query(_SUBGRAPH)
def document_subgraph_all(spark, d):
    n, e = fixtures.document_graph(spark, d, written=True)
    return lineage.document_subgraph(e, lineage.find_documents(n), nodes=n.select("id", "type")).drop("type")


# --- components and metrics ----------------------------------------------------------------

def _similar(sql: str, threshold: float = 0.38) -> str:
    return f"WITH RECURSIVE {fixtures.similarity_sql(threshold)} {sql}"


def _similarity(spark, d):
    """The similarity graph with its edges found once and written."""
    n, e = fixtures.similarity_graph(spark, d)
    return n, materialize(e, "edges")


@query(_similar("SELECT id, component FROM labels"))
def graph_components(spark, d):
    return metrics.component_labels(*_similarity(spark, d)).select("id", "component")


@query(_similar("SELECT id::VARCHAR AS node, min(b::VARCHAR) AS component FROM (SELECT a AS id, b FROM reach) WHERE id IN (SELECT u FROM sym) GROUP BY id"))
def graph_components_streamed(spark, d):
    """The edges in five batches; the end is what one run over all of them gives."""
    _, e = fixtures.similarity_graph(spark, d)
    e = materialize(e.select(F.col("src").alias("u"), F.col("dst").alias("v")), "edges")
    store = StreamedComponents(spark, new_path(spark, "components"))
    for k in range(5):
        store.add(e.where(F.pmod(F.xxhash64("u", "v"), F.lit(5)) == k))
    return store.current()


@query(_similar("SELECT id FROM labels WHERE component <> (SELECT component FROM sizes ORDER BY n_nodes DESC, component LIMIT 1)"))
def graph_disconnected_nodes(spark, d):
    return metrics.disconnected_nodes(*_similarity(spark, d))


@query(_similar(""", n AS (SELECT count(*) AS num_nodes FROM nodes), m AS (SELECT count(*) AS num_edges FROM edges),
z AS (SELECT count(*) AS num_connected_components, array_to_string(list(n_nodes ORDER BY component), ',') AS sizes FROM sizes)
SELECT num_nodes, num_edges, round(2.0::DOUBLE * num_edges / num_nodes, 9) AS mean_degree, round(num_edges::DOUBLE / (num_nodes * (num_nodes - 1)), 9) AS edge_density,
num_connected_components, sizes, 0::BIGINT AS num_selfloops, -1::BIGINT AS diameter, -1.0::DOUBLE AS avg_shortest_path_length, -1.0::DOUBLE AS avg_clustering FROM n, m, z"""))
def graph_metrics(spark, d):
    return _metrics_row(metrics.graph_metrics(*_similarity(spark, d)))


def _metrics_row(r: DataFrame) -> DataFrame:
    r = r.withColumn("sizes", F.btrim(F.to_json("sizes_of_connected_components"), F.lit("[]"))).drop("sizes_of_connected_components")
    return r.withColumns({c: F.round(c, 9) for c in ("mean_degree", "edge_density", "avg_shortest_path_length", "avg_clustering")})


@query(_similar(""", top AS (SELECT component FROM sizes ORDER BY n_nodes DESC, component LIMIT 1), own AS (SELECT id FROM labels SEMI JOIN top USING (component)),
e AS (SELECT * FROM edges WHERE src IN (FROM own)), s AS (SELECT * FROM sym WHERE u IN (FROM own)),
bfs AS (SELECT id AS a, id AS b, 0 AS d FROM own UNION SELECT bfs.a, s.v, d + 1 FROM bfs JOIN s ON bfs.b = s.u WHERE d < 12),
dist AS (SELECT a, b, min(d) AS d FROM bfs GROUP BY 1, 2), deg AS (SELECT u, count(*) AS n FROM s GROUP BY 1),
tri AS (SELECT x.u AS u, count(*) / 2 AS t FROM s x JOIN s y ON x.v = y.u JOIN s z ON y.v = z.u AND z.v = x.u GROUP BY 1),
clu AS (SELECT own.id, CASE WHEN n > 1 THEN 2.0 * coalesce(t, 0) / (n * (n - 1)) ELSE 0 END AS c FROM own LEFT JOIN deg ON deg.u = id LEFT JOIN tri ON tri.u = id),
n AS (SELECT count(*) AS num_nodes FROM own), m AS (SELECT count(*) AS num_edges FROM e), dd AS (SELECT max(d)::BIGINT AS diameter, sum(d)::DOUBLE AS total FROM dist), cc AS (SELECT avg(c) AS c FROM clu)
SELECT num_nodes, num_edges, round(2.0::DOUBLE * num_edges / num_nodes, 9) AS mean_degree, round(num_edges::DOUBLE / (num_nodes * (num_nodes - 1)), 9) AS edge_density,
1::BIGINT AS num_connected_components, num_nodes::VARCHAR AS sizes, 0::BIGINT AS num_selfloops, diameter, round(total / (num_nodes * (num_nodes - 1)), 9) AS avg_shortest_path_length, round(c, 9) AS avg_clustering FROM n, m, dd, cc"""))
def graph_metrics_optional(spark, d):
    n, e = fixtures.similarity_graph(spark, d)
    e = materialize(e, "edges")
    ids = materialize(metrics.largest_component_ids(materialize(metrics.component_labels(n, e), "labels")), "largest")
    n = n.join(ids, "id", "left_semi")
    return _metrics_row(metrics.graph_metrics(n, e.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").select(*e.columns), True))


@query("""WITH edges AS (SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > 0.3),
s AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges), deg AS (SELECT u, count(*) AS n FROM s GROUP BY 1),
tri AS (SELECT x.u AS u, count(*) / 2 AS t FROM s x JOIN s y ON x.v = y.u JOIN s z ON y.v = z.u AND z.v = x.u GROUP BY 1)
SELECT vec_id AS id, round(CASE WHEN n > 1 THEN 2.0 * coalesce(t, 0) / (n * (n - 1)) ELSE 0 END, 9) AS coefficient FROM embeddings LEFT JOIN deg ON deg.u = vec_id LEFT JOIN tri ON tri.u = vec_id""")
def graph_clustering(spark, d):
    return metrics.clustering(*fixtures.similarity_graph(spark, d, 0.3)).select("id", F.round("coefficient", 9).alias("coefficient"))


# --- web text ------------------------------------------------------------------------------

@query(r"""WITH h AS (SELECT url, regexp_extract_all(coalesce(html, ''), '(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1) AS l FROM pages),
x AS (SELECT url, unnest(range(len(l))) AS ord, replace(trim(regexp_replace(unnest(l), '^["'']|["'']$', '', 'g'), E' \t\n\r'), '&amp;', '&') AS href FROM h)
SELECT url, ord, CASE WHEN starts_with(href, '/') THEN 'https://docs.example.com' || href ELSE href END AS link FROM x WHERE link LIKE 'https://docs.example.com/%'""")
def html_links(spark, d):
    return web_text.links(table(spark, d, "pages"), "https://docs.example.com", "https://docs.example.com/")


@query("""WITH RECURSIVE n AS (SELECT count(*) AS n FROM pages), bfs AS (SELECT 0::BIGINT AS p, 0 AS depth
UNION SELECT unnest([(7 * p + 3) % n, (13 * p + 5) % n]), depth + 1 FROM bfs, n WHERE depth < 5)
SELECT 'page:' || p AS url, min(depth) AS depth FROM bfs GROUP BY p""")
def crawl_bfs(spark, d):
    pages = table(spark, d, "pages")
    n = pages.count()
    p = pages.select("page_id")
    url = lambda c: F.concat(F.lit("page:"), c.cast("string"))
    links = p.select(url(F.col("page_id")).alias("url"), F.posexplode(F.array((7 * F.col("page_id") + 3) % n, (13 * F.col("page_id") + 5) % n)).alias("ord", "to"))
    links = links.select("url", F.col("ord").cast("bigint").alias("ord"), url(F.col("to")).alias("link"))
    return crawl.crawl(spark.createDataFrame([("page:0",)], "url string"), links).select("url", "depth")


def _corpora(sql: str) -> str:
    return f"WITH {fixtures.CORPORA} {sql}"


_COLLAPSE = "regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


@query(_corpora("SELECT source, ord, length(x)::BIGINT AS n_chars, md5(x) AS text_md5 FROM (SELECT source, ord, " + _COLLAPSE.format(
    x=r"regexp_replace(regexp_replace(text, '(?s)## Privacy Preference Center.*?(-----|\z)', '\1', 'g'), '(?s)### Cookie List.*?(-----|\z)', '\1', 'g')") + " AS x FROM frag)"))
def text_clean(spark, d):
    c = fixtures.fragments(spark, d).select("source", "ord", web_text.clean(F.col("fragment"), web_text.QDRANT_RULES).alias("x"))
    return c.select("source", "ord", F.length("x").cast("bigint").alias("n_chars"), F.md5("x").alias("text_md5"))


@query(f"WITH {fixtures.cleaned_whole_sql(web_text.DLT_STEPS)} SELECT source, ord, length(text)::BIGINT AS n_chars, md5(text) AS text_md5 FROM cleaned")
def text_clean_blocks(spark, d):
    """Blocks within pages and over pages; the SQL cleans each source as one text."""
    c = web_text.clean_pages(fixtures.fragments(spark, d, crossing=True), ["source"])
    return c.select("source", "ord", F.length("fragment").cast("bigint").alias("n_chars"), F.md5("fragment").alias("text_md5"))


@query(_corpora("SELECT source, pos, url, start::BIGINT AS start, md5(page) AS page_md5 FROM paged"))
def page_segment(spark, d):
    return _pages(spark, d).select("source", "pos", "url", "start", F.md5("page").alias("page_md5"))


def _pages(spark, d):
    return web_text.segment_fragments(fixtures.fragments(spark, d), ["source"])


@query(_corpora(r"""SELECT source, pos, url, md5(regexp_replace(page, '\s+$', '')) AS page_md5 FROM paged
WHERE url LIKE 'https://docs.example.com/f%' OR url LIKE 'https://docs.example.com/es/1%'"""))
def page_extract_prefix(spark, d):
    prefixes = spark.createDataFrame([("https://docs.example.com/f",), ("https://docs.example.com/es/1",)], "prefix string")
    return web_text.matching_pages(_pages(spark, d), prefixes).select("source", "pos", "url", F.md5("page").alias("page_md5"))


@query(_corpora(r"""SELECT source, pos, url, CASE WHEN start < cut THEN 1 ELSE 2 END AS half FROM paged JOIN (
SELECT source, coalesce(max(start) FILTER (start < total // 2), 0) AS cut FROM (SELECT *, sum(length(page)) OVER (PARTITION BY source) AS total FROM paged) GROUP BY source) USING (source)"""))
def page_split_mid(spark, d):
    return web_text.halves_of_pages(_pages(spark, d), ["source"]).select("source", "pos", "url", "half")


@query("""WITH s AS (SELECT q.vec_id AS qid, e.vec_id AS id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS c FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0),
r AS (SELECT qid, id, c, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id) AS rank FROM s)
SELECT qid, r.id, round(c, 6) AS cosine, rank, '{"label":' || label || '}' AS payload FROM r JOIN embeddings ON vec_id = r.id WHERE rank <= 5""")
def retrieval_chunks(spark, d):
    r = retrieve.chunks(_points(spark, d), _queries(spark, d), 5)
    return r.select("qid", "id", F.round("cosine", 6).alias("cosine"), F.col("rank").cast("bigint").alias("rank"), "payload")


@query("""WITH s AS (SELECT q.vec_id AS qid, e.vec_id AS id, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS c FROM embeddings e, embeddings q WHERE q.vec_id % 100 = 0),
r AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id) AS rank FROM s),
n AS (SELECT count(*) AS n FROM embeddings), e AS (SELECT vec_id AS src, (7 * vec_id + 3) % n AS dst FROM embeddings, n),
x AS (SELECT dst AS node, src, dst FROM e UNION ALL SELECT src, src, dst FROM e)
SELECT qid, node, src, 'v' || src AS src_name, dst, 'v' || dst AS dst_name FROM r JOIN x ON r.id = x.node WHERE rank <= 5 AND dst IN (SELECT vec_id FROM embeddings)""")
def retrieval_insights(spark, d):
    p = table(spark, d, "embeddings").select("vec_id")
    n = p.count()
    nodes = p.select(F.col("vec_id").alias("id"), F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("name"))
    edges = p.select(F.col("vec_id").alias("src"), ((7 * F.col("vec_id") + 3) % n).alias("dst"), F.lit("next").alias("key"), F.lit("next").alias("relationship_name"))
    return retrieve.insights(_points(spark, d), _queries(spark, d), nodes, edges, 5).select("qid", "node", "src", "src_name", "dst", "dst_name")


# --- graph and points made from texts -------------------------------------------------------

def _ingested(sql: str) -> str:
    return f"WITH {fixtures.INGEST} {sql}"


def _ingest(spark, d):
    return ingest.ingest_graph(table(spark, d, "documents"), fixtures.letter_vector)


@query(_ingested("SELECT * FROM nodes"))
def ingest_nodes(spark, d):
    prop = lambda k, t: F.try_element_at("props", F.lit(k)).cast(t).alias(k)
    return _ingest(spark, d)[0].select("id", "type", "name", prop("n", "bigint"), prop("llr", "double"), prop("start", "bigint"))


@query(_ingested("SELECT * FROM edges"))
def ingest_edges(spark, d):
    return _ingest(spark, d)[1].select("src", "dst", "key")


def _asked(points: str) -> str:
    letters = fixtures.LETTER_SQL
    return _ingested(f""", p AS ({points}), pv AS (SELECT id, text, {letters} AS v FROM p), qv AS (SELECT item_id AS qid, {letters} AS v FROM benchmark),
c AS (SELECT qid, id, text, list_cosine_similarity(pv.v, qv.v) AS c FROM pv, qv WHERE list_sum(pv.v) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(c, 12) DESC, id) AS rank FROM c QUALIFY rank <= 5)""")


def _collection(spark, d, name: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    nodes, edges, points = _ingest(spark, d)
    points = materialize(points.where(F.col("collection") == name), "points")
    return nodes, edges, points, table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), fixtures.letter_vector("text").alias("vector"))


@query(_asked("SELECT summary AS id, text FROM summaries") + " SELECT qid, id, rank, round(c, 6) AS cosine, md5(text) AS text_md5 FROM r")
def retrieval_summaries(spark, d):
    _, _, points, asked = _collection(spark, d, "TextSummary_text")
    r = retrieve.chunks(points, asked, 5)
    return r.select("qid", "id", F.col("rank").cast("bigint").alias("rank"), F.round("cosine", 6).alias("cosine"), F.md5(F.get_json_object("payload", "$.text")).alias("text_md5"))


@query(_asked("SELECT entity AS id, a || ' ' || b AS text FROM found") + """, x AS (SELECT dst AS node, * FROM edges UNION ALL SELECT src, * FROM edges)
SELECT qid, node, src, m.name AS src_name, key, dst, o.name AS dst_name FROM r JOIN x ON r.id = x.node JOIN nodes m ON m.id = x.src JOIN nodes o ON o.id = x.dst""")
def retrieval_entity_insights(spark, d):
    nodes, edges, points, asked = _collection(spark, d, "Entity_name")
    return retrieve.insights(points, asked, nodes, edges, 5).select("qid", "node", "src", "src_name", "key", "dst", "dst_name")


def _pushed(stay: float, least: float, rounds: int) -> str:
    steps = ["pairs_ AS MATERIALIZED (SELECT src AS u, dst AS v FROM edges WHERE src <> dst UNION SELECT dst, src FROM edges WHERE src <> dst)", "degree AS MATERIALIZED (SELECT u, count(*) AS degree FROM pairs_ GROUP BY u)",
             "s0 AS MATERIALIZED (SELECT qid, id, 0.0::DOUBLE AS mass, 1.0::DOUBLE / count(*) OVER (PARTITION BY qid) AS rest FROM r WHERE rank <= 3)"]
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED (SELECT qid, id, mass, rest, degree, coalesce(round(rest, 12) >= {least}::DOUBLE * degree, false) AS push FROM s{k} LEFT JOIN degree ON u = id)")
        steps.append(f"s{k + 1} AS MATERIALIZED (SELECT qid, id, sum(mass) AS mass, sum(rest) AS rest FROM (SELECT qid, id, CASE WHEN push THEN mass + {stay}::DOUBLE * rest ELSE mass END AS mass, CASE WHEN push THEN 0.0::DOUBLE ELSE rest END AS rest FROM a{k}"
                     f" UNION ALL SELECT qid, v, 0.0::DOUBLE, rest * (1 - {stay}::DOUBLE) / degree FROM a{k} JOIN pairs_ ON u = id WHERE push) GROUP BY qid, id)")
    return ", ".join(steps)


@query(_asked("SELECT entity AS id, a || ' ' || b AS text FROM found") + ", " + _pushed(completion.STAY, completion.LEAST, completion.ROUNDS) + f""",
met AS (SELECT qid, id, mass + rest AS mass, text, len(regexp_extract_all(text, '{ingest.WORD}')) AS words FROM s{completion.ROUNDS} JOIN chunks ON chunk = id),
ranked AS (SELECT *, row_number() OVER win AS place, sum(words) OVER (win ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM met WINDOW win AS (PARTITION BY qid ORDER BY round(mass, 9) DESC, id))
SELECT qid, id, round(mass, 9) AS mass, place, words, md5(text) AS text_md5 FROM ranked WHERE total <= {completion.BUDGET}""")
def completion_context(spark, d):
    """Chunks near the three entities closest to each question, packed into a budget of words."""
    _, edges, points = _ingest(spark, d)
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), fixtures.letter_vector("text").alias("vector"))
    seeds = vector.batch_search(points.where("collection = 'Entity_name'"), asked, 3).select("qid", "id")
    chunks = points.where("collection = 'DocumentChunk_text'").select("id", "text")
    r = completion.pack(completion.walk_mass(seeds, edges), chunks)
    return r.select("qid", "id", F.round("mass", 9).alias("mass"), F.col("place").cast("bigint").alias("place"), F.col("words").cast("bigint").alias("words"), F.md5("text").alias("text_md5"))
