"""Graphs and corpora derived from the driver's tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.operators import ingest, vector, web_text
from graphvec.operators.ordering import running
from graphvec.storage import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- documents, chunks, entities and types -------------------------------------------------

def document_graph(spark: SparkSession, sf_dir: str, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the texts; `written`: the words are looked for once and kept, for graphs
    that are read several times."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    c = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).select("doc_id", (F.col("i") + 1).alias("i"), "line")
    doc, chunk = F.concat(F.lit("doc:"), "doc_id"), F.concat(F.lit("chunk:"), "doc_id", F.lit(":"), "i")
    words = c.select(chunk.alias("chunk"), F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit("[a-z]{5,}"), F.lit(0)))).alias("word"))
    words = materialize(words, "words") if written else words
    word = words.select("word").distinct()
    word = materialize(word, "word") if written else word
    kind = F.concat(F.lit("type:"), F.substring("word", 1, 4))
    node = lambda df, i, t, n: df.select(i.alias("id"), F.lit(t).alias("type"), n.alias("name"))
    nodes = node(d, doc, "TextDocument", F.concat(F.lit("text_"), "doc_id"))
    for x in (node(c, chunk, "DocumentChunk", chunk), node(d, F.concat(F.lit("sum:"), "doc_id"), "TextSummary", F.concat(F.lit("sum:"), "doc_id")),
              node(word, F.concat(F.lit("ent:"), "word"), "Entity", F.col("word")), node(word.select(F.substring("word", 1, 4).alias("word")).distinct(), kind, "EntityType", F.col("word"))):
        nodes = nodes.unionAll(x)
    edge = lambda df, s, t, r: df.select(s.alias("src"), t.alias("dst"), F.lit(r).alias("key"), F.lit(r).alias("relationship_name"))
    edges = edge(c, chunk, doc, "is_part_of")
    for x in (edge(words, F.col("chunk"), F.concat(F.lit("ent:"), "word"), "contains"), edge(word, F.concat(F.lit("ent:"), "word"), kind, "is_a"),
              edge(d, F.concat(F.lit("sum:"), "doc_id"), F.concat(F.lit("chunk:"), "doc_id", F.lit(":1")), "made_from")):
        edges = edges.unionAll(x)
    return nodes.withColumn("ord", F.lit(0).cast("bigint")), edges.withColumn("relationship_type", F.lit(None).cast("string")).withColumn("ord", F.lit(0).cast("bigint"))


DOCUMENT_GRAPH = """
c AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
w AS (SELECT DISTINCT 'chunk:' || doc_id || ':' || i AS chunk, word FROM (SELECT doc_id, i, unnest(regexp_extract_all(line, '[a-z]{5,}')) AS word FROM c)),
word AS (SELECT DISTINCT word FROM w),
nodes AS (
  SELECT 'doc:' || doc_id AS id, 'TextDocument' AS type, 'text_' || doc_id AS name FROM documents
  UNION ALL SELECT 'chunk:' || doc_id || ':' || i, 'DocumentChunk', 'chunk:' || doc_id || ':' || i FROM c
  UNION ALL SELECT 'sum:' || doc_id, 'TextSummary', 'sum:' || doc_id FROM documents
  UNION ALL SELECT 'ent:' || word, 'Entity', word FROM word
  UNION ALL SELECT DISTINCT 'type:' || substr(word, 1, 4), 'EntityType', substr(word, 1, 4) FROM word),
edges AS (
  SELECT 'chunk:' || doc_id || ':' || i AS src, 'doc:' || doc_id AS dst, 'is_part_of' AS key FROM c
  UNION ALL SELECT chunk, 'ent:' || word, 'contains' FROM w
  UNION ALL SELECT 'ent:' || word, 'type:' || substr(word, 1, 4), 'is_a' FROM word
  UNION ALL SELECT 'sum:' || doc_id, 'chunk:' || doc_id || ':1', 'made_from' FROM documents)"""


# --- similarity graph ----------------------------------------------------------------------

def similarity_graph(spark: SparkSession, sf_dir: str, threshold: float = 0.38) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    e = vector.similarity_edges(p, threshold).select(F.col("u").alias("src"), F.col("v").alias("dst"), F.lit("similar_to").alias("key"), F.lit(0).cast("bigint").alias("ord"))
    return p.select("id", F.col("id").alias("ord")), e


def similarity_sql(threshold: float = 0.38) -> str:
    return f"""
nodes AS (SELECT vec_id AS id FROM embeddings),
edges AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) > {threshold}),
sym AS (SELECT src AS u, dst AS v FROM edges UNION SELECT dst, src FROM edges),
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, s.v FROM reach r JOIN sym s ON r.b = s.u),
labels AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a),
sizes AS (SELECT component, count(*) AS n_nodes FROM labels GROUP BY component)"""


# --- commerce graph ------------------------------------------------------------------------

def commerce_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = lambda n: table(spark, sf_dir, n)
    ident = lambda p, c: F.concat(F.lit(p + ":"), F.col(c).cast("string"))
    nodes = edges = None
    for name, p, k, label in (("customer", "cust", "c_custkey", "c_name"), ("orders", "order", "o_orderkey", "o_orderpriority"), ("part", "part", "p_partkey", "p_name"),
                              ("supplier", "supp", "s_suppkey", "s_name"), ("nation", "nation", "n_nationkey", "n_name"), ("region", "region", "r_regionkey", "r_name")):
        x = t(name).select(ident(p, k).alias("id"), F.lit(p).alias("type"), F.col(label).alias("name"))
        nodes = x if nodes is None else nodes.unionAll(x)
    for name, s, d, key in (("orders", ident("cust", "o_custkey"), ident("order", "o_orderkey"), F.lit("placed")),
                            ("lineitem", ident("order", "l_orderkey"), ident("part", "l_partkey"), F.concat(F.lit("line_"), F.col("l_linenumber").cast("string"))),
                            ("supplier", ident("supp", "s_suppkey"), ident("nation", "s_nationkey"), F.lit("located_in")),
                            ("customer", ident("cust", "c_custkey"), ident("nation", "c_nationkey"), F.lit("located_in")),
                            ("nation", ident("nation", "n_nationkey"), ident("region", "n_regionkey"), F.lit("part_of"))):
        # numbers are told apart before they become texts, which take twice the room
        x = t(name).select("l_orderkey", "l_partkey", "l_linenumber").distinct() if name == "lineitem" else t(name)
        x = x.select(s.alias("src"), d.alias("dst"), key.alias("key"))
        edges = x if edges is None else edges.unionAll(x)
    return nodes.withColumn("ord", F.lit(0).cast("bigint")), edges.withColumns({"ord": F.lit(0).cast("bigint"), "relationship_name": F.col("key")})


COMMERCE = """
nodes AS (
  SELECT 'cust:' || c_custkey AS id, 'cust' AS type, c_name AS name FROM customer UNION ALL SELECT 'order:' || o_orderkey, 'order', o_orderpriority FROM orders
  UNION ALL SELECT 'part:' || p_partkey, 'part', p_name FROM part UNION ALL SELECT 'supp:' || s_suppkey, 'supp', s_name FROM supplier
  UNION ALL SELECT 'nation:' || n_nationkey, 'nation', n_name FROM nation UNION ALL SELECT 'region:' || r_regionkey, 'region', r_name FROM region),
edges AS (
  SELECT 'cust:' || o_custkey AS src, 'order:' || o_orderkey AS dst, 'placed' AS key FROM orders
  UNION ALL SELECT DISTINCT 'order:' || l_orderkey, 'part:' || l_partkey, 'line_' || l_linenumber FROM lineitem
  UNION ALL SELECT 'supp:' || s_suppkey, 'nation:' || s_nationkey, 'located_in' FROM supplier
  UNION ALL SELECT 'cust:' || c_custkey, 'nation:' || c_nationkey, 'located_in' FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, 'part_of' FROM nation)"""


# --- page corpora --------------------------------------------------------------------------

NL = "\n"
_PIECES = (
    (3, "\n## Privacy Preference Center\nChoose what this site may store."), (5, "\n### Cookie List\nname value"), (7, "\n\n\n\n"),
    (4, "\nwww.loom.com/share one\n![](<Base64-Image-Removed>)![](<Base64-Image-Removed>)"), (6, "\nsee [Skip to main content](#main) here"),
    (8, "\nWe use Essential cookies to run.\nPreferencesDeclineAccept"), (9, "\nThis demo works on codespaces now.\ncoding help reimagined with AI prowess."),
)


#: blocks that open on one page of a source and close three pages later: (every, at) of a page's number
_CROSSING = (
    (11, 1, "\nsee www.loom.com/embed now\n\n"), (11, 4, "\n\n\nend ![](<Base64-Image-Removed>)![](<Base64-Image-Removed>)\n\n"), (13, 2, "\nbut WE USE essential cookies here"), (13, 5, "\nPreferencesDeclineAccept\n\n"),
    (17, 3, "\nThis demo works on codespaces"), (17, 6, "\nand coding help reimagined with AI prowess.\n\n\n"),
)


def fragments(spark: SparkSession, sf_dir: str, crossing: bool = False) -> DataFrame:
    """(source, ord, fragment): a page of each document, numbered in doc_id order in its source,
    with text that cleaning removes; with `crossing` also such as goes on over pages."""
    d = running(table(spark, sf_dir, "documents"), ["source"], ["doc_id"]).withColumn("rn", F.col("pos") + 1)
    extra = [F.when(F.col("rn") % n == at, F.lit(s)).otherwise(F.lit("")) for n, at, s in ((*[(n, 0, s) for n, s in _PIECES], *(_CROSSING if crossing else ())))]
    url = F.concat(F.lit("https://docs.example.com/"), "lang", F.lit("/"), F.col("doc_id").cast("string"))
    return d.select("source", F.col("rn").alias("ord"), web_text.fragment(url, F.concat(F.coalesce("text", F.lit("")), *extra)).alias("fragment"))


def _sql_text(s: str) -> str:
    return " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in s.split("\n"))


def _pages_sql(pieces) -> str:
    return """
numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
frag AS (SELECT source, rn AS ord, '----- https://docs.example.com/' || lang || '/' || doc_id || ' -----' || chr(10) || chr(10) || coalesce(text, '')""" + "".join(
        f" || CASE WHEN rn % {n} = {at} THEN {_sql_text(s)} ELSE '' END" for n, at, s in pieces) + """ || chr(10) || chr(10) AS text FROM numbered)"""


CORPORA = _pages_sql([(n, 0, s) for n, s in _PIECES]) + """,
paged AS (SELECT source, ord - 1 AS pos, 'https://docs.example.com/' || regexp_extract(text, '^----- https://docs.example.com/(.*?) -----', 1) AS url, text AS page,
  coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM frag)"""


def cleaned_whole_sql(steps) -> str:
    """Each source cleaned as one text, in which chr(1) opens each page and stays; then cut into
    pages again, as cleaned(source, ord, text)."""
    parts = [_pages_sql([*[(n, 0, s) for n, s in _PIECES], *_CROSSING]), "j0 AS (SELECT source, string_agg(chr(1) || text, '' ORDER BY ord) AS t FROM frag GROUP BY source)"]
    for i, step in enumerate(steps):
        rule = (step.rule if isinstance(step, web_text.Block) else step.replace("(?md)", "(?m)")).replace("'", "''")
        parts.append(f"""
j{i + 1} AS (SELECT source, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(regexp_replace(b[i], '[^\\x01]', '', 'g'), '')), '') AS t
  FROM (SELECT source, string_split_regex(t, '{rule}') AS p, regexp_extract_all(t, '{rule}') AS b FROM j{i}))""")
    run = "\\n[\\n\\x01]*\\n"
    parts.append(f"""
runs AS (SELECT source, string_split_regex(t, '{run}') AS p, list_transform(regexp_extract_all(t, '{run}'), lambda r: string_split(r, '')) AS b FROM j{len(steps)}),
fewer AS (SELECT source, array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || coalesce(array_to_string(list_transform(range(1, len(b[i]) + 1), lambda k:
  CASE WHEN b[i][k] = chr(1) OR len(list_filter(b[i][1:k], lambda c: c = chr(10))) <= 2 THEN b[i][k] ELSE '' END), ''), '')), '') AS t FROM runs),
cleaned AS (SELECT source, generate_subscripts(l, 1) AS ord, unnest(l) AS text FROM (SELECT source, string_split(t, chr(1))[2:] AS l FROM fewer))""")
    return ",\n".join(parts)


# --- graph and points made from the texts --------------------------------------------------

INGEST = rf"""
d AS (SELECT doc_id, min(coalesce(text, '')) AS t FROM documents WHERE doc_id IS NOT NULL GROUP BY 1),
s AS (SELECT doc_id, flatten(list_transform(regexp_extract_all(t, '{ingest.SENTENCE}'), lambda x: regexp_extract_all(x, '{ingest.piece(ingest.SIZE)}'))) AS l FROM d),
u AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS u, unnest(l) AS unit FROM s),
w AS (SELECT *, sum(len(regexp_extract_all(unit, '{ingest.WORD}'))) OVER before AS wb, sum(length(unit)) OVER before AS cb FROM u
  WINDOW before AS (PARTITION BY doc_id ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS MATERIALIZED (SELECT doc_id, u, unit, coalesce(wb, 0)::BIGINT AS wb, coalesce(cb, 0)::BIGINT AS start, coalesce(wb, 0)::BIGINT // {ingest.SIZE} AS c FROM w),
last AS (SELECT doc_id, max(c) AS last FROM cut GROUP BY 1),
placed AS (SELECT doc_id, u, unit, c, start FROM cut UNION ALL
  SELECT doc_id, u, unit, c + 1, NULL FROM cut JOIN last USING (doc_id) WHERE wb >= (c + 1) * {ingest.SIZE} - {ingest.OVERLAP} AND c < last),
chunks AS MATERIALIZED (SELECT doc_id, c, min(start) AS start, string_agg(unit, '' ORDER BY u) AS text, 'chunk:' || doc_id || ':' || c AS chunk FROM placed GROUP BY doc_id, c),
terms AS (SELECT doc_id, c, u, regexp_extract_all(lower(unit), '{ingest.TERM}') AS t FROM cut),
pairs AS MATERIALIZED (SELECT doc_id, c, u, t[i] AS a, t[i + 1] AS b FROM (SELECT *, unnest(range(1, len(t))) AS i FROM terms)),
counts AS (SELECT a, b, count(*)::DOUBLE AS k FROM pairs GROUP BY ALL), total AS (SELECT count(*)::DOUBLE AS t FROM pairs),
margins AS (SELECT a, b, k, sum(k) OVER (PARTITION BY a) AS na, sum(k) OVER (PARTITION BY b) AS nb, t FROM counts, total),
ratios AS (SELECT a, b, k::BIGINT AS n, k * t > na * nb AS more, round(2 * (k * ln(k / (na * nb / t)) + CASE WHEN na > k THEN (na - k) * ln((na - k) / (na * (t - nb) / t)) ELSE 0 END
  + CASE WHEN nb > k THEN (nb - k) * ln((nb - k) / ((t - na) * nb / t)) ELSE 0 END + CASE WHEN t - na - nb + k > 0 THEN (t - na - nb + k) * ln((t - na - nb + k) / ((t - na) * (t - nb) / t)) ELSE 0 END), 6) AS llr FROM margins),
found AS MATERIALIZED (SELECT a, b, n, llr, 'ent:' || a || ' ' || b AS entity FROM ratios WHERE more AND n >= {ingest.MIN_COUNT} AND llr >= {ingest.MIN_LLR}),
named AS MATERIALIZED (SELECT DISTINCT doc_id, c, u, entity FROM pairs JOIN found USING (a, b)),
scores AS (SELECT doc_id, u, count(*) AS score FROM named GROUP BY ALL),
summaries AS MATERIALIZED (SELECT doc_id, c, unit AS text, 'sum:' || doc_id AS summary, 'chunk:' || doc_id || ':' || c AS chunk FROM cut LEFT JOIN scores USING (doc_id, u) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY coalesce(score, 0) DESC, u) = 1),
nodes AS (SELECT DISTINCT 'doc:' || doc_id AS id, 'TextDocument' AS type, 'text_' || doc_id AS name, NULL::BIGINT AS n, NULL::DOUBLE AS llr, NULL::BIGINT AS start FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT chunk, 'DocumentChunk', chunk, NULL, NULL, start FROM chunks UNION ALL SELECT summary, 'TextSummary', summary, NULL, NULL, NULL FROM summaries
  UNION ALL SELECT entity, 'Entity', a || ' ' || b, n, llr, NULL FROM found UNION ALL SELECT DISTINCT 'type:' || b, 'EntityType', b, NULL, NULL::DOUBLE, NULL FROM found),
edges AS (SELECT chunk AS src, 'doc:' || doc_id AS dst, 'is_part_of' AS key FROM chunks UNION ALL SELECT DISTINCT 'chunk:' || doc_id || ':' || c, entity, 'contains' FROM named
  UNION ALL SELECT entity, 'type:' || b, 'is_a' FROM found UNION ALL SELECT summary, chunk, 'made_from' FROM summaries)"""


# --- letters as a vector -------------------------------------------------------------------

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_vector(text):
    """Counts of letters of a column, or of the column of that name."""
    t = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    return F.array(*[(F.octet_length(t) - F.octet_length(F.replace(t, F.lit(c), F.lit("")))).cast("double") for c in LETTERS])  # a letter is one byte


LETTER_SQL = "[" + ", ".join(f"(length(lower(text)) - length(replace(lower(text), '{c}', '')))::DOUBLE" for c in LETTERS) + "]"
