"""Subgraphs: attribute filters, node sets, and what belongs to one document only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphvec.errors import NodesetFilterNotSupported
from graphvec.storage import materialize

DOCUMENT_TYPES = ("TextDocument", "PdfDocument")


def _attribute(nodes: DataFrame, name: str) -> Column:
    return F.col(name) if name in nodes.columns else F.try_element_at("props", F.lit(name))


def filter_graph(nodes: DataFrame, edges: DataFrame, filters: Sequence[Mapping[str, Sequence]]) -> tuple[DataFrame, DataFrame]:
    """Nodes whose attributes are all among the listed values, and the edges between them.
    Only the first mapping counts; a missing attribute is null and matches a listed None.
    An edge without relationship_type gets "UNKNOWN"."""
    keep = F.lit(True)
    for name, values in (filters[0] if filters else {}).items():
        value, one = _attribute(nodes, name), F.lit(False)
        for v in values:
            one = one | value.eqNullSafe(F.lit(v))
        keep = keep & one
    n = nodes.where(keep)
    ids = n.select("id")
    e = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return n, e.select(*edges.columns).withColumn("relationship_type", F.coalesce("relationship_type", F.lit("UNKNOWN")))


def nodeset_subgraph(nodes: DataFrame, edges: DataFrame, kind: str, names: Sequence[str], extension: bool = False) -> tuple[DataFrame, DataFrame]:
    """Not supported, as a rule.  With `extension`: the named nodes of that type, their direct
    neighbours, and the edges between all of these."""
    if not extension:
        raise NodesetFilterNotSupported("pass extension=True for named nodes and their neighbours")
    seeds = nodes.where((F.col("type") == kind) & F.col("name").isin(list(names))).select("id")
    near = edges.join(seeds.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
    near = near.unionAll(edges.join(seeds.withColumnRenamed("id", "dst"), "dst", "left_semi").select(F.col("src").alias("id")))
    ids = seeds.unionAll(near).distinct()
    e = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return nodes.join(ids, "id", "left_semi"), e.select(*edges.columns)


def find_documents(nodes: DataFrame, content_hash: str | None = None) -> DataFrame:
    """(document): text and PDF documents, or the first one named after that hash."""
    d = nodes.where(F.col("type").isin(*DOCUMENT_TYPES))
    if content_hash is not None:
        d = d.where(F.col("name") == "text_" + content_hash).orderBy("ord").limit(1)
    return d.select(F.col("id").alias("document"))


def _as_often(rows: DataFrame, column: str) -> DataFrame:
    """(document, that column), each row of `rows` as often as its `times` say."""
    return rows.select("document", column, F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).select("document", column)


def _orphan_entities(own: DataFrame, numbered: DataFrame, contains: DataFrame) -> DataFrame:
    """(document, entity, times): entities all of whose edges come from chunks of the document, and
    how many edges lead to them, by `own` (document, no, chunk, times), one row for each pair.

    Where no chunk belongs to two documents, an entity is an orphan if its edges meet one number
    only: that is one pass over the edges, which are summed up before they travel to the entity.
    The entities of other chunks are counted by document."""
    known = contains.where("entity IS NOT NULL")
    met = known.join(own.select("chunk", "no", "times"), "chunk", "left")
    sums = [F.count("no").alias("own"), F.sum("times").alias("times")]
    alone = met.groupBy("entity").agg(F.min("no").alias("no"), F.max("no").alias("last"), F.count("*").alias("all"), *sums).where("no = last AND own = all")
    shared = own.groupBy("chunk").count().where("count > 1").select("chunk")
    if not shared.isEmpty():
        apart = materialize(known.join(shared, "chunk", "left_semi").select("entity").distinct(), "shared")
        total = known.join(apart, "entity", "left_semi").groupBy("entity").agg(F.count("*").alias("all"))
        some = met.join(apart, "entity", "left_semi").groupBy("no", "entity").agg(*sums).join(total, "entity").where(F.col("own") == F.col("all"))
        alone = alone.join(apart, "entity", "left_anti").select("no", "entity", "times").unionByName(some.select("no", "entity", "times"))
    return alone.join(numbered, "no").select("document", "entity", "times")


def document_subgraph(edges: DataFrame, documents: DataFrame, dedupe: bool = False, nodes: DataFrame | None = None) -> DataFrame:
    """(document, part, id): for each document of `documents` its chunks, the entities and
    entity types that nothing else uses, and what was made from its chunks.

    A chunk, orphan entity or made-from node comes once for each edge that leads to it, unless
    `dedupe`; orphan types come once.  An entity is an orphan if all its `contains` edges come
    from the document's chunks, a type if all its `is_a` and `instance_of` edges come from
    orphan entities.  With `nodes` only nodes of type EntityType are types, and each row has
    its node's other columns, null where there is no such node."""
    rel = lambda *names: edges.where(F.col("relationship_name").isin(*names))
    contains = rel("contains").select(F.col("src").alias("chunk"), F.col("dst").alias("entity"))
    # numbers for the documents, which fit an aggregate's buffer where texts would be sorted
    numbered = materialize(documents.where("document IS NOT NULL").groupBy("document").agg(F.count("*").alias("copies")).withColumn("no", F.monotonically_increasing_id()), "documents")
    parts = rel("is_part_of").join(numbered.withColumnRenamed("document", "dst"), "dst").groupBy(F.col("dst").alias("document"), "no", F.col("src").alias("chunk"))
    own = materialize(parts.agg((F.count("*") * F.max("copies")).alias("times")), "chunks")
    chunks = _as_often(own, "chunk")
    found = materialize(_orphan_entities(own, numbered, contains), "orphans")
    orphan_ids, orphans = found.select("document", "entity"), _as_often(found, "entity")
    typed = rel("is_a", "instance_of").select(F.col("src").alias("entity"), F.col("dst").alias("kind"))
    kind_total = typed.groupBy("kind").agg(F.count("*").alias("all"))
    kind_inside = orphan_ids.join(typed, "entity").groupBy("document", "kind").agg(F.count("*").alias("own"))
    kinds = kind_inside.join(kind_total, "kind").where(F.col("own") == F.col("all")).select("document", "kind")
    if nodes is not None:
        kinds = kinds.join(nodes.where("type = 'EntityType'").select(F.col("id").alias("kind")), "kind", "left_semi").select("document", "kind")
    made = rel("made_from").select(F.col("src").alias("made"), F.col("dst").alias("chunk"))
    parts = {"document": documents.select("document", F.col("document").alias("id")), "chunks": chunks.select("document", F.col("chunk").alias("id")),
             "orphan_entities": orphans.select("document", F.col("entity").alias("id")), "orphan_types": kinds.select("document", F.col("kind").alias("id")),
             "made_from_nodes": chunks.join(made, "chunk").select("document", F.col("made").alias("id"))}
    out = None
    for name, df in parts.items():
        df = (df.distinct() if dedupe else df).select("document", F.lit(name).alias("part"), "id")
        out = df if out is None else out.unionAll(df)
    if nodes is None:
        return out
    clash = {c: f"node_{c}" for c in nodes.columns if c in ("document", "part")}
    return out.join(nodes.withColumnsRenamed(clash), "id", "left").select("document", "part", "id", *[clash.get(c, c) for c in nodes.columns if c != "id"])
