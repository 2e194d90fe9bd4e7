"""From texts to a graph and its collections, without a model.

Chunks.  A text is cut into units: sentences, and pieces of `size` words of longer ones.  A chunk has
the units that begin in one window of `size` words, and before them those that begin in the
last `overlap` words of the window before; so it ends with a sentence, and no state runs from
chunk to chunk.

Entities are collocations: pairs of neighbouring words that stand together more often than
their own counts explain, by Dunning's log-likelihood ratio.  One pass counts pairs, a second
takes the margins from these counts.  Its type is its last word.  A summary is the unit that
names the most entities.

Rows that share a doc_id are one document, with the smallest text; a null doc_id is left out, a null
text is empty, and an empty text gives a document without chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphvec.operators import bloom
from graphvec.operators.skew import MOST, split_join
from graphvec.operators.vector import hash_embedding
from graphvec.schema import EDGES, NODES
from graphvec.storage import materialize

SIZE, OVERLAP = 120, 20
FEW = 500_000  # entities that are broadcast
MIN_COUNT, MIN_LLR = 5, 10.83  # one in a thousand pairs of independent words reaches this ratio
SENTENCE = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
WORD = r"[^\x20\x09-\x0D]+"
TERM = "[a-zà-öø-ÿ]{3,}"


def piece(size: int) -> str:
    """Pattern of at most `size` words with the white space around them."""
    return rf"[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*){{1,{size}}}|[\x20\x09-\x0D]+"


def units(docs: DataFrame, size: int = SIZE, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, u, c, unit, words_before, start): the units of each text in order, the chunk c
    that each opens in, and what stands before it, in words and characters."""
    d = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    all_of = lambda c, pattern: F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    cut = F.flatten(F.transform(all_of(F.col("text"), SENTENCE), lambda s: all_of(s, piece(size))))
    rows = d.select("doc_id", F.posexplode(cut).alias("u", "unit")).withColumn("words", F.size(all_of(F.col("unit"), WORD)))
    before = Window.partitionBy("doc_id").orderBy("u").rowsBetween(Window.unboundedPreceding, -1)  # one document
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("bigint")
    rows = rows.withColumns({"words_before": so_far(F.col("words")), "start": so_far(F.length("unit"))})
    return rows.select("doc_id", "u", F.floor(F.col("words_before") / size).alias("c"), "unit", "words_before", "start")


def chunks(cut: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, c, start, text) of `units`; start is where the chunk's own first unit stands; with a
    column best, the u of a unit, also summary: that unit's text in the chunk that it opens in.  Units that
    are not written and read stay dealt by document, and are not shuffled again."""
    last = F.max("c").over(Window.partitionBy("doc_id"))  # one document
    again = (F.col("words_before") >= (F.col("c") + 1) * size - overlap) & (F.col("c") < F.col("last"))
    with_best = ["best"] if "best" in cut.columns else []
    rows = cut.withColumn("last", last).select("doc_id", "u", "unit", F.col("c").alias("own"), "start", F.explode(F.when(again, F.array("c", F.col("c") + 1)).otherwise(F.array("c"))).alias("c"), *with_best)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("u", "unit"))), lambda x: x["unit"]), "")  # of 2 * size words at most
    summary = [F.max(F.when((F.col("u") == F.col("best")) & (F.col("own") == F.col("c")), F.col("unit"))).alias("summary")] if with_best else []
    return rows.groupBy("doc_id", "c").agg(F.min(F.when(F.col("own") == F.col("c"), F.col("start"))).alias("start"), text.alias("text"), *summary)


def word_pairs(cut: DataFrame) -> DataFrame:
    """(doc_id, c, u, a, b) for every two neighbouring terms of a unit."""
    return _pairs(cut, lambda pairs: pairs)


def distinct_pairs(cut: DataFrame) -> DataFrame:
    """`word_pairs`, each once in a unit, which is one row."""
    return _pairs(cut, F.array_distinct)


def _pairs(cut: DataFrame, of_unit) -> DataFrame:
    t = cut.select("doc_id", "c", "u", F.regexp_extract_all(F.lower("unit"), F.lit(TERM), F.lit(0)).alias("t"))
    n = F.greatest(F.size("t") - 1, F.lit(0))
    return t.select("doc_id", "c", "u", F.inline(of_unit(F.arrays_zip(F.slice("t", F.lit(1), n).alias("a"), F.slice("t", F.lit(2), n).alias("b")))))


def chunk_pairs(own: DataFrame) -> DataFrame:
    """(doc_id, c, u, a, b, again) of (doc_id, c, units), a row for each chunk with its own units (u, unit): `distinct_pairs`,
    and whether an earlier unit of the chunk has the pair too.  Chunks are sorted where they are; nothing is shuffled."""
    t = own.select("doc_id", "c", F.transform("units", lambda x: F.struct(x["u"].alias("u"), F.regexp_extract_all(F.lower(x["unit"]), F.lit(TERM), F.lit(0)).alias("t"))).alias("t"))

    def of_unit(x):
        n = F.greatest(F.size(x["t"]) - 1, F.lit(0))
        return F.transform(F.arrays_zip(F.slice(x["t"], F.lit(1), n).alias("a"), F.slice(x["t"], F.lit(2), n).alias("b")), lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), x["u"].alias("u")))

    def against_last(x, i):
        last = F.get("p", i - 1)
        again = F.coalesce((last["a"] == x["a"]) & (last["b"] == x["b"]), F.lit(False))
        return F.struct(x["u"].alias("u"), x["a"].alias("a"), x["b"].alias("b"), again.alias("again"), (again & (last["u"] == x["u"])).alias("twice"))

    ranked = t.select("doc_id", "c", F.sort_array(F.flatten(F.transform("t", of_unit))).alias("p"))
    return ranked.select("doc_id", "c", F.inline(F.transform("p", against_last))).where("twice is null or not twice").drop("twice")


def mentions(cut: DataFrame, found: DataFrame, few: int = FEW) -> DataFrame:
    """(doc_id, c, u, a, b): the pairs of each unit that are among the entities `found` (a, b, n)."""
    return among(distinct_pairs(cut), found, few)


def among(pairs: DataFrame, found: DataFrame, few: int = FEW, counts: DataFrame | None = None) -> DataFrame:
    """The rows of `pairs` (a, b, ...) that are among `found` (a, b, n); `counts` (a, b) has every pair
    once, where these are known.

    Up to `few` entities meet the pairs where these are.  Of more, their Bloom filter does, and then the pairs that
    pass it by mistake, which `counts` tells: few of them, so no pair travels.  Only if there are over `few` mistakes,
    each row that passes goes to its entity, but for entities with over one in skew.MOST of all mentions, which `n` tells."""
    named = found.select("a", "b")
    if (n := found.count()) <= few:
        return pairs.join(F.broadcast(named), ["a", "b"]).select(*pairs.columns)
    passes = bloom.member(found.select(F.xxhash64("a", "b").alias("h")), n)
    met = pairs.where(passes(F.xxhash64("a", "b")))
    known = pairs.select("a", "b").distinct() if counts is None else counts.select("a", "b")
    wrong = materialize(known.where(passes(F.xxhash64("a", "b"))).join(named.hint("merge"), ["a", "b"], "left_anti"), "passed-by-mistake")
    if wrong.limit(few + 1).count() <= few:
        return met.join(F.broadcast(wrong), ["a", "b"], "left_anti").select(*pairs.columns)
    heavy = found.where(F.col("n") * MOST > F.lit(found.agg(F.sum("n")).first()[0])).select("a", "b")  # fewer than MOST rows
    light = named.join(F.broadcast(heavy), ["a", "b"], "left_anti")
    met = met.join(F.broadcast(heavy), ["a", "b"]).unionByName(met.join(F.broadcast(heavy), ["a", "b"], "left_anti").join(light.hint("merge"), ["a", "b"]))
    return met.select(*pairs.columns)


def log_likelihood(both, a, b, total):
    """Dunning's ratio of a pair's count against its words' counts among all pairs."""
    cell = lambda k, expected: F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    t = total.cast("double")
    return 2 * (cell(both, a * b / t) + cell(a - both, a * (t - b) / t) + cell(b - both, (t - a) * b / t) + cell(t - a - b + both, (t - a) * (t - b) / t))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, n), written: how often each pair stands in `pairs`."""
    return materialize(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), "pair-counts", "zstd")


def collocations(pairs: DataFrame, min_count: int = MIN_COUNT, min_llr: float = MIN_LLR) -> DataFrame:
    """(a, b, n, llr) of the pairs that stand together at least `min_count` times and by more than
    chance."""
    return collocations_of(pair_counts(pairs), min_count, min_llr)


def collocations_of(counts: DataFrame, min_count: int = MIN_COUNT, min_llr: float = MIN_LLR) -> DataFrame:
    """`collocations` of pairs whose `pair_counts` are known."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    first, second = (counts.groupBy(w).agg(F.sum("n").alias(f"n_{w}")) for w in "ab")
    often = materialize(counts.where(F.col("n") >= min_count), "frequent-pairs")
    r = split_join(materialize(split_join(often, first, ["a"]), "pairs-by-first"), second, ["b"])
    llr = F.round(log_likelihood(F.col("n"), F.col("n_a"), F.col("n_b"), F.lit(total)), 6)
    return r.where(F.col("n") * F.lit(float(total)) > F.col("n_a") * F.col("n_b").cast("double")).select("a", "b", "n", llr.alias("llr")).where(F.col("llr") >= min_llr)


def ingest_graph(docs: DataFrame, embed=hash_embedding, size: int = SIZE, overlap: int = OVERLAP, min_count: int = MIN_COUNT, min_llr: float = MIN_LLR,
                 text_col: str = "text", id_col: str = "doc_id", few: int = FEW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, points) of `docs`: documents, chunks, summaries, entities and their types;
    points (collection, id, text, vector, payload) belong to DocumentChunk_text, TextSummary_text
    and Entity_name."""
    own = units(docs, size, text_col, id_col).groupBy("doc_id", "c").agg(F.collect_list(F.struct("u", "unit")).alias("units"))  # dealt by document
    own = materialize(own, "units", "zstd")
    counts = pair_counts(word_pairs(own.select("doc_id", "c", F.inline("units"))))
    found = materialize(collocations_of(counts, min_count, min_llr), "entities")
    named = materialize(among(chunk_pairs(own), found, few, counts), "mentions")
    scores = named.groupBy("doc_id", "u").agg(F.count("*").alias("score"))  # a unit's pairs are distinct
    best = scores.groupBy("doc_id").agg(F.max_by("u", F.struct("score", -F.col("u"))).alias("best"))  # without a mention: the first unit
    straight = units(docs, size, text_col, id_col).join(best.hint("merge"), "doc_id", "left")  # dealt by document
    parts = materialize(chunks(straight.withColumn("best", F.coalesce("best", F.lit(0))), size, overlap), "chunks", "zstd")
    summaries = parts.where("summary is not null").select("doc_id", "c", F.col("summary").alias("text"))

    text = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in p])
    doc_id, c, name = F.col("doc_id"), F.col("c"), F.concat_ws(" ", "a", "b")
    doc, chunk, summary, entity = text("doc:", doc_id), text("chunk:", doc_id, ":", c), text("sum:", doc_id), text("ent:", name)
    no_props, no_time = F.create_map().cast("map<string,string>"), F.lit(None).cast("timestamp")

    def node(rows: DataFrame, node_id, kind: str, label, props=no_props) -> DataFrame:
        return rows.select(node_id.alias("id"), F.lit(0).cast("bigint").alias("ord"), F.lit(kind).alias("type"), label.alias("name"), no_time.alias("updated_at"), props.alias("props"))

    def edge(rows: DataFrame, src, dst, key: str) -> DataFrame:
        return rows.select(src.alias("src"), dst.alias("dst"), F.lit(key).alias("key"), F.lit(0).cast("bigint").alias("ord"), F.lit(key).alias("relationship_name"),
                           F.lit(None).cast("string").alias("relationship_type"), no_time.alias("updated_at"), no_props.alias("props"))

    documents = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id")).distinct()
    props = lambda *names: F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    nodes = [node(documents, doc, "TextDocument", text("text_", doc_id)), node(parts, chunk, "DocumentChunk", chunk, props("start")), node(summaries, summary, "TextSummary", summary),
             node(found, entity, "Entity", name, props("n", "llr")), node(found.select("b").distinct(), text("type:", F.col("b")), "EntityType", F.col("b"))]
    edges = [edge(parts, chunk, doc, "is_part_of"), edge(named.where("not again"), chunk, entity, "contains"),
             edge(found, entity, text("type:", F.col("b")), "is_a"), edge(summaries, summary, chunk, "made_from")]

    def points(rows: DataFrame, collection: str, point_id, label) -> DataFrame:
        return rows.select(F.lit(collection).alias("collection"), point_id.alias("id"), label.alias("text"), embed(label).alias("vector"), F.to_json(F.struct(point_id.alias("id"), label.alias("text"))).alias("payload"))

    kept = [points(parts, "DocumentChunk_text", chunk, F.col("text")), points(summaries, "TextSummary_text", summary, F.col("text")), points(found, "Entity_name", entity, name)]
    out = []
    for frames, columns in ((nodes, NODES.names), (edges, EDGES.names), (kept, kept[0].columns)):
        whole = frames[0]
        for f in frames[1:]:
            whole = whole.unionByName(f)
        out.append(whole.select(*columns))
    return tuple(out)


def ingest(docs: DataFrame, graph, collections, **options) -> None:
    """`ingest_graph` of `docs`, merged into a graph store and a collection store."""
    nodes, edges, points = ingest_graph(docs, collections.embed, **options)
    graph.merge(nodes, edges)
    points = materialize(points, "points")
    for name in ("DocumentChunk_text", "TextSummary_text", "Entity_name"):
        collections.create_collection(name)
        collections.create_data_points(name, points.where(F.col("collection") == name).withColumn("seq", F.lit(0)))
