"""Web documents: links, cleaning, pages, halves and selections of a page corpus."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphvec.functions.text import unescape
from graphvec.operators.ordering import earlier, running
from graphvec.storage import broadcast_if_small, materialize

LINK = r"""(?i)<a\s[^>]*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""



class Block(NamedTuple):
    """What is removed from an opening text up to the first closing text after it."""

    flags: str
    opening: str
    closing: str

    @property
    def rule(self) -> str:
        return f"{self.flags}{self.opening}.*?{self.closing}"


# What the cleaners remove, in this order.
DLT_STEPS: tuple[Block | str, ...] = (
    Block("(?s)", r"www\.loom\.com", r"!\[\]\(<Base64-Image-Removed>\)!\[\]\(<Base64-Image-Removed>\)"),
    r"(?md)^.*\[Skip to main content\].*$",
    Block("(?si)", "we use essential cookies", "PreferencesDeclineAccept"),
    Block("(?si)", "This demo works on codespaces", r"coding help reimagined with AI prowess\."),
)
DLT_RULES = tuple(step.rule if isinstance(step, Block) else step for step in DLT_STEPS)
QDRANT_RULES = (
    r"(?s)## Privacy Preference Center.*?(?=-----|\z)",
    r"(?s)### Cookie List.*?(?=-----|\z)",
)
HEADER = r"(?md)^----- (.*?) -----$"


def links(pages: DataFrame, host: str, domain_prefix: str, html: str = "html") -> DataFrame:
    """(url, ord, link) of each page: hrefs, quoted or not, with white space cut off and character
    references read, a leading slash completed by `host`, and only those that start with `domain_prefix`."""
    found = pages.select("url", F.posexplode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))).alias("ord", "href"))
    href = F.regexp_replace(F.regexp_replace("href", r"""^["']|["']\z""", ""), r"(?U)^\s+|\s+\z", "")
    href = unescape(href)
    full = F.when(href.startswith("/"), F.concat(F.lit(host), href)).otherwise(href)
    return found.select("url", F.col("ord").cast("bigint").alias("ord"), full.alias("link")).where(F.col("link").startswith(domain_prefix))


def clean(text: Column, rules: tuple[str, ...]) -> Column:
    for rule in rules:
        text = F.regexp_replace(text, rule, "")
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def _by_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which nulls are equal; `right` has a row a key at most."""
    if not keys:
        return left.join(F.broadcast(right))  # one row
    met = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.alias("l").join(right.alias("r"), reduce(Column.__and__, met), "left").select("l.*", *[f"r.{c}" for c in right.columns if c not in keys])


def _across(pages: DataFrame, keys: list[str], order: str, text: str, block: Block) -> DataFrame:
    """`pages` without the blocks of one kind, those that cross pages included.

    A page changes the state (inside a block or not) to a constant if it closes or opens one, and keeps it else: after
    its last closing text it is outside, and inside again if one opens behind that.  So the
    state before a page is that of the last page that set it.  A block that nothing closes stays."""
    f, opening, closing = block
    has_close = F.col(text).rlike(f + closing)
    opens = F.regexp_replace(text, rf"{f}\A.*{closing}", "").rlike(f + opening)
    marks = pages.select(*keys, order, has_close.alias("_closes"), F.when(opens, True).when(has_close, False).alias("_mark"))
    state = materialize(earlier(marks, keys, [order], "_mark", name="block-marks"), "block-states")
    final = state.where("_closes").groupBy(*keys).agg(F.max(order).alias("_final"))
    state = _by_keys(state, final, keys)
    at = F.col(order)
    touched = state.select(*keys, order, (F.coalesce("last", F.lit(False)) & (F.col("_final") >= at)).alias("_in"), (F.coalesce("_mark", F.lit(False)) & (F.col("_final") > at)).alias("_out"))
    touched = materialize(touched.where("_in or _out"), "open-blocks")
    within, to_end, from_start = f"{opening}.*?{closing}", f"{opening}(?:.*?{closing}|.*)", rf"\A(?:.*?{closing}|.*)"
    cut = lambda pattern: F.regexp_replace(text, f + pattern, "")
    goes_in, goes_out = F.coalesce("_in", F.lit(False)), F.coalesce("_out", F.lit(False))
    cleaned = F.when(goes_in & goes_out, cut(f"{from_start}|{to_end}")).when(goes_in, cut(f"{from_start}|{within}")).when(goes_out, cut(to_end)).otherwise(cut(within))
    joined = _by_keys(pages, broadcast_if_small(touched, 100_000), [*keys, order])
    return joined.select(*[cleaned.alias(c) if c == text else c for c in pages.columns])
def _newlines_across(pages: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """Runs of three line ends and more become two, also where a run goes on over pages: what a page begins
    with may only add to the line ends before it up to two."""
    x = F.regexp_replace(text, "\n{3,}", "\n\n")
    pages = pages.withColumn(text, x)
    run = lambda pattern: F.length(F.regexp_extract(text, pattern, 0))
    ends = pages.select(*keys, order, run(r"\A\n+").alias("_lead"), run(r"\n+\z").alias("_trail"), F.length(text).alias("_n"))
    ends = ends.withColumns({"_all": F.col("_lead") == F.col("_n"), "_blank": F.when(F.col("_lead") == F.col("_n"), F.col("_n")).otherwise(0)})
    blank = earlier(ends, keys, [order], weight="_blank", name="page-ends").withColumn("_set", F.when(~F.col("_all"), F.struct("_trail", "total"))).withColumnRenamed("total", "_sum").drop("last")
    state = earlier(blank, keys, [order], "_set", name="page-ends")
    held = F.coalesce(F.col("last._trail"), F.lit(0)) + F.col("_sum") - F.coalesce(F.col("last.total"), F.lit(0))
    cut = F.greatest(F.col("_lead") - F.greatest(2 - held, F.lit(0)), F.lit(0))
    cut = materialize(state.select(*keys, order, cut.cast("int").alias("_cut")).where("_cut > 0"), "page-ends")
    joined = _by_keys(pages, broadcast_if_small(cut, 100_000), [*keys, order])
    shorter = F.substring(F.col(text), F.coalesce("_cut", F.lit(0)) + 1, F.length(text))
    return joined.select(*[shorter.alias(c) if c == text else c for c in pages.columns])


def clean_pages(pages: DataFrame, keys: list[str], steps: tuple[Block | str, ...] = DLT_STEPS, order: str = "ord", text: str = "fragment") -> DataFrame:
    """`pages`, each text as it is left when the corpus of its `keys` is cleaned as one text, pages
    put together by `order`, which is unique in a corpus.  No corpus is put together: blocks that
    cross pages are found by a scan over one small row a page.  A page must end with a line end, as
    `fragment` makes it, so that no opening or closing text crosses pages; a null text is empty."""
    pages = pages.withColumn(text, F.coalesce(text, F.lit("")))
    for step in steps:  # each scan reads its pages twice, so they are written: it would repeat all steps before it
        pages = _across(materialize(pages, "pages", "zstd"), keys, order, text, step) if isinstance(step, Block) else pages.withColumn(text, F.regexp_replace(text, step, ""))
    return _newlines_across(materialize(pages, "pages", "zstd"), keys, order, text)


def fragment(url: Column, body: Column) -> Column:
    return F.concat(F.lit("----- "), url, F.lit(" -----\n\n"), body, F.lit("\n\n"))


def combine(fragments: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """One text of the fragments (keys, ord, fragment) of each key, in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "fragment"))), lambda x: x["fragment"]), "")
    return fragments.groupBy(*keys).agg(joined.alias("text"))


def segment(corpora: DataFrame, text: str = "text") -> DataFrame:
    """(all other columns, pos, url, start, page): from each header to the next.  What stands
    before the first header belongs to no page."""
    parts = F.split(F.col(text), r"(?md)(?=^----- .*? -----$)")
    rest = [c for c in corpora.columns if c != text]
    lengths = corpora.select(*rest, parts.alias("parts"))
    starts = F.aggregate("parts", F.array(F.lit(0).cast("bigint")), lambda acc, p: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(p))))
    rows = lengths.withColumn("starts", starts).select(*rest, F.inline(F.arrays_zip("parts", F.slice("starts", 1, F.size("parts")).alias("starts"))))
    pages = rows.select(*rest, F.regexp_extract("parts", HEADER, 1).alias("url"), F.col("starts").alias("start"), F.col("parts").alias("page")).where(F.col("parts").rlike(r"(?d)\A----- .*? -----(\n|\z)"))
    w = Window.partitionBy(*rest).orderBy("start") if rest else Window.orderBy("start")
    return pages.withColumn("pos", F.row_number().over(w).cast("bigint") - 1)


def segment_fragments(fragments: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """(keys, pos, url, start, page) of corpora that stand as rows (keys, order, fragment), each
    from one header up to before another: what `segment` gives for the fragments in one text,
    which is never put together."""
    cut = segment(fragments.select(*keys, F.col(order).alias("_ord"), "fragment"), "fragment")
    cut = cut.select(*keys, "_ord", F.col("start").alias("_at"), "url", "page", F.length("page").alias("_length"))
    return running(cut, keys, ["_ord", "_at"], "_length", "pages").select(*keys, "pos", "url", "start", "page")


def matching_pages(pages: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pages whose url starts with one of `prefixes` (prefix), once each, stripped at the
    right: the parts that `extract_pages` joins, one row each."""
    p = prefixes.where("prefix is not null").agg(F.collect_set("prefix").alias("_listed"))  # the call's own list
    hit = F.exists("_listed", lambda x: F.col("url").startswith(x))
    return pages.join(F.broadcast(p), hit, "left_semi").withColumn("page", rstrip(F.col("page")))  # one row


def halves_of_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """`pages` (keys, pos, url, start, page) with half, 1 or 2: the cut of `split_in_halves`,
    taken from lengths alone, so a corpus stays in rows.  A page is never cut."""
    total = pages.groupBy(*keys).agg(F.floor(F.sum(F.length("page")) / 2).alias("_mid"))
    sized = pages.select(*keys, "start").join(total, keys)
    cut = sized.where("start < _mid").groupBy(*keys).agg(F.max("start").alias("_cut"))
    half = F.when(F.col("start") < F.coalesce("_cut", F.lit(0)), 1).otherwise(2)
    return pages.join(cut, keys, "left").withColumn("half", half).drop("_cut")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+", "")


def extract_pages(pages: DataFrame, prefixes: DataFrame, keys: list[str]) -> DataFrame:
    """One text of the pages whose url starts with one of `prefixes` (prefix), stripped at the
    right and joined by an empty line.  There is no boundary check: /source takes /sources too."""
    listed = [r["prefix"] for r in prefixes.select("prefix").distinct().collect()]  # the call's own list
    hit = F.lit(False)
    for p in listed:
        hit = hit | F.col("url").startswith(p)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", rstrip(F.col("page")).alias("page")))), lambda x: x["page"]), "\n\n")
    return pages.where(hit).groupBy(*keys).agg(F.count("*").alias("n_pages"), joined.alias("text"))


def split_in_halves(corpora: DataFrame, text: str = "text") -> DataFrame:
    """first_half and second_half of each text: cut at the last page header before the middle,
    at the first header if there is none before or it opens the text, and in the middle
    without headers."""
    t = F.col(text)
    pieces = F.split(t, r"(?md)(?=^----- .*? -----$)")
    d = corpora.withColumn("_p", pieces)
    lengths = F.transform("_p", lambda p: F.length(p))
    ends = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    d = d.withColumn("_starts", F.slice(ends, 1, F.size("_p")))
    headed = F.filter(F.arrays_zip(F.col("_p").alias("p"), F.col("_starts").alias("s")), lambda x: x["p"].rlike(r"(?d)\A----- .*? -----(\n|\z)"))
    d = d.withColumn("_h", headed["s"]).withColumn("_mid", F.floor(F.length(t) / 2).cast("int"))
    best = F.coalesce(F.array_max(F.filter("_h", lambda s: s < F.col("_mid"))), F.lit(0))
    cut = F.when(F.size("_h") == 0, F.col("_mid")).when(best == 0, F.get("_h", 0)).otherwise(best)
    d = d.withColumn("_cut", cut)
    first, second = F.substring(t, F.lit(1), F.col("_cut")), F.substring(t, F.col("_cut") + 1, F.length(t))
    d = d.withColumn("first_half", F.when(F.size("_h") > 0, rstrip(first)).otherwise(first)).withColumn("second_half", F.when(F.size("_h") > 0, lstrip(second)).otherwise(second))
    return d.drop("_p", "_starts", "_h", "_mid", "_cut")
