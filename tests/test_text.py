"""Text operators against expected results."""

import json
import time

import pytest
from pyspark.sql import functions as F

from graphvec.functions.text import canonical_id, collection_name, literal_json, parse_time, payload, payload_with_id, prefixed_name, unescape
from graphvec.operators import crawl, web_text
from graphvec.operators.ordering import running
from graphvec.sources.corpus import fetch_pages, read_corpora, write_corpus

CORPUS = ("before\n----- https://d/a -----\n\nx\n## Privacy Preference Center\nmore\n----- https://d/a/b -----\n\ny\r\n### Cookie List z\n\n\n\n"
          "----- https://e -----\n\nlast  \n## Privacy Preference Center\nend\n")


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


CLEAN = "before\n----- https://d/a -----\n\nx\n----- https://d/a/b -----\n\ny\r\n----- https://e -----\n\nlast  \n"


@pytest.mark.parametrize(("text", "want"), [(CORPUS, CLEAN), ("a\n## Privacy Preference Center\ny\n", "a\n"), ("", ""), ("\n\n\n\n", "\n\n")])
def test_clean_sections(spark, text, want):
    assert one(spark, text, lambda t: web_text.clean(t, web_text.QDRANT_RULES)) == want


def test_clean_blocks(spark):
    text = ("www.loom.com/x\ny![](<Base64-Image-Removed>)![](<Base64-Image-Removed>)z\nsee [Skip to main content](#) here\r\nWE USE essential Cookies\n..PreferencesDeclineAccept"
            "\n\n\nThis demo works on CODESPACES\nq coding help reimagined with AI prowess.end")
    assert one(spark, text, lambda t: web_text.clean(t, web_text.DLT_RULES)) == "z\n\nend"


PAGE_A = "----- https://d/a -----\n\nx\n## Privacy Preference Center\nmore\n"
PAGE_B = "----- https://d/a/b -----\n\ny\r\n### Cookie List z\n\n\n\n"
PAGE_E = "----- https://e -----\n\nlast  \n## Privacy Preference Center\nend\n"


def test_segment_extract_and_split(spark):
    df = spark.createDataFrame([("s", CORPUS), ("n", "no pages here"), ("f", "----- u -----\nabc")], "k string, text string")
    pages = web_text.segment(df)
    got = [(r["url"], r["start"], r["page"]) for r in pages.where("k = 's'").orderBy("pos").collect()]
    assert got == [("https://d/a", 7, PAGE_A), ("https://d/a/b", 68, PAGE_B), ("https://e", 119, PAGE_E)]
    r = web_text.extract_pages(pages, spark.createDataFrame([("https://d/a",)], "prefix string"), ["k"]).first()
    assert (r["n_pages"], r["text"]) == (2, PAGE_A.rstrip() + "\n\n" + PAGE_B.rstrip())
    halves = {r["k"]: (r["first_half"], r["second_half"]) for r in web_text.split_in_halves(df).collect()}
    assert halves == {"s": ("before\n" + PAGE_A.rstrip(), PAGE_B + PAGE_E), "n": ("no pag", "es here"), "f": ("", "----- u -----\nabc")}


def test_links(spark):
    html = '<a class="x" href=" /docs/a ">1</a><A HREF="//h/x">2</A><a name="q">3</a><a href="https://other/">4</a><a href=\'/c?x=1&amp;y=2\'>5</a><a id=1 href=/d>6</a>'
    df = spark.createDataFrame([("u", html), ("v", None)], "url string, html string")
    assert [r["link"] for r in web_text.links(df, "https://h", "https://h/").orderBy("ord").collect()] == ["https://h/docs/a", "https://h//h/x", "https://h/c?x=1&y=2", "https://h/d"]


def test_crawl_is_breadth_first_and_bounded(spark):
    links = spark.createDataFrame([("a", 0, "b"), ("a", 1, "c"), ("b", 0, "d"), ("c", 0, "d"), ("d", 0, "a"), ("d", 1, "e")], "url string, ord bigint, link string")
    start = spark.createDataFrame([("a",)], "url string")
    got = crawl.crawl(start, links, max_depth=2).orderBy("depth", "ord").collect()
    assert [(r["url"], r["depth"]) for r in got] == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    fetched = spark.createDataFrame([("a",), ("c",)], "url string")
    assert {r["url"] for r in crawl.crawl(start, links, fetched).collect()} == {"a", "c"}
    assert [crawl.fetch_action(s, t) for s, t in ((200, 1), (429, 1), (429, 5), (404, 1))] == ["use", "retry", "fail", "fail"]


def test_fetch_retries(spark):
    def fetch(url):
        return (200, "md") if url == "ok" else (502, "") if url == "busy" else (404, "")

    df = spark.createDataFrame([("ok",), ("busy",), ("gone",)], "url string")
    assert [tuple(r) for r in fetch_pages(df, fetch).collect()] == [("ok", "md")]


def test_corpus_files(spark, tmp_path):
    f = spark.createDataFrame([("b", "2", 1), ("a", "1", 0)], "url string, body string, ord int").select("ord", web_text.fragment(F.col("url"), F.col("body")).alias("fragment"))
    write_corpus(f, str(tmp_path / "c"))
    assert read_corpora(spark, [str(tmp_path / "c")]).first()["text"] == "----- a -----\n\n1\n\n----- b -----\n\n2\n\n"
    assert web_text.combine(f.withColumn("k", F.lit(1)), ["k"]).first()["text"].startswith("----- a")


NAMES = [("__A  b", "a-b"), ("9x", "idx-9x"), ("x" * 200, "x" * 128), ("---", "default-index"), ("", "default-index"), ("a" * 127 + "--b", "a" * 127),
         ("Entity_name", "entity-name"), ("9" * 130, "idx-" + "9" * 124)]


@pytest.mark.parametrize(("name", "want"), NAMES)
def test_collection_names(spark, name, want):
    assert one(spark, name, collection_name) == want


def test_small_functions(spark):
    u = "ABCDEF00-1111-2222-3333-444444444444"
    assert one(spark, u, canonical_id) == u.lower() and one(spark, "Not", canonical_id) == "Not"
    assert one(spark, "Ent", lambda c: prefixed_name("P", c)) == "p_ent"
    for text, want in (("1700000000123", True), ("2024-01-02T03:04:05.123456+00:00", True), ("2024-01-02T03:04:05+00:00", True), ("soon", False)):
        assert (one(spark, text, parse_time) is not None) == want
    assert one(spark, "{'a': 1}", lambda c: F.to_json(payload(c))) == '{"a":1}' and one(spark, "{'a': open('x')}", lambda c: F.to_json(payload(c))) == "{}"


def test_rows_of_pages_give_what_whole_texts_give(spark):
    rows = [(k, o, f"----- {u} -----\n\n{b}\n\n") for k, o, u, b in (
        ("a", 1, "/x/1", "one " * 9), ("a", 2, "/y/2", "two\n----- /x/in -----\nmore"), ("a", 5, "/x/3", "three  "), ("b", 1, "/y/1", ""), ("c", 1, "/x/1", "long " * 50), ("c", 2, "/x/2", "s"))]
    f = spark.createDataFrame(rows, "source string, ord bigint, fragment string")
    whole = web_text.combine(f, ["source"])
    pages = web_text.segment_fragments(f, ["source"])
    one = web_text.segment(whole)
    columns = ["source", "pos", "url", "start", "page"]
    assert sorted(pages.select(columns).collect()) == sorted(one.select(columns).collect())
    prefixes = spark.createDataFrame([("/x",), ("/x/1",), (None,)], "prefix string")
    parts = sorted(web_text.matching_pages(pages, prefixes).collect())
    joined = {r["source"]: r["text"] for r in web_text.extract_pages(one, prefixes.where("prefix is not null"), ["source"]).collect()}
    assert {k: "\n\n".join(r["page"] for r in parts if r["source"] == k) for k in joined} == joined and {r["source"] for r in parts} == set(joined)
    halves = web_text.halves_of_pages(pages, ["source"]).orderBy("source", "pos").collect()
    got = {k: tuple("".join(r["page"] for r in halves if r["source"] == k and r["half"] == h).strip() for h in (1, 2)) for k in "abc"}
    assert got == {r["source"]: (r["first_half"].strip(), r["second_half"].strip()) for r in web_text.split_in_halves(whole).collect()}
    none = f.limit(0)
    assert web_text.halves_of_pages(web_text.segment_fragments(none, ["source"]), ["source"]).isEmpty()


def test_running_counts_and_sums(spark):
    rows = [(k, i * 7 % 101, i) for i in range(101) for k in ("hot", None) if k or i < 5]
    df = spark.createDataFrame(rows, "k string, o bigint, w bigint")
    for keys in (["k"], []):
        got = running(df, keys, ["o", "w"] if keys else ["o", "w", "k"], "w").collect()
        for k in {r["k"] for r in got} if keys else [0]:
            own = sorted((r for r in got if not keys or r["k"] == k), key=lambda r: r["pos"])
            assert [r["pos"] for r in own] == list(range(len(own))) and [r["o"] for r in own] == sorted(r["o"] for r in own)
            assert [r["start"] for r in own] == [sum(x["w"] for x in own[:i]) for i in range(len(own))]
    assert running(df.limit(0), [], ["o"]).isEmpty()


LITERALS = [
    "{'a': 1}", r"""{"a": 'it\'s "quoted"', 'b': (1, 2.5, -3,), 'c': [None, True, False, ], 'd': {}}""", """('(None, True)', "it's")""", r"'a\\ \x41 é \n tab\t \q \" \' end'", "[]", "{'k': {'n': {'deep': [()]}},}",
    "None", "'{[,]}'", r'"\\"', r"""'\\"'""", "{'a': 'é中', 'b': 1e5}", "{'a': \"x'y\\\"z\"}",
]


@pytest.mark.parametrize("text", LITERALS)
def test_payloads_written_as_literals(spark, text):
    import ast

    want = json.loads(json.dumps(ast.literal_eval(text)))
    assert json.loads(one(spark, text, lambda c: F.to_json(payload(c)))) == want


@pytest.mark.parametrize("text", ["{'a': }", "{'a'", "f(x)", "", "'open", "{1: 2"])
def test_payloads_that_say_nothing(spark, text):
    assert one(spark, text, lambda c: F.to_json(payload(c))) == "{}"


def test_payload_with_id(spark):
    rows = [('{"id": "old", "n": {"x": [1, null]}}', "new"), ("{'n': 'a'}", 'a"b'), ("nothing", "z"), (None, "y"), ("[1]", "l")]
    df = spark.createDataFrame(rows, "p string, i string").select(payload_with_id(F.col("p"), F.col("i")).alias("p"))
    assert [json.loads(r["p"]) for r in df.collect()] == [{"n": {"x": [1, None]}, "id": "new"}, {"n": "a", "id": 'a"b'}, {"id": "z"}, {"id": "y"}, {"id": "l"}]


@pytest.mark.parametrize("text", ["a&amp;b&lt;c&gt;&quot;&apos;", "&amp;lt;", "&#233;&#x1F44D;&#X41;", "&unknown; & &#; &#xD800;", "", "plain", "?a=1&b=2&amp;c"])
def test_character_references(spark, text):
    import html

    want = html.unescape(text).replace(chr(0xFFFD), "&#xD800;")
    assert one(spark, text, unescape) == want


def test_fetch_rounds(spark):
    """A throwing, a throttling and a dead host, and one that answers."""
    from graphvec.sources.corpus import fetch_rounds

    tries = spark.sparkContext.accumulator(0)
    pauses = []

    def fetch(url):
        tries.add(1)
        if "throws" in url:
            raise OSError("no route")
        return {"ok": (200, "md " + url), "empty": (200, None), "slow": (429, ""), "dead": (404, ""), "bad": (502, "")}[url.split("/")[2]]

    urls = ["http://ok/1", "http://ok/2", "http://ok/1", "http://empty/", "http://slow/1", "http://slow/2", "http://slow/3", "http://dead/", "http://bad/", "http://throws/", "not a url", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: (r["action"], r["tries"], r["status"], r["markdown"]) for r in fetch_rounds(df.where("url <> 'not a url' or url is null"), fetch, 3, 35.0, 0.01, pauses.append).collect()}
    assert got["http://ok/1"] == ("use", 1, 200, "md http://ok/1") and got["http://empty/"] == ("use", 1, 200, "") and got["http://dead/"] == ("fail", 1, 404, None)
    assert got["http://bad/"] == ("fail", 3, 502, None) and got["http://throws/"] == ("fail", 3, 502, None) and len(got) == 9
    assert {got[f"http://slow/{i}"][:3] for i in (1, 2, 3)} == {("fail", 3, 429)} and len(pauses) == 8 and set(pauses) == {35.0}
    assert tries.value == 2 + 1 + 9 + 1 + 3 + 3
    thrown = fetch_rounds(df.where("url = 'not a url'"), fetch, 1).first()
    assert thrown["action"] == "fail" and thrown["error"].startswith("IndexError")


def test_literals_are_read_in_one_pass(spark):
    """Commas before a closing bracket go with it, whatever stands between, and the time grows with the text."""
    cases = {"{'a': (1, 2,), 'b': [3, \n], }": {"a": [1, 2], "b": [3]}, "((1,),\n)": [[1]], "{'c': ',]', 'd': 'x, }',}": {"c": ",]", "d": "x, }"}, "[',', (),]": [",", []]}
    many = "[" + "'it', " * 20_000 + "]"
    rows = spark.createDataFrame([(x,) for x in [*cases, many]], "x string").select("x", literal_json(F.col("x")).alias("j"))
    t = time.time()
    got = {r["x"]: json.loads(r["j"]) for r in rows.collect()}
    assert got == cases | {many: ["it"] * 20_000} and time.time() - t < 30
