"""Cleaning over pages against cleaning the joined text."""

import random
import re

import pytest

from graphvec.operators import web_text

MARKER = "![](<Base64-Image-Removed>)"
PIECES = [
    "www.loom.com/share", MARKER + MARKER, MARKER, "see [Skip to main content](#x)\n", "We use Essential cookies", "PreferencesDeclineAccept", "THIS demo works on codespaces",
    "coding help reimagined with AI prowess.", "plain words", "\n", "\n\n\n", " ", "-----", "more text\n",
]


def joined(pages):
    """Each page as it is left in the joined text; chr(1) marks where pages begin."""
    t = "".join("\x01" + p for p in pages)
    marks = lambda m: "".join(c for c in m.group() if c == "\x01")
    for rule, flags in ((r"www\.loom\.com.*?!\[\]\(<Base64-Image-Removed>\)!\[\]\(<Base64-Image-Removed>\)", re.S), (r"^[\x01]?.*\[Skip to main content\].*$", re.M),
                        (r"we use essential cookies.*?PreferencesDeclineAccept", re.S | re.I), (r"This demo works on codespaces.*?coding help reimagined with AI prowess\.", re.S | re.I)):
        t = re.sub(rule, marks, t, flags=flags)

    def two(m):
        out, n = "", 0
        for c in m.group():
            n += c == "\n"
            out += c if c == "\x01" or n <= 2 else ""
        return out

    return re.sub(r"\n[\n\x01]*\n", two, t).split("\x01")[1:]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pages_equal_the_joined_text(spark, seed):
    r = random.Random(seed)
    corpora = {k: ["".join(r.choice(PIECES) for _ in range(r.choice([0, 1, 2, 5]))) + r.choice(["\n", "\n\n"]) for _ in range(r.choice([1, 7, 60]))] for k in ["a", "b", None, *range(12)]}
    corpora["blank"] = ["\n"] * 9 + ["x\n"] + ["\n"] * 3
    corpora["long"] = ["a www.loom.com b\n", *["gone\n\n"] * 30, f"c{MARKER}{MARKER}d\n", "This demo works on codespaces, never closed\n", "left\n"]
    rows = [(None if k is None else str(k), i, p, "x") for k, pages in corpora.items() for i, p in enumerate(pages)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "source string, ord int, fragment string, last string").repartition(4)
    got = {(x["source"], x["ord"]): x["fragment"] for x in web_text.clean_pages(df, ["source"]).collect()}
    want = {(None if k is None else str(k), i): p for k, pages in corpora.items() for i, p in enumerate(joined(pages))}
    assert got == want and len(rows) == len(got)
    whole = df.where("source = 'long'")
    assert [x["fragment"] for x in web_text.clean_pages(whole, []).orderBy("ord").collect()] == joined(corpora["long"])
    assert web_text.clean_pages(df.limit(0), ["source"]).count() == 0


def test_pages_of_one_text_equal_clean(spark):
    """A corpus of one page is what `clean` gives."""
    r = random.Random(9)
    rows = [(i, 0, "".join(r.choice(PIECES) for _ in range(8)) + "\n") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, ord int, fragment string")
    one = {x["k"]: x["fragment"] for x in web_text.clean_pages(df, ["k"]).collect()}
    assert one == {x["k"]: x["c"] for x in df.select("k", web_text.clean(df["fragment"], web_text.DLT_RULES).alias("c")).collect()}


def test_a_scan_repeats_no_earlier_step(spark):
    """Pages are written before each scan: what is left to compute holds none of the blocks before."""
    from graphvec.operators import web_text as w

    df = spark.createDataFrame([("s", 1, "a\nwe use essential cookies\n"), ("s", 2, "PreferencesDeclineAccept b\n")], "source string, ord bigint, fragment string")
    made = w.clean_pages(df, ["source"])
    assert "PreferencesDeclineAccept" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(x["fragment"] for x in made.collect()) == [" b\n", "a\n"]
