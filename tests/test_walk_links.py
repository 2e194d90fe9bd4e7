import glob

import pytest

from graphvec.operators import completion, metrics
from graphvec.storage import shared_dir

EDGES = [("a", "h"), ("h", "a"), ("a", "h"), ("b", "h"), ("h", "c"), ("c", "c"), ("c", "d"), ("x", "y"), (None, "a")]


def reference(seeds, least, rounds):
    near = {}
    for s, t in EDGES:
        if s and s != t:
            near.setdefault(s, set()).add(t)
            near.setdefault(t, set()).add(s)
    out = {}
    for q in {q for q, _ in seeds}:
        own = [i for k, i in seeds if k == q]
        mass, rest = dict.fromkeys(own, 0.0), dict.fromkeys(own, 1 / len(own))
        for _ in range(rounds):
            pushed = {i: r for i, r in rest.items() if i in near and round(r, 12) >= least * len(near[i])}
            for i, r in pushed.items():
                mass[i] += 0.2 * r
                rest[i] -= r
            for i, r in pushed.items():
                for v in near[i]:
                    mass.setdefault(v, 0.0)
                    rest[v] = rest.get(v, 0.0) + 0.8 * r / len(near[i])
        out |= {(q, i): round(mass[i] + rest[i], 9) for i in mass}
    return out


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_walk_writes_a_link_once(spark, monkeypatch, few):
    monkeypatch.setattr(completion, "FEW", few, raising=False)
    edges, seeds = spark.createDataFrame(EDGES, "src string, dst string"), [(1, "a"), (1, "x"), (2, "h"), (3, "alone")]
    before = set(glob.glob(shared_dir(spark).removeprefix("file://").removeprefix("file:") + "/graphvec-*"))
    found = completion.walk_mass(spark.createDataFrame(seeds, "qid int, id string"), edges, least=0.02)
    assert {(r["qid"], r["id"]): round(r["mass"], 9) for r in found.collect()} == reference(seeds, 0.02, completion.ROUNDS)
    new = set(glob.glob(shared_dir(spark).removeprefix("file://").removeprefix("file:") + "/graphvec-*")) - before
    assert not [x for x in new if "/graphvec-pairs-" in x]  # both directions of all edges
    assert [spark.read.parquet(x).count() for x in new if "/graphvec-links-" in x] == [5]


def test_links_and_pairs(spark):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    links = {tuple(x) for x in metrics.simple_links(edges).collect()}
    assert links == {("a", "h"), ("b", "h"), ("c", "h"), ("c", "d"), ("x", "y")}
    assert sorted(tuple(x) for x in metrics.simple_pairs(edges).collect()) == sorted(links | {(v, u) for u, v in links})
