import random

import pytest

from codexloom.llm import title_versions as tv
from codexloom.operators import delta


def brute(sets, t):
    out = set()
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            x_, y_ = set(x or []) - {None}, set(y or []) - {None}
            if x_ and y_ and len(x_ & y_) / len(x_ | y_) >= t - 1e-9:
                out.add((min(a, b), max(a, b), len(x_ & y_)))
    return out


@pytest.mark.parametrize("seed,t", [(1, 0.5), (2, 0.7), (3, 0.34), (4, 0.9)])
def test_join_equals_brute_force(spark, seed, t):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 40}" for _ in range(4000)]
    sets = []
    for i in range(160):
        n = rng.choice([0, 1, 1, 2, 3, 5, 8, 12])
        sets.append((i, [rng.choice(words) for _ in range(n)]))
    sets += [(200 + i, list(x or [])[:-1] or None) for i, x in sets[:60]] + [(400, None), (401, [None, "w1"]), (402, ["w1"])]
    df = spark.createDataFrame([(i, x, "clash") for i, x in sets], "id long, tokens array<string>, prefix string")
    got = {tuple(r) for r in tv.grouped_prefix_join(df, t).collect()}
    assert got == brute(sets, t)


def groups(spark, titles):
    rows = spark.createDataFrame([(f"d{i:02}", t, "clash", i) for i, t in enumerate(titles)], "document_id string, title string, words string, mark int")
    found = {}
    for r in tv.title_versions(rows, rare_least=14).collect():
        found.setdefault(r.title_group, set()).add(int(r.document_id[1:]))
    return sorted(map(sorted, found.values()))


NAMES = ("Aliko", "Brevan", "Codrik", "Delmo", "Estavo", "Fenwig", "Golbrat", "Hustino", "Ilmar", "Jodrel", "Kastun", "Lumbert", "Nerigal", "Opatro", "Pulvex", "Quandar")
#: Other systems under the very same words, which makes these words common.
FILL = [f"Sparse Attention for Kelp Forests: {n} through Joint Gating and Mixed Estimates" for n in NAMES]


def test_versions_and_other_papers(spark):
    base = "Sparse Attention for Kelp Forests: Zavolin through Joint Gating and Mixed Estimates"
    same = [base, base.upper(), base + " (preprint)", "Sparse_Attention_for_Kelp_Forests_Zavolin_through_Joint_Gating_and_Mixed_Estimates_final.pdf", "Sparse Attention for Kelp Forests: Zavo1in through J0int Gating & Mixed Estimates", "Sparse for Attention Kelp Forests: Zavolin through Joint Gating and Mixed...", "Spárse Attention for Kelp Forests:  Zavolin through Joint Gating and Estimates [revised]"]
    other = [base.replace("Zavolin", "Mirodek"), base + ", Part I", base + ", Part II", base + " 2014", base + " 2015"]
    got = groups(spark, [*same, *other, *FILL])
    assert list(range(len(same))) == next(g for g in got if 0 in g)
    for k in range(len(other)):
        assert [len(same) + k] in got, other[k]


def test_defined_results_of_odd_rows(spark):
    schema = "document_id string, title string"
    assert tv.title_versions(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([("a", None), ("b", ""), ("c", " \n "), (None, "A title of some words"), ("d", "A title of some words"), ("d", "A title of some words"), ("e", "A title of some words"), ("f", "word " * 5000)], schema)
    found = tv.title_versions(rows)
    assert sorted(r.document_id for r in found.collect()) == ["d", "e", "f"]
    assert [tuple(r) for r in tv.version_pairs(found).collect()] == [("d", "e")]


def test_the_current_title_counts(spark):
    from datetime import datetime

    rows = spark.createDataFrame([("a", "Old name here", datetime(2020, 1, 1)), ("a", "New name here", datetime(2021, 1, 1)), ("b", "x", None)], "document_id string, title string, updated_at timestamp")
    assert {r.document_id: r.title for r in delta.latest_rows(rows).collect()} == {"a": "New name here", "b": "x"}


@pytest.mark.parametrize("a,b,same", [("detection", "detecton", True), ("detection", "dteection", True), ("maps", "mops", True), ("maps", "rods", False), ("alpha", "omega", False)])
def test_small_edits(a, b, same):
    assert tv.near(a, b) is same
