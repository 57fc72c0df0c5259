import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from codexloom.llm import canonical as ca

ENTRIES = [(1, "data", "Zavolin-20", None), (2, "data", "Zavolin-100", None), (3, "data", "Merodek Atlas", None), (4, "metric", "PKR", "peak kernel ratio"), (5, "metric", "PKR95", "peak kernel rate"), (6, "model", "Kastun-S", None), (7, "model", "Kastun-L", None), (8, "data", "Pulvex3D", None), (9, "metric", "MVE", "mean vertex error"), (10, "metric", "PTL", "peak timing loss")]
CASES = [
    ("data", "Zavolin-20", 1), ("data", "the ZAVOLIN 20 dataset [3]", 1), ("data", "zavolin20 (test split)", 1), ("data", "Zavolin-50", None), ("data", "Zavolin", None), ("data", "Zavolni-100", 2), ("data", "Atlas Merodek", 3),
    ("data", "Merod. Atlas", 3), ("data", "Meródek_Atlas data<sup>2</sup>", 3), ("data", "PKR", None), ("metric", "PKR (%)", 4), ("metric", "PXR", None), ("metric", "peak kernel ratio (PKR) ↑", 4), ("metric", "ratio, peak kernel", 4), ("metric", "peak kernal ratio value", 4),
    ("model", "Kastun-M", None), ("model", "Kastun S et al.", 6), ("model", "KastunL", 7), ("data", "pulvex 3D", 8), ("metric", "peak vertex error", None), ("metric", "maen vertex error", 9), ("metric", "mean vertex eror (MVE)", 9), ("data", "something else", None), ("data", "", None), ("data", "…", None),
]


@pytest.mark.parametrize("kind,name,entity", CASES)
def test_values(kind, name, entity):
    m = ca.Matcher([(i, n, f) for i, k, n, f in ENTRIES if k == kind])
    hit = m.match(name)
    assert (hit and hit[0]) == entity, hit


words = st.text(alphabet="abc", max_size=7)


@settings(max_examples=300, deadline=None)
@given(words, words, words)
def test_the_distance_is_a_metric(a, b, c):
    d = ca.edit_distance
    assert (d(a, b) == 0) == (a == b) and d(a, b) == d(b, a) and d(a, c) <= d(a, b) + d(b, c)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_tree_equals_a_scan(most):
    rng = random.Random(most)
    entries = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 8))) for _ in range(200)})
    tree = ca.BKTree(entries)
    for _ in range(40):
        q = "".join(rng.choice("abcd") for _ in range(rng.randrange(0, 9)))
        assert sorted(tree.within(q, most)) == sorted((e, ca.edit_distance(q, e)) for e in entries if ca.edit_distance(q, e) <= most)
        e = rng.choice(entries)
        assert min(ca.edit_distance(q, e, most), most + 1) == min(ca.edit_distance(q, e), most + 1)
    assert ca.BKTree([]).within("a", 2) == []


SCHEMA = "mention_id long, kind string, name string, entity_id string, edits string"


def mapped(spark, rows, entries, **options):
    reference = spark.createDataFrame(entries, "entity_id long, kind string, name string, full_name string")
    df = ca.matched_mentions(spark.createDataFrame(rows, SCHEMA), reference, **options)
    return sorted((r.mention_id, r.entity_id) for r in df.collect())


def test_table_broadcast_and_sharded(spark):
    rows = [(i, k, n, "clash", "clash") for i, (k, n, _) in enumerate(CASES)] + [(0, CASES[0][0], CASES[0][1], "clash", "clash"), (90, None, "PKR", None, None), (91, "data", None, None, None), (92, "none such", "PKR", None, None), (93, "data", "x" * 20_000, None, None)]
    want = sorted([(i, e) for i, (_, _, e) in enumerate(CASES)] + [(90, None), (91, None), (92, None), (93, None)])
    assert mapped(spark, rows, ENTRIES) == want
    for size in (1, 3, 100):
        assert mapped(spark, rows, ENTRIES, broadcast_limit=0, shard_size=size, cell_values=5) == want


def test_ties_and_other_entries_words_across_shards(spark):
    entries = [(1, "data", "kestral region", None), (2, "data", "lomvik basin", None), (3, "data", "harmonix", None), (4, "data", "harmonit", None), (5, "data", "harmxnxs", None)]
    rows = [(1, "data", "harmonis", None, None), (2, "data", "kestral basin", None, None), (3, "data", "kestrol region", None, None)]
    want = mapped(spark, rows, entries)
    assert want == [(1, None), (2, None), (3, 1)]
    for size in (1, 2, 5):
        assert mapped(spark, rows, entries, broadcast_limit=0, shard_size=size, cell_values=2) == want


@pytest.mark.parametrize("seed", range(3))
def test_random_lists_match_alike_whatever_the_shards(spark, seed):
    """Words of a small alphabet, so that ties, misspellings and words of other entries are common."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abe") for _ in range(rng.randrange(3, 8)))
    name = lambda: " ".join(word() for _ in range(rng.randrange(1, 4)))
    entries = [(i, rng.choice("xy"), name(), rng.choice([None, name()])) for i in range(60)]
    rows = []
    for i in range(200):
        typed = list(rng.choice(entries)[2] if rng.random() < 0.8 else name())
        for _ in range(rng.randrange(0, 3)):
            typed[rng.randrange(len(typed))] = rng.choice("abe .")
        rows.append((i, rng.choice("xy"), "".join(typed), None, None))
    want = mapped(spark, rows, entries)
    assert sum(e is None for _, e in want) > 20 and sum(e is not None for _, e in want) > 20
    assert mapped(spark, rows, entries, broadcast_limit=0, shard_size=7, cell_values=40) == want


def test_empty(spark):
    assert mapped(spark, [], ENTRIES, broadcast_limit=0) == [] and mapped(spark, [(1, "data", "PKR", None, None)], [], broadcast_limit=-1) == [(1, None)]
    assert mapped(spark, [], ENTRIES) == [] and mapped(spark, [(1, "data", "PKR", None, None)], []) == [(1, None)]
