import random

import pytest

from codexloom.llm import set_join as sj


def jaccard(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("seed", range(3))
def test_pairs_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    base = [frozenset(rng.choice(range(10)) if rng.random() < 0.3 else rng.randrange(1000) for _ in range(rng.randrange(5, 30))) for _ in range(60)]
    sets = {}
    for i, b in enumerate(base):
        sets[i] = b
        for k in range(3):
            x = {v for v in b if rng.random() > 0.15} | {rng.randrange(1000) for _ in range(rng.randrange(3))}
            sets[100 + 3 * i + k] = frozenset(x)
    sets[999], sets[998] = base[0], base[0]
    df = spark.createDataFrame([(i, sorted(map(str, s))) for i, s in sets.items()], "id long, items array<string>")
    got = {(r.left_id, r.right_id) for r in sj.set_pairs(df, 0.6).collect()}
    ids = sorted(sets)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.6 - 1e-12}
    assert got == want


def test_a_token_of_a_third_of_all_rows_and_deep_splitting(spark):
    sets = [(i, ["hot", "warm"] + [f"x{i}_{k}" for k in range(3)]) for i in range(120)] + [(500 + i, ["hot", "warm", "p", "q", f"y{i}"]) for i in range(3)]
    df = spark.createDataFrame(sets, "id long, items array<string>")
    assert {(r.left_id, r.right_id) for r in sj.set_pairs(df, 0.6, small=8, depth=4).collect()} == {(500, 501), (500, 502), (501, 502)}


@pytest.mark.parametrize("shared,private,k", [(4, 1, 200), (5, 1, 200), (9, 4, 100), (3, 2, 100), (12, 2, 100)])
def test_more_sets_than_a_node_holds_that_share_all_but_private_items(spark, shared, private, k):
    df = spark.createDataFrame([(i, [f"s{j}" for j in range(shared)] + [f"x{i}_{j}" for j in range(private)]) for i in range(k)], "id long, items array<string>")
    similar = shared / (shared + 2 * private) >= 0.6
    assert sj.set_pairs(df, 0.6).count() == (k * (k - 1) // 2 if similar else 0)


def test_large_nodes_of_sets_of_several_sizes(spark):
    rng = random.Random(5)
    sets = {i: frozenset([*rng.sample(range(9), rng.randrange(3, 8)), *(100 + 4 * i + k for k in range(rng.randrange(0, 3)))]) for i in range(250)}
    df = spark.createDataFrame([(i, sorted(map(str, s))) for i, s in sets.items()], "id long, items array<string>")
    got = {(r.left_id, r.right_id) for r in sj.set_pairs(df, 0.6, small=8).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.6 - 1e-12}


def test_between_two_tables(spark):
    a = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["x", "y", "z"])], "class long, items array<string>")
    b = spark.createDataFrame([(1, ["a", "b", "c", "d"]), (3, ["x", "q"])], "class long, items array<string>")
    assert [(r.l, r.r, r.overlap) for r in sj.chosen_path_join(a, 0.6, other=b).collect()] == [(1, 1, 3)]


def test_items_are_normalised(spark):
    schema = "work_id string, f array<string>, g array<string>, id string, items string, class string"
    rows = [("w1", [" A", "a ", None, ""], ["a"], "clash", "clash", "clash"), ("w2", None, [], "", "", ""), (None, ["a"], None, "", "", ""), ("w1", ["B"], None, "", "", "")]
    got = {r.id: [x.replace("\x1f", ":") for x in r.items] for r in sj.tagged_items(spark.createDataFrame(rows, schema), "work_id", ("f", "g")).collect()}
    assert got == {"w1": ["f:a", "f:b", "g:a"]}
    assert sj.tagged_items(spark.createDataFrame(rows, schema), "work_id", ("f", "g"), least=4).count() == 0


def test_empty(spark):
    assert sj.set_pairs(spark.createDataFrame([], "id string, items array<string>"), 0.6).count() == 0


def test_trees_grow_with_the_recall_wanted():
    assert sj.trees_needed(0.6, 0.2, 0.99999, 2) > sj.trees_needed(0.6, 0.2, 0.9, 2) >= 1
