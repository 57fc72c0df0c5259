import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from codexloom.operators import components, graphs, mentions, records, search, sections, works


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def components_by_hand(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted((x, find(x)) for x in parent)


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 240)] + [(None, 1), (5, None), (300, 300)]
    assert rows(components.connected_components(spark.createDataFrame(edges, "src int, dst int"))) == components_by_hand(edges)


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_duplicates_and_known_files(spark):
    files = spark.createDataFrame([("b", "h1"), ("a", "h1"), ("c", "h2"), ("d", None)], "path string, sha256 string")
    assert rows(works.already_known(files, spark.createDataFrame([("h2",), (None,)], "sha256 string")).select("path", "canonical", "action")) == [("a", "a", "new"), ("b", "a", "not_copied"), ("c", "c", "already_ingested"), ("d", "d", "new")]


def test_title_groups_respect_identifiers(spark):
    data = [("d1", "w1", "k", "10.1/a", None, 1, False), ("d2", "w2", "k", None, None, 2, True), ("d3", "w3", "z", "10.1/a", None, 3, False), ("d4", "w4", "z", "10.1/b", None, 4, False), ("d5", "w5", "", None, None, 5, False), ("d6", "w6", "z2", "10.48550/x", None, 6, False), ("d7", "w7", "z2", "10.1/c", None, 7, False)]
    files = spark.createDataFrame(data, "document_id string, work_id string, title_key string, doi string, arxiv_id string, idx int, known boolean")
    assert {r.document_id: r.group_work_id for r in works.title_groups(files).collect()} == {"d1": "w2", "d2": "w2", "d3": "w3", "d4": "w4", "d5": "w5", "d6": "w6", "d7": "w6"}


def test_format_policy(spark):
    files = spark.createDataFrame([("d1", "w", "html", True), ("d2", "w", "pdf", False), ("d3", "w", "docx", None), ("d4", "v", None, True), ("d5", "u", "pdf", False)], "document_id string, work_id string, format string, extractable boolean")
    assert {r.document_id: (r.selected, r.reason) for r in works.format_policy(files).collect()} == {"d1": (False, "alternate_of:d3"), "d2": (False, "not_extractable"), "d3": (True, "preferred_format"), "d4": (True, "only_representation"), "d5": (False, "not_extractable")}


@pytest.mark.parametrize("seed", range(2))
def test_fuzzy_pairs_lose_none(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdef12") for _ in range(rng.randrange(1, 40))) for _ in range(25)]
    keys = sorted({k for b in base for k in (b, b[1:], b + "xy", b[: len(b) // 2] + "q" + b[len(b) // 2 :]) if k})
    got = {(r.left_key, r.right_key) for r in works.fuzzy_key_pairs(spark.createDataFrame([(k,) for k in keys], "title_key string")).collect()}
    want = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if SequenceMatcher(None, a, b).ratio() >= 0.75}
    assert got == want


def test_trigram_candidates_equal_brute_force(spark):
    rng = random.Random(5)
    keys = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 15))) for _ in range(60)]
    files = [(f"d{i:02}", k) for i, k in enumerate(keys)]
    grams = lambda k: {k[i : i + 3] for i in range(max(1, len(k) - 2))}
    want = {(a, b) for i, (a, ka) in enumerate(files) for b, kb in files[i + 1 :] if len(grams(ka) & grams(kb)) >= max(1, min(len(grams(ka)), len(grams(kb))) // 2)}
    got = {(r.left_document_id, r.right_document_id) for r in works.trigram_candidates(spark.createDataFrame(files, "document_id string, title_key string")).collect()}
    assert got == want


def fold_by_hand(blocks):
    stack, heading, out = [], "Front matter", []
    for level, text in blocks:
        t = (text or "").strip()
        if level and t:
            heading, stack = t, [*stack[: max(0, level - 1)], t]
        elif t.lower().startswith("abstract") and not t[8:9].isalnum():
            heading, stack = "Abstract", ["Abstract"]
        out.append(list(stack) or [heading])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_section_fold_equals_a_sequential_fold(spark, seed):
    rng = random.Random(seed)
    docs = {d: [(rng.choice([None, None, 1, 2, 3, 4]), rng.choice(["Intro", "Methods", "Abstract: x", "text", "", " ", None, "abstracts"])) for _ in range(30)] for d in "abc"}
    data = [(d, i, level, text) for d, blocks in docs.items() for i, (level, text) in enumerate(blocks)]
    rng.shuffle(data)
    got = {(r.document_id, r.idx): r.section_path for r in sections.section_fold(spark.createDataFrame(data, "document_id string, idx int, heading_level int, text string")).collect()}
    assert got == {(d, i): path for d, blocks in docs.items() for i, path in enumerate(fold_by_hand(blocks))}


def test_selection_falls_back_to_the_abstract(spark):
    long = "x" * 90
    data = [("d", i, f"b{i}", "text", role, f"{long} {i}") for i, role in enumerate(["abstract"] * 4 + ["results"] * 8)] + [("e", 0, "m", "text", "methodology", long), ("e", 1, "h", "header", "abstract", long), ("e", 2, "s", "text", "abstract", "x" * 79)]
    got = sections.select_statements(spark.createDataFrame(data, "document_id string, idx int, block_id string, type string, section_role string, text string"))
    by = {}
    for r in got.collect():
        by.setdefault((r.document_id, r.field), []).append(r.block_id)
    assert sorted(by["d", "methodology"]) == ["b0", "b1"] and by["e", "methodology"] == ["m"] and len(by["d", "results"]) == 6 and ("d", "ablations") not in by


def test_vocabulary_mentions_and_labels(spark):
    blocks = spark.createDataFrame([("w1", "d1", 0, "b0", "uses Flow-Net and C#"), ("w1", "d1", 1, "b1", "workflow only"), ("w1", "d2", 0, "b2", "FLOW here, flow there"), (None, None, None, None, None)], "work_id string, document_id string, idx int, block_id string, text string")
    aliases = spark.createDataFrame([("f", "x.optical_flow", "flow"), ("f", "x.c", "C#"), ("f", "x.none", "!!")], "facet string, label_id string, alias string")
    assert rows(mentions.taxonomy_labels(blocks, aliases)) == [("w1", "f", "x.c", "C", 1, "b0"), ("w1", "f", "x.optical_flow", "Optical Flow", 2, "b0,b2")]


def test_references(spark):
    blocks = spark.createDataFrame([("d", 0, "b", "references", ["References"], "[1] A. Lee, 2019. A long title here. X.\n\nshort\n2. B. Ono, “Quoted title”, 2020, arXiv:2001.00001."), ("d", 1, "c", "results", ["Results"], "not a reference line at all")], "document_id string, idx int, block_id string, section_role string, section_path array<string>, text string")
    got = mentions.references(blocks).orderBy("ref_index").collect()
    assert [(r.ref_index, r.title, r.year, r.arxiv_id) for r in got] == [(1, "A long title here", 2019, None), (2, "Quoted title", 2020, "2001.00001.")]


def test_statement_aggregate_prefers_richer_evidence(spark):
    data = [("w", "f", 1, "Same", 1), ("w", "f", 2, " same ", 3), ("w", "f", 3, "SAME", 3), ("w", "f", 4, " ", 9), ("w", "f", 5, None, 9)]
    assert rows(records.aggregate_statements(spark.createDataFrame(data, "work_id string, field string, pos long, statement string, n_evidence int"))) == [("w", "f", 1, " same ", 3)]


def test_evidence(spark):
    s = spark.createDataFrame([("d", "b", 2, ["A", "B"]), ("d", "b", 2, ["A", "B"])], "document_id string, block_id string, page_index int, section_path array<string>")
    e = spark.createDataFrame([(1, "d", "b", 2, "A > B"), (2, "d", "b", 3, None), (3, "d", "b", None, None), (4, "d", "x", None, None), (5, "d", "b", 2, "A"), (6, None, None, None, None)], "n int, document_id string, block_id string, page_index int, section string")
    assert {r.n: r.valid for r in records.validate_evidence(e, s).collect()} == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}


def test_precision_recall_conventions(spark):
    schema = "work_id string, kind string, label string"
    p = spark.createDataFrame([("w", "d", "A"), ("w", "d", "b"), ("x", "d", "a"), ("z", "d", " ")], schema)
    e = spark.createDataFrame([("w", "d", "a"), ("w", "d", "C"), ("y", "d", "a")], schema)
    got = {r.work_id: (r.precision, r.recall, r.f1) for r in records.precision_recall(p, e).collect()}
    assert got == {"w": (0.5, 0.5, 0.5), "x": (0.0, 1.0, 0.0), "y": (0.0, 0.0, 0.0)}


def test_fingerprints_and_changes(spark):
    schema = "work_id string, title string"
    a, b = spark.createDataFrame([("w", "t"), ("x", None), ("y", "s")], schema), spark.createDataFrame([("w", "t"), ("x", ""), ("z", "s")], schema)
    prints = lambda df: records.fingerprints(df, ("title",))
    assert rows(records.changed_works(prints(a), prints(b))) == [("x", "changed"), ("y", "removed"), ("z", "added")]


def test_citations(spark):
    ws = spark.createDataFrame([("w1", "Deep flow estimation in rivers", "10.1/A", None), ("w2", "Another title of some length", None, "2001.1"), ("w3", "Deep flow estimation in rivers", None, None)], "work_id string, title string, doi string, arxiv_id string")
    refs = spark.createDataFrame([
        ("w2", 1, "x", None, "10.1/a", None), ("w1", 2, "y", None, None, "2001.1"), ("w2", 3, "Lee 2019 deep flow estimation in river", "Deep flow estimation in river", None, None),
        ("w9", 4, "Lee, A., Deep flow estimation in rivers, J 2", None, None, None), ("w9", 5, "short", None, None, None), ("w1", 6, "Deep flow estimation in rivers", None, None, None),
    ], "work_id string, ref_index int, raw string, title string, doi string, arxiv_id string")
    got = {r.ref_index: (r.target_work_id, r.status) for r in graphs.citation_edges(refs, ws).collect()}
    assert got == {1: ("w1", "verified"), 2: ("w2", "verified"), 3: ("w1", "candidate"), 4: ("w1", "candidate"), 6: ("w3", "candidate")}


def test_search_modes(spark):
    blocks = spark.createDataFrame([("b1", "Flow", "results", "optical flow of water"), ("b2", "Flow", "results", "nothing here"), ("b3", None, None, "  "), ("b4", "Other", None, "water and fire, crème brûlée")], "block_id string, title string, section string, text string")
    best = search.search(blocks, "optical water", 2).collect()
    assert best[0].block_id == "b1" and best[0].score > best[1].score
    assert [r.block_id for r in search.search(blocks, "creme", 5, "lexical").collect()] == ["b4"]
    assert search.search(blocks, "absent", 5).count() == 0
    with pytest.raises(ValueError):
        search.search(blocks, "x", 1, "magic")


def test_nearest_vectors_are_exact(spark):
    rng = random.Random(1)
    data = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(80)] + [(80, None), (81, [0.0] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = search.nearest_vectors(df, df.where("vec_id % 20 = 0"), 3)
    assert got.where("query_id = 0").count() == 3 and got.where(F.col("cosine") > 1).count() == 0


def test_common_subsequences_equal_the_table(spark):
    import random

    from codexloom.functions import similarity as sim

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
        return row[-1]

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abc09z") for _ in range(n))
    pairs = [(word(rng.randrange(0, 30)), word(rng.randrange(0, 90))) for _ in range(150)] + [(word(63), word(63)), (word(64), word(70)), (word(150), word(200)), ("", "")]
    assert sim.common_subsequence([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [longest(a, b) for a, b in pairs]
    assert sim.common_subsequence(["éa"], ["üa"]).tolist() == [2] and sim.common_subsequence([], []).tolist() == []


@pytest.mark.parametrize("threshold", [0.75, 0.85])
def test_alike_keys_lose_no_pair(spark, threshold):
    import random
    from difflib import SequenceMatcher

    from codexloom.functions import similarity as sim
    from codexloom.operators import works

    rng = random.Random(4)
    base = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(6, 50))) for _ in range(25)]
    keys = sorted({"".join(ch for ch in b if rng.random() > 0.1) + rng.choice(["", "x", "zz", "é"]) for b in base for _ in range(4)})
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    met = works.alike_keys(df.toDF("a"), df.toDF("b"), threshold, rows_per_cell=9)
    got = {(r.a, r.b) for r in met.withColumn("r", sim.ratio_at_least(threshold)("a", "b")).where("r > 0").collect()}
    assert got == {(a, b) for a in keys for b in keys if SequenceMatcher(None, a, b).ratio() >= threshold}


def test_match_candidates_of_few_and_of_many_files(spark):
    from codexloom.operators import works

    rows = [("d1", "w1", "sparseattention"), ("d2", "w2", "sparseattentions"), ("d3", "w1", "sparseattention"), ("d4", None, "otherthing"), ("d5", "w5", ""), (None, "w6", "sparseattention"), ("d7", "w7", None)]
    df = spark.createDataFrame(rows, "document_id string, work_id string, title_key string")
    want = [("d1", "d2"), ("d2", "d3")]
    for few in (0, 60):
        assert sorted((r[0], r[1]) for r in works.match_candidates(df, all_pairs=few).collect()) == want


def test_headings_of_one_place_do_not_multiply_blocks(spark):
    data = [("d", 0, 3, "Deep"), ("d", 0, 3, "Twin"), ("d", 1, None, "text"), ("d", 2, 9, "Below"), ("d", 3, 2, "Up")]
    got = sections.section_fold(spark.createDataFrame(data, "document_id string, idx int, heading_level int, text string")).collect()
    assert sorted((r.idx, r.text, r.section_path) for r in got if r.idx) == [(1, "text", ["Deep", "Twin"]), (2, "Below", ["Deep", "Twin", "Below"]), (3, "Up", ["Deep", "Up"])] and len(got) == 5


def test_only_pairs_with_a_long_common_subsequence_leave_a_task(spark):
    rng = random.Random(3)
    letters = list("abcdefghijklmnopqrstuvwxyz" * 3)
    keys = []
    for _ in range(40):
        rng.shuffle(letters)
        keys.append("".join(letters))
    near = "x" + keys[0][1:-1]
    df = spark.createDataFrame([(k,) for k in [*keys, near]], "a string")
    for met in (works.alike_keys(df, None, 0.75, rows_per_cell=15), works.alike_keys(df, df.withColumnRenamed("a", "b"), 0.75, rows_per_cell=15).where("a < b")):
        assert [(r.a, r.b) for r in met.collect()] == [tuple(sorted((keys[0], near)))]


def test_match_candidates_share_few_trigrams_too(spark):
    base = "abcdefghijklmnopqrstuvwxyz0123"
    df = spark.createDataFrame([("d1", "w1", base), ("d2", "w2", "_".join(base[i : i + 3] for i in range(0, 30, 3)).replace("_", "q")), ("d3", "w3", base[::-1])], "document_id string, work_id string, title_key string")
    for few in (0, 60):
        assert [(r[0], r[1]) for r in works.match_candidates(df, all_pairs=few).collect()] == [("d1", "d2")]


def test_trigram_candidates_in_several_blocks(spark):
    rng = random.Random(6)
    keys = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 30))) for _ in range(70)]
    files = [(f"d{i:02}", k) for i, k in enumerate([*keys, *keys[:5]])]
    grams = lambda k: {k[i : i + 3] for i in range(max(1, len(k) - 2))}
    every = [(a, b, len(grams(ka) & grams(kb)), min(len(grams(ka)), len(grams(kb)))) for i, (a, ka) in enumerate(files) for b, kb in files[i + 1 :]]
    got = rows(works.trigram_candidates(spark.createDataFrame(files, "document_id string, title_key string"), rows_per_cell=8))
    assert got == sorted(x for x in every if x[2] >= max(1, x[3] // 2))


def test_related_pairs_in_several_blocks_equal_brute_force(spark):
    rng = random.Random(7)
    items = {"facet": 6, "dataset": 9, "text": 30, "reference": 12}
    own = {f"w{i:02}": {k: {f"{k}{rng.randrange(n)}": float(rng.randrange(1, 4)) if k == "text" else 1.0 for _ in range(rng.randrange(5))} for k, n in items.items()} for i in range(60)}
    data = [(w, k, item, weight) for w, kinds in own.items() for k, found in kinds.items() for item, weight in found.items()] + [("w00", "text", "alone", 2.0), (None, "text", "text1", 1.0)]
    own["w00"]["text"]["alone"] = 2.0
    want = {}
    for a in own:
        for b in own:
            if a < b:
                v = {}
                for k in items:
                    x, y = own[a][k], own[b][k]
                    dot = sum(x[t] * y[t] for t in x.keys() & y.keys())
                    under = (sum(t * t for t in x.values()) * sum(t * t for t in y.values())) ** 0.5 if k == "text" else len(x) + len(y) - dot
                    v[k] = dot / under if dot else 0.0
                score = sum(graphs.WEIGHTS[k] * v[k] for k in items)
                if score >= 0.16 and (sum(t > 0 for t in v.values()) >= 2 or v["text"] >= 0.55 or v["reference"] >= 0.2):
                    want[a, b] = [*v.values(), score]
    got = {(r[0], r[1]): list(r[2:]) for r in graphs.related_pairs(spark.createDataFrame(data, "work_id string, kind string, item string, weight double"), works_per_block=7).collect()}
    assert got.keys() == want.keys() and len(got) > 50
    assert all(abs(x - y) <= 5.1e-5 for p in got for x, y in zip(got[p], want[p]))


def test_best_related_pairs_equal_those_of_all_pairs(spark):
    rng = random.Random(11)
    kinds = {"facet": 3, "dataset": 4, "text": 9, "reference": 5}  # few items, so that many scores are equal or near
    data = [(f"w{i:02}", k, f"{k}{rng.randrange(n)}", 1.0) for i in range(70) for k, n in kinds.items() for _ in range(3)]
    features = spark.createDataFrame(sorted(set(data)), "work_id string, kind string, item string, weight double").cache()
    for weight in (1.0, 1.25):  # whole weights are summed in float32
        rows_in = features.withColumn("weight", F.col("weight") * weight)
        want = rows(graphs.related_top(graphs.related_pairs(rows_in), 2))
        got = graphs.related_best(rows_in, 2, works_per_block=20, works_per_part=6)
        assert rows(got) == want and 70 < len(want) < 140
        assert rows(graphs.related_best(rows_in, 2, works_per_block=20, most_blocks=1)) == want


def test_pruning_of_related_ends_keeps_what_is_equal_after_rounding():
    rng = np.random.default_rng(5)
    own, score = rng.integers(0, 40, 3_000), np.round(0.16 + 0.01 * rng.random(3_000), 5)
    kept = set(graphs._may_be_best(own, score, 5).tolist())
    for w in range(40):
        here = np.flatnonzero(own == w)
        limit = np.sort(np.round(score[here], 4))[-5]
        assert {k for k in here.tolist() if round(score[k], 4) >= limit} <= kept
    assert len(kept) < 1_000


def test_graph_stores_no_related_pairs_and_names_no_blocks(spark, tiny, monkeypatch):
    from codexloom import queries

    def never(*_, **__):
        raise AssertionError("the graph needs the best pairs and the labels alone")

    want = {r.measure: r.n for r in queries.queries()["graph_summary"](spark, tiny).collect()}
    monkeypatch.setattr(graphs, "related_pairs", never)
    monkeypatch.setattr(mentions, "taxonomy_labels", never)
    assert {r.measure: r.n for r in queries.queries()["graph_summary"](spark, tiny).collect()} == want


def test_work_labels_equal_taxonomy_labels_and_shuffle_no_text(spark):
    texts = ["Deep flow and C# code", "deep flows", "a DEEP-FLOW, c#", "", None, "flow deep"]
    blocks = spark.createDataFrame([(f"d{i % 4}", i, f"b{i}", texts[i % len(texts)]) for i in range(24)] * 2, "document_id string, idx int, block_id string, text string")
    owner = spark.createDataFrame([("w1", "d0"), ("w1", "d1"), ("w2", "d1"), ("w3", "d2"), ("w4", None)], "work_id string, document_id string")
    aliases = spark.createDataFrame([("aim", "aim.flow", "deep flow"), ("aim", "aim.flow", "flow"), ("sign", "sign.c_sharp", "C#"), ("none", "none.none", "--")], "facet string, label_id string, alias string")
    want = rows(mentions.taxonomy_labels(blocks.distinct().join(owner, "document_id"), aliases).select("work_id", "facet", "label_id"))
    assert len(want) >= 4
    for limit in (100, 0):
        got = mentions.work_labels(blocks, owner, aliases, limit)
        assert rows(got) == want
    few = mentions.work_labels(blocks, owner, aliases)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in few


def test_equal_reference_lines_are_compared_once(spark, monkeypatch):
    seen = {}

    def counted(df, label="table"):
        out = cut(df, label)
        seen[label] = out.count()
        return out

    cut = graphs.cut
    monkeypatch.setattr(graphs, "cut", counted)
    ws = spark.createDataFrame([("w1", "Deep flow estimation in rivers", None, None)], "work_id string, title string, doi string, arxiv_id string")
    refs = spark.createDataFrame([(f"x{i}", 1, "Lee, A., Deep flow estimation in rivers, J 2", None, None, None) for i in range(50)], "work_id string, ref_index int, raw string, title string, doi string, arxiv_id string")
    assert graphs.citation_edges(refs, ws).where("target_work_id = 'w1' and status = 'candidate'").count() == 50
    assert seen["contained-titles"] == 1


def test_nodes_need_no_related_works_and_no_citations(spark, tiny, monkeypatch):
    from codexloom import queries

    def never(*_, **__):
        raise AssertionError("nodes need no edges")

    monkeypatch.setattr(graphs, "related_pairs", never)
    monkeypatch.setattr(graphs, "citation_edges", never)
    assert queries.queries()["knowledge_graph_nodes"](spark, tiny).count() == 3
