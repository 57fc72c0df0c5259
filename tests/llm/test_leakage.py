import random

from codexloom.llm import leakage as lk

VOC = [f"word{i}" for i in range(400)]


def texts(seed, n, size):
    rng = random.Random(seed)
    return [" ".join(rng.choice(VOC) for _ in range(size)) for _ in range(n)]


def leaks(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string, segment string, terms string")
    i = spark.createDataFrame(items, "item_id long, text string, suite string")
    return {(r.doc_id, r.item_id): r for r in lk.leaked_items(d, i, **options).collect()}


def test_whole_part_edited_and_absent(spark):
    items = texts(1, 6, 60)
    w = items[0].split()
    edited = [x if k % 9 else x + "q" for k, x in enumerate(w)]
    docs = {
        1: "before " + items[0] + " after", 2: " ".join(w[:20]), 3: " ".join(w[:8]), 4: " ".join(edited), 5: " ".join(w[:10]) + " filler" * 40 + " " + " ".join(w[40:50]), 6: texts(9, 1, 300)[0], 7: items[1].upper() + "\n\n" + items[2],
        8: "", 9: None, 10: " ".join(w[:9] + w[11:16]), 11: " ".join(texts(5, 1, 50_000)) + " " + items[3],
    }
    found = leaks(spark, [(k, v, "clash", "clash") for k, v in docs.items()] + [(1, docs[1], "", ""), (None, items[0], "", "")], [(i, t, "s") for i, t in enumerate(items)] + [(90, None, "s"), (None, "x", "s"), (91, "too short", "s")])
    assert set(found) == {(1, 0), (2, 0), (4, 0), (5, 0), (7, 1), (7, 2), (11, 3)} | {(10, 0)}
    assert found[1, 0].coverage == 1.0


def test_segments_do_not_change_the_result(spark):
    items, docs = texts(2, 5, 40), texts(3, 60, 80)
    docs = [d + " " + items[k % 5] if k % 7 == 0 else d for k, d in enumerate(docs)]
    rows, its = [(k, d, "", "") for k, d in enumerate(docs)], [(i, t, "") for i, t in enumerate(items)]
    d = spark.createDataFrame(rows, "doc_id long, text string, a string, b string")
    i = spark.createDataFrame(its, "item_id long, text string, suite string")
    small = {tuple(r) for r in lk.search_index(lk.build_index(d, segment_chars=500), i).collect()}
    large = {tuple(r) for r in lk.search_index(lk.build_index(d.coalesce(1)), i).collect()}
    assert small == large and {(r[0], r[1]) for r in small} == {(k, k % 5) for k in range(0, 60, 7)}


def test_index_holds_every_position(spark):
    docs = texts(4, 20, 50)
    index = lk.build_index(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    assert sum(len(r.deltas) for r in index.collect()) == 20 * 50
    counts = lk.term_counts(index, VOC[:30])
    assert counts == {w: n for w in VOC[:30] if (n := sum(d.split().count(w) for d in docs))}


def test_shared_instructions_do_not_count(spark):
    line = "answer the question below in one short sentence please and be brief about it now"
    items = [(i, f"{line} {t}", "") for i, t in enumerate(texts(6, 8, 30))]
    assert leaks(spark, [(1, f"note: {line}", "", "")], items) == {}


def test_versions_of_one_item_leak_although_they_share_their_phrases(spark):
    line = "answer the question below in one short sentence please and be brief about it now or later"
    passage = texts(12, 1, 40)[0]
    items = [(i, f"{line} {passage} ending {i}", "") for i in range(5)] + [(9 + i, f"{line} {t}", "") for i, t in enumerate(texts(13, 8, 40))]
    quote = " ".join(passage.split()[:9])
    assert set(leaks(spark, [(1, f"intro {passage} outro", "", ""), (2, f"it says {quote} there", "", ""), (3, line, "", "")], items)) == {(1, i) for i in range(5)}


def test_shards_of_items_do_not_change_the_result(spark):
    shared = " ".join(VOC[:12])
    items = [(i, f"{shared} {t}", "") for i, t in enumerate(texts(14, 12, 40))]
    docs = [(i, f"{t} {shared} {items[i % 12][1]}" if i % 3 == 0 else f"{t} {shared}", "", "") for i, t in enumerate(texts(15, 30, 60))]
    whole = leaks(spark, docs, items)
    assert whole == leaks(spark, docs, items, shard_chars=700) and set(whole) == {(i, i % 12) for i in range(0, 30, 3)}


def test_phrase_matches_equal_a_scan(spark):
    items, docs = texts(7, 4, 30), texts(8, 30, 200)
    docs = [d.replace("word1 ", items[0][:60] + " ") for d in docs]
    grams = {(i, j): items[i].split()[j : j + 4] for i in range(4) for j in range(27)}
    want = sum(1 for d in docs for g in grams.values() for k in range(len(d.split()) - 3) if d.split()[k : k + 4] == g)
    import numpy as np
    import pyarrow as pa

    s = lk._segment(list(range(30)), docs)
    names = ["segment", "doc_ids", "doc_starts", "terms", "term_starts", "deltas"]
    batch = pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), *(pa.array([s[k]], t) for k, t in zip(names[1:], (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))))], names=names)
    p = lk.item_phrases(list(enumerate(items)), {}, {}, {}, 4, 99)
    gram, at = lk._hits(lk._Segment.read(batch, 0, p.vocabulary), p)
    assert len(gram) == want and np.all(at >= 0)


def test_empty(spark):
    assert leaks(spark, [], [(1, "a b c d e f g h", "")]) == {} and leaks(spark, [(1, "a b", "", "")], []) == {}
