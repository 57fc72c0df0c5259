import os
import random

import numpy as np
import pytest

from codexloom.llm import packing as pk

needs_files = pytest.mark.skipif(not os.path.exists(f"{pk.TOKENIZERS}/byte_bpe_50k.tiktoken"), reason="no vocabulary files")


@pytest.mark.parametrize("seed", range(4))
def test_limits_hold_and_little_is_wasted(seed):
    rng = np.random.default_rng(seed)
    demand = np.stack([rng.integers(1, 1000, 500), np.ones(500, dtype=int), rng.integers(0, 500, 500)], axis=1)
    capacity = np.array([2048, 20, 1200])
    box = pk.pack(demand, capacity)
    used = np.zeros((box.max() + 1, 3))
    np.add.at(used, box, demand)
    assert (box >= 0).all() and (used <= capacity).all()
    bound = int(np.ceil((demand.sum(axis=0) / capacity).max()))
    assert box.max() + 1 <= 1.15 * bound + 1


def test_extremes():
    cap = np.array([10, 2, 10])
    assert pk.pack(np.zeros((0, 3), dtype=int), cap).tolist() == []
    assert sorted(pk.pack(np.array([[11, 1, 1], [10, 1, 10], [5, 1, 5], [5, 1, 5]]), cap).tolist()).count(2) <= 2
    assert len(set(pk.pack(np.array([[1, 1, 1]] * 5), cap).tolist())) == 3  # two segments a container


def test_pieces(spark):
    rows = spark.createDataFrame([(1, 2048), (2, 2049), (3, 0), (4, 5000)], "doc_id long, n_tokens long")
    got = sorted((r.doc_id, r.piece, r.start_token, r.tokens) for r in pk.pieces(rows, 2048).collect())
    assert got == [(1, 0, 0, 2048), (2, 0, 0, 2048), (2, 1, 2048, 1), (4, 0, 0, 2048), (4, 1, 2048, 2048), (4, 2, 4096, 904)]


def test_groups_and_refilling(spark):
    rng = random.Random(3)
    items = spark.createDataFrame([(i, 0, 0, rng.randrange(1, 900), 1, 0) for i in range(900)], "doc_id long, piece long, start_token long, tokens long, segments long, loss long")
    out = pk.fill_containers(items, pk.Limits(2048, 64, 2048), group_items=60)
    assert out.count() == 900 and out.select("doc_id").distinct().count() == 900
    usage = pk.container_usage(out, pk.Limits(2048, 64, 2048)).first()
    assert usage.n_over == 0 and usage.used > 0.97
    assert pk.fill_containers(items.where("false")).count() == 0


ITEM = "doc_id long, piece long, start_token long, tokens long, segments long, loss long"


def test_groups_stay_bounded_where_no_two_items_fit(spark, monkeypatch):
    """Items of more than half of the capacity: nothing can be refilled, and no level may gather them in one task."""
    levels = []
    plain = pk._pack_groups
    monkeypatch.setattr(pk, "_pack_groups", lambda items, groups, limits, level: levels.append((items.count(), groups)) or plain(items, groups, limits, level))
    items = spark.createDataFrame([(i, 0, 0, 1100, 1, 0) for i in range(2000)], ITEM)
    out = pk.fill_containers(items, group_items=100)
    assert out.select("container").distinct().count() == 2000 and len(levels) == 1
    assert all(n / groups <= 100 for n, groups in levels)
    assert out.groupBy(pk.F.split("container", "-")[1]).count().agg({"count": "max"}).first()[0] < 160


def test_each_limit_binds(spark):
    rng = random.Random(5)
    items = spark.createDataFrame([(i, 0, 0, t := rng.randrange(50, 700), 1, t // rng.choice([1, 1, 1, 4])) for i in range(600)], ITEM)
    limits = pk.Limits(2048, 6, 1500)
    usage = pk.container_usage(pk.fill_containers(items, limits, group_items=150), limits).first()
    assert usage.n_over == 0 and usage.n_items == 600
    assert usage.full_tokens > 0 and usage.full_segments > 0 and usage.full_loss > 0


@needs_files
def test_prompts_bear_no_loss_and_nothing_is_faulty(spark):
    docs = spark.createDataFrame([(1, "What is it?\nA long answer of several words."), (2, "one line only"), (3, "words " * 2500 + "\nrest"), (4, None), (5, "")], "doc_id long, text string")
    out = pk.packed_documents(docs)
    rows = {(r.doc_id, r.piece): r for r in out.collect()}
    assert rows[1, 0].loss == rows[1, 0].tokens - 4 and rows[2, 0].loss == rows[2, 0].tokens and rows[3, 0].loss == 0
    assert tuple(pk.packing_faults(docs, out).first()) == (3, 0, 0, 0, 0)


@needs_files
def test_documents(spark):
    rows = [(1, "plain words " * 3000, "clash"), (2, "short <|endoftext|> text", "clash"), (3, None, ""), (4, "", ""), (None, "x", ""), (5, " ", ""), (5, "longer text", ""), (6, "0" * 5000, "")]
    out = pk.packed_documents(spark.createDataFrame(rows, "doc_id long, text string, tokens string")).collect()
    assert {r.doc_id for r in out} == {1, 2, 5, 6} and max(r.tokens for r in out) <= 2048
    whole = sum(r.tokens for r in out if r.doc_id == 1)
    assert whole == len(pk.encoder(f"{pk.TOKENIZERS}/byte_bpe_50k.tiktoken").encode_ordinary("plain words " * 3000))
    assert pk.packed_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
