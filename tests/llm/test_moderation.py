import random

import numpy as np
import pytest

from codexloom.llm import moderation as mo

CLEAN = ("The sensor of {n} follows the river at {k} metres.", "Please report the archive with and without filtering.", "We measured {k} boats near the harbour of {n}.", "The job was killed after the parent process died.", "Overall a solid study of {n} and its maps.", "The table lists {k} values for each season.")
BAD = {"abusive": ("You are a {x} and everyone here knows it.", "Shut up, you {x}, and get lost.", "Only a {x} would write such rubbish."), "hateful": ("People from {n} are vermin and should be driven out.", "Never hire anyone from {n}, they are filthy by birth."), "sexual": ("She moaned as he undressed her on the bench.", "Send naked pictures, I want to kiss you all over.")}
INSULTS = ("moron", "stupid cow", "worthless fool", "filthy liar", "brainless clown")
NAMES = ("Aliko", "Brevan", "Codrik", "Delmo", "Estavo", "Fenwig")


def fill(rng, s, insults=INSULTS):
    return s.format(n=rng.choice(NAMES), k=rng.randrange(2, 900), x=rng.choice(insults))


def make(seed, n, insults=INSULTS):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        body = [fill(rng, rng.choice(CLEAN)) for _ in range(rng.randrange(2, 8))]
        label = rng.choice(["clean", "clean", "clean", "abusive", "hateful", "sexual"])
        if label != "clean":
            body.insert(rng.randrange(len(body)), fill(rng, rng.choice(BAD[label]), insults))
        out.append((i, " ".join(body), label))
    return out


@pytest.fixture(scope="module")
def model():
    return mo.train([(t, label) for _, t, label in make(1, 300)])


def accuracy(spark, model, rows):
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t, _ in rows], "doc_id long, text string, label string, score string")
    got = {r.doc_id: r.label for r in mo.score_documents(df, model).collect()}
    return np.mean([got[i] == label for i, _, label in rows])


def test_held_out_accuracy(spark, model):
    assert accuracy(spark, model, make(2, 200)) >= 0.97


def test_unseen_misspellings(spark, model):
    assert accuracy(spark, model, make(3, 200, ("m0r0n", "moooron", "w0rthless f00l", "f.o.o.l", "bra!nless cl0wn"))) >= 0.95


def test_table_equals_the_model(spark, model):
    rows = make(4, 30)
    df = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r.doc_id: (r.score, r.n_sentences) for r in mo.score_documents(df, model).collect()}
    for i, t, _ in rows:
        s = mo.split_sentences(t)
        assert got[i][1] == len(s) and abs(got[i][0] - (1 - model.probabilities(s)[:, 0]).max()) < 1e-4


def test_defined_results_of_odd_rows(spark, model):
    rows = [(1, None, "a"), (2, "", None), (3, "  \n ", "a"), (None, "x", "a"), (4, "Please report the archive with and without filtering. " * 20_000, "a"), (5, "... !!! ???", None), (5, "... !!! ???", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mo.score_documents(df, model)
    assert sorted((r.doc_id, r.label) for r in got.collect()) == [(1, "clean"), (2, "clean"), (3, "clean"), (4, "clean"), (5, "clean"), (5, "clean")]
    rates = {r.source: (r.n_documents, r.rate) for r in mo.source_rates(df.dropDuplicates(), got.dropDuplicates()).collect()}
    assert rates == {"a": (3, 0.0), None: (2, 0.0)}
    assert mo.score_documents(df.where("false"), model).count() == 0


def test_without_labels_everything_is_clean(spark):
    assert accuracy(spark, mo.train([]), [(1, "You are a moron and everyone here knows it.", "clean")]) == 1.0


def test_labels_latest_review_counts_and_the_bound_holds(spark):
    from datetime import datetime

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, "clean", "a", datetime(2024, 1, 1)), (1, " Abusive ", "b", datetime(2024, 1, 2)), (2, None, "a", None), (None, "clean", "a", None), (3, "clean", None, None), (9, "clean", "a", None)], "doc_id long, label string, reviewer string, labelled_at timestamp")
    assert mo.labelled_texts(docs, labels) == [("text 1", "abusive"), ("text 3", "clean")]
    assert len(mo.labelled_texts(docs, labels, most=1)) <= 1
