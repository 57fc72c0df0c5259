from datetime import datetime

import pytest

from codexloom.operators import delta

STAGE = "struct<status:string,updated_at:timestamp_ntz,detail:string>"
MANIFEST = f"document_id string, sha256 string, updated_at timestamp_ntz, stages struct<ingestion:{STAGE},extraction:{STAGE},analysis:{STAGE}>, stage string, version string"
LEDGER = "ledger_id long, run_id string, document_id string, stage string, sha256 string, status string, finished_at timestamp_ntz, recorded_at timestamp_ntz, reason string"
H = {k: k * 64 for k in "abcd"}


def file(doc, sha, day, ext="pending", ana="pending"):
    at = datetime(2024, 1, day)
    return (doc, sha, at, ((None, at, None), (ext, at, None), (ana, at, None)), "clash", "clash")


def run(n, doc, stage, sha, status, day):
    return (n, f"run_{n}", doc, stage, sha, status, None, datetime(2024, 1, day), "clash")


def taken(spark, files, log):
    rows = delta.incremental_delta(spark.createDataFrame(files, MANIFEST), spark.createDataFrame(log, LEDGER)).collect()
    return {(r.document_id, r.stage): r.reason for r in rows}


def test_only_versions_never_completed_are_taken(spark):
    files = [file("d1", H["a"], 1), file("d1", H["b"], 5), file("d1", H["b"], 5), file("d2", "SHA256:" + H["c"].upper(), 2, ext=" Skipped "), file("d3", H["d"], 3, ext="complete")]
    log = [
        run(1, "d1", "extraction", H["a"], "complete", 2), run(2, "d1", "analysis", H["b"], " COMPLETE ", 6), run(3, "d1", "analysis", H["b"], "failed", 7),
        run(4, "d2", "analysis", "sha256:" + H["c"], "failed", 4), run(5, "d3", "analysis", H["d"], "running", 4), run(5, "d3", "analysis", H["d"], "running", 4),
    ]
    assert taken(spark, files, log) == {("d1", "extraction"): "changed", ("d2", "analysis"): "retry", ("d3", "extraction"): "new", ("d3", "analysis"): "retry"}


def test_nulls_everywhere(spark):
    files = [(None, H["a"], None, None, None, None), ("d1", None, datetime(2024, 1, 1), None, None, None), ("d2", H["a"], None, None, None, None), ("d3", "", datetime(2024, 1, 1), None, None, None)]
    log = [(None, None, None, None, None, None, None, None, None), (1, None, "d2", "extraction", H["a"], None, None, None, None)]
    assert taken(spark, files, log) == {("d2", "extraction"): "retry", ("d2", "analysis"): "new"}


def test_empty_tables(spark):
    assert taken(spark, [], []) == {}
    assert taken(spark, [file("d1", H["a"], 1)], []) == {("d1", "extraction"): "new", ("d1", "analysis"): "new"}
    assert taken(spark, [], [run(1, "d1", "analysis", H["a"], "complete", 1)]) == {}


def test_a_late_row_with_an_old_time_is_not_lost(spark):
    """A version that the ledger never saw is taken even if its time lies before the watermark."""
    log = [run(1, "d9", "extraction", H["a"], "failed", 20), run(2, "d1", "extraction", H["a"], "complete", 2)]
    assert taken(spark, [file("d1", H["b"], 1)], log)["d1", "extraction"] == "changed"


def test_a_run_that_completes_leaves_nothing(spark):
    files = [file(f"d{i}", H["a"], 1) for i in range(5)]
    first = delta.incremental_delta(spark.createDataFrame(files, MANIFEST), spark.createDataFrame([], LEDGER))
    for status, left in (("running", 10), ("failed", 10), ("complete", 0)):
        rows = delta.record_run(first, "r1", status, "2024-02-01 00:00:00")
        log = rows.selectExpr("0L as ledger_id", "run_id", "document_id", "stage", "sha256", "status", "finished_at", "recorded_at", "'' as reason")
        assert delta.incremental_delta(spark.createDataFrame(files, MANIFEST), log).count() == left


def test_ties_of_the_current_row_are_settled_alike(spark):
    files = [file("d1", H["a"], 1), file("d1", H["b"], 1)]
    a = delta.latest_rows(spark.createDataFrame(files, MANIFEST)).first().sha256
    b = delta.latest_rows(spark.createDataFrame(files[::-1], MANIFEST).repartition(3)).first().sha256
    assert a == b


@pytest.mark.parametrize("value,clean", [("SHA256:" + H["a"].upper(), H["a"]), (" " + H["b"] + " ", H["b"]), ("n/a", None), (None, None), ("", None)])
def test_hashes(spark, value, clean):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(value,)], "x string").select(delta.clean_hash(F.col("x"))).first()[0] == clean


def at(day):
    return datetime(2024, 1, day)


def frames(spark, files, log):
    return spark.createDataFrame(files, MANIFEST), spark.createDataFrame(log, LEDGER)


def after(spark, tmp_path, before, now, day, log_before=(), log_now=()):
    """{(document, stage): reason} of the run that starts from the state closed on ``day``."""
    state = delta.close_run(*frames(spark, before, list(log_before)), str(tmp_path / "state"), at(day))
    rows = delta.incremental_delta(*frames(spark, now, list(log_now)), state).collect()
    assert len(rows) == len({(r.document_id, r.stage) for r in rows})
    return {(r.document_id, r.stage): r.reason for r in rows}


def test_rows_before_the_watermark_are_not_read(spark, tmp_path):
    """Fails if the watermark's filter is taken out: no transaction was open, so d8 breaks its promise."""
    before = [file("d1", H["a"], 2)]
    assert after(spark, tmp_path, before, [*before, file("d8", H["b"], 4), file("d9", H["c"], 12)], 10) == {("d1", "extraction"): "new", ("d1", "analysis"): "new", ("d9", "extraction"): "new", ("d9", "analysis"): "new"}


def test_a_transaction_open_at_the_last_run_may_commit_late(spark, tmp_path):
    before, log = [file("d1", H["a"], 2)], [run(1, "d1", "extraction", H["a"], "running", 9), run(2, "d1", "analysis", H["a"], "complete", 9)]
    state = delta.close_run(*frames(spark, before, log), str(tmp_path / "s"), datetime(2024, 1, 9, 12))
    assert {r.stage: r.updated_at for r in state.where("document_id is null").collect()} == {"extraction": at(9), "analysis": datetime(2024, 1, 9, 12)}
    late = file("d2", H["b"], 9)
    rows = delta.incremental_delta(*frames(spark, [*before, late], [*log, run(3, "d1", "extraction", H["a"], "complete", 10)]), state).collect()
    assert {(r.document_id, r.stage) for r in rows} == {("d2", "extraction")}


def test_left_over_records_are_taken_until_completed_superseded_or_skipped(spark, tmp_path):
    before = [file(f"d{i}", H["a"], 2) for i in range(5)]
    now = [*before, file("d1", H["b"], 12), file("d2", H["a"], 12, ext="skipped"), file("d3", None, 12)]
    log = [run(1, "d0", "extraction", H["a"], "complete", 12), run(2, "d1", "analysis", H["a"], "failed", 12), run(3, "d4", "analysis", H["a"], "failed", 12)]
    assert after(spark, tmp_path, before, now, 10, (), log) == {("d0", "analysis"): "new", ("d1", "extraction"): "new", ("d1", "analysis"): "changed", ("d2", "analysis"): "new", ("d4", "extraction"): "new", ("d4", "analysis"): "retry"}


def test_a_touched_row_is_not_repeated(spark, tmp_path):
    """A row written again after the watermark whose version was completed long before it."""
    before, log = [file("d1", H["a"], 2)], [run(1, "d1", s, H["a"], "complete", 3) for s in delta.STAGES]
    assert after(spark, tmp_path, before, [*before, file("d1", H["a"], 12)], 10, log, log) == {}


def test_a_chain_of_runs_equals_one_full_read(spark, tmp_path):
    files = [file(f"d{i % 7}", H["abcd"[(i * i) % 4]], 1 + i) for i in range(20)]
    log = [run(i, f"d{i % 5}", delta.STAGES[i % 2], H["abcd"[i % 4]], ("complete", "failed", "running")[i % 3], 2 + i) for i in range(24)]
    state = None
    for n, day in enumerate((5, 11, 12, 19)):
        state = delta.close_run(*frames(spark, files, log), str(tmp_path / f"run{n}"), at(day), state)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(delta.incremental_delta(*frames(spark, files, log), state)) == key(delta.incremental_delta(*frames(spark, files, log)))


def test_states_of_empty_tables_and_of_other_stages(spark, tmp_path):
    state = delta.close_run(*frames(spark, [], []), str(tmp_path / "s"), at(10))
    assert delta.incremental_delta(*frames(spark, [], []), state).count() == 0
    assert delta.last_logged(spark.createDataFrame([], LEDGER)) is None
    with pytest.raises(ValueError):
        delta.incremental_delta(*frames(spark, [], []), state, ("ingestion",))
