"""Problem 2: only new or changed records, by a stored low watermark and a ledger of processed versions.

A run cannot start where the last one ended: a transaction that was open then may commit rows with an older time. So
every run leaves a *state* behind: per stage the time of the oldest transaction that was open when it ended (its low
watermark), and the records that it left unprocessed. The next run rereads the rows from the watermark on, which prunes
the scans of manifest and ledger, adds the records left over, and removes the overlap by an anti-join of (key, version)
pairs against the ledger of versions processed to the end. A crashed run writes no state, so that its successor starts
from the state before it; a finished version is never taken twice, whenever its row arrives.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAGES = ("extraction", "analysis")
DONE, SKIPPED, RUNNING = "complete", "skipped", "running"
_STATE = "document_id string, stage string, version string, updated_at timestamp_ntz, reason string"
#: Window keys up to this number (counted first) are broadcast to look up their earlier attempts.
BROADCAST_KEYS = 200_000


def clean_status(col: Column) -> Column:
    """Status without blanks and letter case."""
    return F.lower(F.trim(F.regexp_replace(col, r"[\s\u00a0]+", " ")))


def clean_hash(col: Column) -> Column:
    """Hash in lower case without blanks and algorithm prefix; null if nothing is left."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(col, r"[\s\u00a0]+", "")), r"^sha-?256[:=\-]?", "")
    return F.when(bare.rlike("^[0-9a-f]{8,}$"), bare)


def latest_rows(log: DataFrame, key: str = "document_id", order: str = "updated_at") -> DataFrame:
    """The row with the greatest ``order`` of each key.

    Repeated rows give one row; of different rows with the same time the one with the greatest content hash is taken;
    null times are oldest; rows with a null key are left out. An aggregate with map-side combine, so that a key with
    very many states never becomes one sorted group.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in log.columns])
    newest = log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(whole, F.struct(F.col(order), F.xxhash64(F.to_json(whole)))).alias("_row"))
    return newest.select("_row.*")


def _time(df: DataFrame, col: str, at: datetime) -> Column:
    """A time as a literal of the column's own type, so that comparing casts no column and reaches the scan."""
    return F.lit(at.isoformat(sep=" ")).cast(df.schema[col].dataType)


def _logged(ledger: DataFrame) -> DataFrame:
    """Readable ledger rows: (document_id, stage, version, status, recorded_at)."""
    clean = ledger.select("document_id", clean_status(F.col("stage")).alias("stage"), clean_hash(F.col("sha256")).alias("version"), clean_status(F.col("status")).alias("status"), "recorded_at")
    return clean.where("document_id is not null and stage is not null and version is not null")


def _due(manifest: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """Current rows of ``manifest`` a stage each: (document_id, stage, version, updated_at, due)."""
    now = latest_rows(manifest.select("document_id", "updated_at", "sha256", "stages"))
    claims = F.array(*[F.struct(F.lit(s).alias("stage"), clean_status(F.col(f"stages.{s}.status")).alias("claim")) for s in stages])
    flat = now.select("document_id", "updated_at", clean_hash(F.col("sha256")).alias("version"), F.explode(claims).alias("s"))
    return flat.select("document_id", "s.stage", "version", "updated_at", (F.col("version").isNotNull() & ~F.col("s.claim").eqNullSafe(SKIPPED)).alias("due"))


def _unprocessed(candidates: DataFrame, logged: DataFrame) -> DataFrame:
    """The anti-join of (key, version) pairs against the ledger, with the reason: retry, changed or new.

    ``candidates`` has a ``reason`` from an earlier state, or null; one shuffle of the ledger serves the look-up of the
    version, and its exchange that of the key.
    """
    tried = logged.groupBy("document_id", "stage", "version").agg(F.coalesce(F.max(F.col("status") == DONE), F.lit(False)).alias("done"))
    known = tried.groupBy("document_id", "stage").agg(F.lit(True).alias("known"))
    left = candidates.join(tried, ["document_id", "stage", "version"], "left").where("done is null or not done").join(known, ["document_id", "stage"], "left")
    reason = F.when(F.col("done").isNotNull() | F.col("reason").eqNullSafe("retry"), "retry").when(F.col("known").isNotNull() | F.col("reason").eqNullSafe("changed"), "changed").otherwise("new")
    return left.select("document_id", "stage", "version", "updated_at", reason.alias("reason"))


def low_watermarks(ledger: DataFrame, at: datetime, stages: tuple[str, ...] = STAGES, lease: str = "1 day") -> dict[str, datetime]:
    """Per stage the start of the oldest transaction open at the time ``at``, or ``at`` itself if none is.

    Open is an attempt ``running`` without a later row of its key and stage; one that is older than its ``lease`` has
    died, and its record counts as left over. The result has one entry a stage, which is all that reaches the driver.
    """
    now = _time(ledger, "recorded_at", at)
    last = _logged(ledger.where(F.col("recorded_at") <= now)).groupBy("document_id", "stage").agg(F.max_by("status", F.struct("recorded_at", F.col("status") != RUNNING)).alias("status"), F.max("recorded_at").alias("since"))
    alive = last.where((F.col("status") == RUNNING) & (F.col("since") >= now - F.expr(f"interval {lease}")))
    found = {r.stage: r.low for r in alive.groupBy("stage").agg(F.min("since").alias("low")).where(F.col("stage").isin(*stages)).collect()}
    return {s: min(found.get(s, at), at) for s in stages}


def incremental_delta(manifest: DataFrame, ledger: DataFrame, state: DataFrame | None = None, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """What a run has to take: (document_id, stage, version, updated_at, reason), reason being new, changed or retry.

    Of the current row of each document, each stage whose ``stages.<stage>.status`` is not ``skipped`` is taken if the
    present hash has no completed attempt in the ledger, whatever the status column claims. With the ``state`` that
    :func:`close_run` left, only manifest rows from its low watermarks on are read, and of the ledger only rows since
    then and those of the keys reread; without one, i.e. in a first run, everything is. A row that commits later with
    a time before the watermark breaks the transactions' promise and is not seen. Null hashes, null keys and unreadable
    ledger rows are left out; a null status does not skip; rows without a time are seen by the first run only. Empty
    tables give empty results, an empty ledger all files. Columns beside those named are ignored.
    """
    if state is None:
        return _unprocessed(_due(manifest, stages).where("due").withColumn("reason", F.lit(None).cast("string")), _logged(ledger))
    low = {r.stage: r.updated_at for r in state.where("document_id is null").select("stage", "updated_at").collect()}
    missing = [s for s in stages if s not in low]
    if missing:
        raise ValueError(f"the state has no watermark of {missing}")
    oldest = min(low[s] for s in stages)
    window = _due(manifest.where(F.col("updated_at") >= _time(manifest, "updated_at", oldest)), stages)
    # The manifest is read from the oldest watermark of all stages; a stage with a later one keeps its own window.
    late = F.coalesce(*[F.when(F.col("stage") == s, F.col("updated_at") < _time(manifest, "updated_at", low[s])) for s in stages])
    window = window.where(~late)
    waiting = state.where(F.col("document_id").isNotNull() & F.col("stage").isin(*stages))
    newer = window.select("document_id", "stage", F.col("updated_at").alias("_seen"))
    waiting = waiting.join(newer, ["document_id", "stage"], "left").where("_seen is null or _seen < updated_at").drop("_seen")
    settled = waiting.select("document_id", "stage", F.col("updated_at").alias("_kept"))
    fresh = window.join(settled, ["document_id", "stage"], "left").where("due and (_kept is null or _kept <= updated_at)")
    candidates = waiting.unionByName(fresh.select("document_id", "stage", "version", "updated_at", F.lit(None).cast("string").alias("reason")))
    keys = window.select("document_id").distinct()
    small = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    since = _time(ledger, "recorded_at", oldest)
    recent = F.col("recorded_at").isNull() | (F.col("recorded_at") >= since)
    earlier = ledger.where(F.col("recorded_at") < since).join(F.broadcast(keys) if small else keys, "document_id", "left_semi")
    return _unprocessed(candidates, _logged(ledger.where(recent).unionByName(earlier)))


def close_run(manifest: DataFrame, ledger: DataFrame, target: str, at: datetime, state: DataFrame | None = None, stages: tuple[str, ...] = STAGES, lease: str = "1 day") -> DataFrame:
    """Write the state at the time ``at`` to the folder ``target`` and return it: per stage a row with a null key whose
    ``updated_at`` is the low watermark, and a row for every record that is left unprocessed.

    From the ``state`` before, in the same way as the run itself, or from all rows if there is none. One write, which
    Spark commits at its end: a job that dies before leaves no state, and the next run starts from the one before.
    """
    spark = manifest.sparkSession
    seen = manifest.where(F.col("updated_at").isNull() | (F.col("updated_at") <= _time(manifest, "updated_at", at)))
    open_ = incremental_delta(seen, ledger.where(F.col("recorded_at").isNull() | (F.col("recorded_at") <= _time(ledger, "recorded_at", at))), state, stages)
    low = low_watermarks(ledger, at, stages, lease)
    marks = spark.createDataFrame([(None, s, None, low[s], None) for s in stages], _STATE)
    open_.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")).unionByName(marks).write.mode("errorifexists").parquet(target)
    return read_state(spark, target)


def read_state(spark, path: str) -> DataFrame:  # noqa: ANN001
    """The state that :func:`close_run` wrote."""
    return spark.read.schema(_STATE).parquet(path)


def last_logged(ledger: DataFrame) -> datetime | None:
    """When the ledger's last run recorded its last row; null if it has none."""
    return ledger.agg(F.max("recorded_at")).first()[0]


def record_run(delta: DataFrame, run_id: str, status: str, at: str) -> DataFrame:
    """Ledger rows for a run over ``delta``; written as ``running`` before and ``complete`` after the work, they make the
    run repeatable: an executor or driver lost between the two leaves open attempts that the next delta takes again."""
    when = F.lit(at).cast("timestamp_ntz")
    return delta.select(F.lit(run_id).alias("run_id"), "document_id", "stage", F.col("version").alias("sha256"), F.lit(status).alias("status"), F.when(F.lit(status) != "running", when).alias("finished_at"), when.alias("recorded_at"))
