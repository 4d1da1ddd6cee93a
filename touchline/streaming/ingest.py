"""Per-match polling state: what to fetch next, and how an outcome changes the state.

States: Scheduled, Live_Post, Archived. ``decide`` and ``advance`` are column expressions; the batch
functions and the stream use the same two, so their results agree. Late results are retried on
every run until complete; nothing is dropped, so there is no watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.incremental import upsert

COOL_DOWN_MINUTES = 120
STRIKES = 3
STATE = "match_id string, state string, kick_off timestamp, last_poll timestamp, attempts int, complete boolean, competition string, season string"
#: What an outcome may bring besides its kind; columns that are missing count as null.
BROUGHT = {"kick_off": "timestamp", "competition": "string", "season": "string"}


def decide(excluded: Column, cached: Column, state: Column, kick_off: Column, now: Column) -> Column:
    """'skip', 'announcement' or 'both'; ``state`` is null for untracked matches."""
    early = F.coalesce(now < kick_off + F.expr(f"INTERVAL {COOL_DOWN_MINUTES} MINUTES"), F.lit(False))
    return (
        F.when(excluded & cached, "skip")
        .when(excluded, "announcement")
        .when(cached & state.isNull(), "skip")
        .when(state == "Archived", "skip")
        .when((state == "Scheduled") & early, "skip")
        .otherwise("both")
    )


def advance(outcome: Column, attempts: Column) -> tuple[Column, Column, Column]:
    """(state, attempts, complete) after an outcome.

    'empty': no announcement, one more attempt, archived at the third. 'announced': Scheduled, the count
    starts again. 'withdrawn': Archived. 'report': Archived and complete. 'no_report': Live_Post. A poll
    asks for the announcement first, so the count has started again when the report adds its attempt.
    """
    tried = F.coalesce(attempts, F.lit(0))
    state = (
        F.when(outcome == "empty", F.when(tried + 1 >= STRIKES, "Archived").otherwise("Live_Post"))
        .when(outcome == "announced", "Scheduled")
        .when(outcome.isin("withdrawn", "report"), "Archived")
        .otherwise("Live_Post")
    )
    count = F.when(outcome == "empty", tried + 1).when(outcome.isin("announced", "withdrawn"), 0).otherwise(1)
    return state, count.cast("int"), outcome == "report"


def _brought(outcomes: DataFrame) -> list[Column]:
    return [(F.col(c) if c in outcomes.columns else F.lit(None).cast(kind)).alias(c) for c, kind in BROUGHT.items()]


def _folded(rows: Column, start: Column) -> Column:
    """State after an array of outcomes in order; those after a match is archived no longer count.

    An empty announcement also empties what was known of the match.
    """

    def step(acc: Column, row: Column) -> Column:
        state, attempts, complete = advance(row["outcome"], acc["attempts"])
        known = [F.when(row["outcome"] != "empty", F.coalesce(row[c], acc[c])).alias(c) for c in BROUGHT]
        after = F.struct(state.alias("state"), attempts.alias("attempts"), complete.alias("complete"), row["polled"].alias("last_poll"), *known)
        return F.when(acc["state"].eqNullSafe(F.lit("Archived")), acc).otherwise(after)

    return F.aggregate(rows, start, step)


def _gathered(outcomes: DataFrame) -> DataFrame:
    """(match_id, rows): the outcomes of a match in order of their polls."""
    rows = outcomes.select("match_id", F.struct("polled", "outcome", *_brought(outcomes)).alias("row"))
    return rows.groupBy("match_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))


def plan_polls(ids: DataFrame, tracking: DataFrame, excluded: DataFrame, cached: DataFrame, now: Column) -> DataFrame:
    """(match_id, action) for every id of the ranges."""
    rows = (
        ids.join(tracking.select("match_id", "state", "kick_off"), "match_id", "left")
        .join(excluded.select("match_id").distinct().withColumn("_x", F.lit(True)), "match_id", "left")
        .join(cached.select("match_id").distinct().withColumn("_c", F.lit(True)), "match_id", "left")
    )
    return rows.select("match_id", decide(F.coalesce("_x", F.lit(False)), F.coalesce("_c", F.lit(False)), F.col("state"), F.col("kick_off"), now).alias("action"))


def apply_outcomes(tracking: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Tracking after ``outcomes(match_id, outcome, polled, ...)``, any number per match; other rows stay.

    The outcomes of a match are folded in one pass over what is tracked of it.
    """
    fields = [F.col(c) for c in ("state", "attempts", "complete", "last_poll", *BROUGHT)]
    old = tracking.select("match_id", F.struct(*fields).alias("_old"))
    none = F.struct(*[F.lit(None).cast(tracking.schema[c].dataType).alias(c) for c in ("state", "attempts", "complete", "last_poll", *BROUGHT)])
    joined = _gathered(outcomes).join(old, "match_id", "left")
    changed = joined.select("match_id", _folded(F.col("rows"), F.coalesce("_old", none)).alias("s")).select("match_id", "s.*")
    return upsert(tracking, changed.select(*tracking.columns), "match_id")


def replay(outcomes: DataFrame) -> DataFrame:
    """(match_id, state, attempts, complete) of every match after all its outcomes, without earlier state."""
    kinds = {"state": "string", "attempts": "int", "complete": "boolean", "last_poll": outcomes.schema["polled"].dataType} | BROUGHT
    start = F.struct(*[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
    return _gathered(outcomes).select("match_id", _folded(F.col("rows"), start).alias("s")).select("match_id", "s.state", "s.attempts", "s.complete")


def migrate_legacy(tracking: DataFrame, cached: DataFrame) -> DataFrame:
    """Cached matches that are not tracked count as archived and complete."""
    missing = cached.select("match_id").distinct().join(tracking, "match_id", "left_anti")
    known = {"match_id": F.col("match_id"), "state": F.lit("Archived"), "attempts": F.lit(0), "complete": F.lit(True)}
    rows = missing.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in tracking.schema])
    return tracking.unionByName(rows)


def state_counts(tracking: DataFrame) -> DataFrame:
    return tracking.agg(*[F.count_if(F.col("state") == s).alias(s.lower()) for s in ("Scheduled", "Live_Post", "Archived")])


def stream_states(outcomes: DataFrame, path: str, checkpoint: str):
    """Start a stream of outcomes that keeps the tracking table at ``path``: one keyed merge per micro-batch.

    Each batch writes a version folder of its own from the latest one before it, and a batch that is run
    again starts from the same earlier version, so replays do not count an outcome twice. Readers take the
    version with the highest number that holds a success mark.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        done = [int(n.removeprefix("version=")) for n in names if n.startswith("version=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
        before = max((n for n in done if n < epoch), default=None)
        tracking = spark.createDataFrame([], STATE) if before is None else spark.read.schema(STATE).parquet(f"{path}/version={before}")
        apply_outcomes(tracking, batch).write.mode("overwrite").parquet(f"{path}/version={epoch}")

    return outcomes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
