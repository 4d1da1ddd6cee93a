import datetime as dt
import itertools

from pyspark.sql import functions as F

from touchline.streaming import ingest

T0 = dt.datetime(2025, 5, 1, 12)


def expected(excluded, cached, state, early):
    if excluded:
        return "skip" if cached else "announcement"
    if cached and state is None or state == "Archived" or state == "Scheduled" and early:
        return "skip"
    return "both"


def test_every_decision(spark):
    cases = list(itertools.product((False, True), (False, True), (None, "Scheduled", "Live_Post", "Archived"), (False, True)))
    rows = [(i, x, c, s, T0 + dt.timedelta(minutes=-119 if early else -120), T0) for i, (x, c, s, early) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, x boolean, c boolean, s string, k timestamp, n timestamp")
    got = [r[0] for r in df.orderBy("i").select(ingest.decide(F.col("x"), F.col("c"), F.col("s"), F.col("k"), F.col("n"))).collect()]
    assert got == [expected(*c) for c in cases]


OUTCOMES = [("a", ["empty"] * 3), ("b", ["empty", "empty", "announced", "empty"]), ("c", ["announced", "report", "empty"]), ("d", ["withdrawn"]), ("e", ["announced", "no_report", "no_report"])]
FINAL = {"a": ("Archived", 3, False), "b": ("Live_Post", 1, False), "c": ("Archived", 1, True), "d": ("Archived", 0, False), "e": ("Live_Post", 1, False)}


def outcome_rows(spark):
    rows = [(m, o, T0, T0 + dt.timedelta(hours=i)) for m, os in OUTCOMES for i, o in enumerate(os)]
    return spark.createDataFrame(rows, "match_id string, outcome string, kick_off timestamp, polled timestamp")


def test_replay(spark):
    got = {r["match_id"]: (r["state"], r["attempts"], r["complete"]) for r in ingest.replay(outcome_rows(spark)).collect()}
    assert got == FINAL


def test_stream_agrees_with_batch(spark, tmp_path):
    rows = outcome_rows(spark).orderBy("polled")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    ingest.stream_states(stream, str(tmp_path / "state"), str(tmp_path / "checkpoint")).awaitTermination()
    got = {r["match_id"]: (r["state"], r["attempts"], r["complete"]) for r in spark.read.parquet(str(tmp_path / "state/version=0")).collect()}
    assert got == FINAL


def test_legacy_rows(spark):
    tracking = spark.createDataFrame([("a", "Scheduled", T0, T0, 0, False, "L", "25/26")], ingest.STATE)
    out = ingest.migrate_legacy(tracking, spark.createDataFrame([("a",), ("b",)], "match_id string"))
    assert {r["match_id"]: r["state"] for r in out.collect()} == {"a": "Scheduled", "b": "Archived"}
    assert ingest.state_counts(out).first().asDict() == {"scheduled": 1, "live_post": 0, "archived": 1}


def test_outcomes_on_tracked_matches(spark):
    """Counts go on from what is tracked; an empty announcement empties the kick-off and the competition."""
    tracking = spark.createDataFrame([("a", "Live_Post", T0, T0, 2, False, "L", "25/26"), ("b", "Archived", T0, T0, 1, True, "L", "25/26"), ("c", "Scheduled", T0, T0, 0, False, "L", "25/26")], ingest.STATE)
    rows = [("a", "empty", None, T0, None), ("b", "empty", None, T0, None), ("c", "no_report", None, T0, None), ("d", "announced", T0, T0, "M"), ("d", "withdrawn", None, T0 + dt.timedelta(hours=1), None)]
    out = ingest.apply_outcomes(tracking, spark.createDataFrame(rows, "match_id string, outcome string, kick_off timestamp, polled timestamp, competition string"))
    got = {r["match_id"]: (r["state"], r["attempts"], r["complete"], r["kick_off"], r["competition"]) for r in out.collect()}
    assert got == {"a": ("Archived", 3, False, None, None), "b": ("Archived", 1, True, T0, "L"), "c": ("Live_Post", 1, False, T0, "L"), "d": ("Archived", 0, False, T0, "M")}
