"""Incremental state: keyed upserts, affected scope, exclusions, enrichment of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.tables import snapshot_diff


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``changes`` replace those of the same key."""
    return current.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def affected_matches(current: DataFrame, built: DataFrame, modified: DataFrame, official: DataFrame, official_before: DataFrame) -> DataFrame:
    """match_ids to rebuild: all current ones if any built one is gone, else the new ones; always the modified
    ones and those whose official result was added, changed or taken back. All arguments are unique on match_id."""
    now, then = current.select("match_id").filter("match_id is not null").distinct(), built.select("match_id").distinct()
    deleted = not then.join(now, "match_id", "left_anti").isEmpty()
    scope = now if deleted else now.join(then, "match_id", "left_anti")
    results = snapshot_diff(official, official_before, "match_id", ["goals_home", "goals_away"]).select("match_id")
    return scope.union(modified.select("match_id")).union(results).distinct()


def affected_scope(
    matches: DataFrame, affected: DataFrame, appearances: DataFrame, newly_cancelled: DataFrame,
    officials: DataFrame | None = None, stadiums: DataFrame | None = None, staff: DataFrame | None = None,
) -> DataFrame:
    """(kind, key): whose pages change: competitions, teams and players, and those of the tables given.

    Newly cancelled matches touch competitions. ``officials`` and ``staff`` (match_id, name), ``stadiums``
    (match_id, ground). Affected matches are marked once.
    """
    marked = affected.select("match_id", F.lit(True).alias("_hit")).union(newly_cancelled.select("match_id", F.lit(False)))
    touched = matches.join(marked.groupBy("match_id").agg(F.max("_hit").alias("_hit")), "match_id")
    competition = F.struct(F.lit("competition").alias("kind"), F.concat_ws("__", "competition", "season").alias("key"))
    sides = [F.when(F.col("_hit"), F.struct(F.lit("team").alias("kind"), F.col(c).alias("key"))) for c in ("home", "away")]
    rows = touched.select(F.explode(F.array_compact(F.array(competition, *sides))).alias("k")).select("k.kind", "k.key")
    people = {"player": (appearances, "player_id"), "referee": (officials, "name"), "stadium": (stadiums, "ground"), "staff": (staff, "name")}
    for kind, (table, column) in people.items():
        if table is not None:
            rows = rows.union(table.join(affected, "match_id", "left_semi").select(F.lit(kind), F.col(column)))
    return rows.filter("key is not null").distinct()


def to_backfill(cached: DataFrame, column: str = "officials") -> DataFrame:
    """match_ids of cached records that were never asked for a nested field (null; empty means asked, none)."""
    return cached.filter(F.col(column).isNull()).select("match_id")


def backfilled(cached: DataFrame, answers: DataFrame, column: str = "officials") -> DataFrame:
    """Cached records with the field of ``answers(match_id, column)`` where it was never asked for and is not empty now."""
    told = answers.filter(F.size(column) > 0).select("match_id", F.col(column).alias("_new"))
    return cached.join(told, "match_id", "left").withColumn(column, F.coalesce(column, "_new")).drop("_new")


def exclusion_changes(excluded: DataFrame, cached_excluded: DataFrame) -> DataFrame:
    """(match_id, change): 'exclude' what is newly excluded, 'restore' what no longer is."""
    add = excluded.select("match_id").distinct().join(cached_excluded, "match_id", "left_anti").withColumn("change", F.lit("exclude"))
    back = cached_excluded.select("match_id").distinct().join(excluded, "match_id", "left_anti").withColumn("change", F.lit("restore"))
    return add.union(back)


def enrich(report: DataFrame, announcement: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns of the announcement win over the report's where they are not empty."""
    other = announcement.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = report.join(other, key, "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.trim(f"_{c}"), F.lit("")), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def update_lineup(lineup: DataFrame, announced: DataFrame) -> DataFrame:
    """keeper and captain flags by (match_id, team, shirt), overridden where announced."""
    other = announced.select("match_id", "team", "shirt", F.col("keeper").alias("_k"), F.col("captain").alias("_c"))
    joined = lineup.join(other, ["match_id", "team", "shirt"], "left")
    return joined.withColumns({"keeper": F.coalesce("_k", "keeper"), "captain": F.coalesce("_c", "captain")}).drop("_k", "_c")
