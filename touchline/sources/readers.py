"""Typed readers of reference files and match records.

A file that cannot be found gives an empty table of its schema, as the pipeline does without it.
Paths go through Spark's file systems only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.text import note_lines, squish
from touchline.sources.schemas import RECORD, TABLES


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """The first path that exists, as Spark's file system sees it."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(conf).exists(path):
            return p
    return None


def read_table(spark: SparkSession, name: str, paths: list[str], header: bool = True, sep: str = ",", comment: str | None = None) -> DataFrame:
    """A reference table from the first of ``paths`` that exists; columns by position, as in TABLES."""
    schema = TABLES[name]
    found = first_existing(spark, paths)
    if found is None:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("header", header).option("sep", sep).option("encoding", "UTF-8").option("multiLine", True).option("escape", '"').option("enforceSchema", True)
    if comment:
        reader = reader.option("comment", comment)
    try:
        return reader.option("mode", "PERMISSIVE").csv(found)
    except AnalysisException:  # not a table of text at all
        return spark.createDataFrame([], schema)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(n, line) of a hand-kept text file, in file order."""
    whole = spark.read.option("wholetext", True).text(path)
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))


def id_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(label, match_id): every id of 'from,to' lines; blank, comment, non-numeric and reversed lines are skipped."""
    parts = F.split("line", r"\s*[,;]\s*")
    rows = lines(spark, path).filter(~F.trim("line").rlike("^(#|$)")).select(
        F.trim("line").alias("label"), F.trim(parts[0]).try_cast("long").alias("low"), F.trim(F.get(parts, F.lit(1))).try_cast("long").alias("high")
    )
    return rows.filter("low <= high").select("label", F.explode(F.sequence("low", "high")).alias("match_id")).withColumn("match_id", F.col("match_id").cast("string"))


def withdrawal_file(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(cancelled ids, rules): one field is an id, three or more are club, competition, first round."""
    parts = F.split(F.regexp_replace("line", '"', ""), r"\s*,\s*")
    rows = lines(spark, path).filter(~F.trim("line").rlike("^(#|$)")).select(parts.alias("f"))
    ids = rows.filter(F.size("f") == 1).select(F.trim(F.col("f")[0]).alias("match_id"))
    rules = rows.filter(F.size("f") >= 3).select(F.trim(F.col("f")[0]).alias("club"), F.trim(F.col("f")[1]).alias("competition"), F.get("f", F.lit(2)).try_cast("int").alias("from_round"))
    return ids, rules.filter("from_round is not null")


def table_styles(spark: SparkSession, path: str) -> DataFrame:
    """(competition, position, color, legend) of a sectioned file; a section's name is carried to its lines."""
    w = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)  # a hand-kept file of a few dozen lines
    name = F.nullif(F.regexp_extract("line", r"^\s*\[COMPETICION:\s*(.*?)\s*\]", 1), F.lit(""))
    rows = lines(spark, path).withColumn("competition", F.last(name, ignorenulls=True).over(w)).filter(~F.trim("line").rlike(r"^(#|\[|$)"))
    parts = F.split("line", r"\s*,\s*")
    return rows.select("competition", F.trim(parts[0]).try_cast("int").alias("position"), F.get(parts, F.lit(1)).alias("color"), F.get(parts, F.lit(2)).alias("legend")).filter("position is not null")


def style_legend(styles: DataFrame) -> DataFrame:
    """(competition, color, legend) of a table's styles, each once, in order of their first position."""
    once = styles.groupBy("competition", "color", "legend").agg(F.min("position").alias("position"))
    return once.filter("legend is not null and legend <> ''").select("competition", "color", "legend", "position")


def search_data(spark: SparkSession, path: str) -> DataFrame:
    """The search index as its writer left it (a JSON array of objects); an absent file gives no rows."""
    schema = "name string, type string, target_id string, terms string"
    if first_existing(spark, [path]) is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def groups_table(groups: DataFrame) -> DataFrame:
    """Competition groups with their teams as an array."""
    return groups.withColumn("teams", F.transform(F.split("teams", r"\|"), lambda t: F.trim(t))).withColumnRenamed("name", "competition")


def long_texts(texts: DataFrame) -> DataFrame:
    """(key, lang, text) of a wide dictionary."""
    return texts.unpivot(["key"], [c for c in texts.columns if c != "key"], "lang", "text").filter("text is not null")


def notes(rows: DataFrame) -> DataFrame:
    return rows.select("match_id", note_lines(F.col("note")).alias("note"))


def calendars(spark: SparkSession, glob: str) -> DataFrame:
    """Fixtures of calendar exports named 'Competition YY_YY.csv' (round, day, time, 'Home - Away')."""
    rows = spark.read.schema("round string, day string, time string, fixture string").option("header", True).csv(glob).withColumn("_file", F.col("_metadata.file_name"))
    name = F.url_decode("_file")
    sides = F.split("fixture", r"\s+-\s+", 2)
    return rows.select(
        F.trim(F.regexp_extract(name, r"^(.*?)\s+\d{2}_\d{2}\.", 1)).alias("competition"),
        F.replace(F.regexp_extract(name, r"(\d{2}_\d{2})\.", 1), F.lit("_"), F.lit("/")).alias("season"),
        "round", "day", "time", F.trim(sides[0]).alias("home"), F.trim(F.get(sides, F.lit(1))).alias("away"),
    )


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Match records of all sources, without the ignored ones; missing columns are null."""
    frames = [spark.read.schema(RECORD).parquet(p) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.filter(~F.col("ignored").eqNullSafe(True))


def masters(rec: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of nested records: matches, goals, cards, appearances, substitutions, officials, staff, kicks."""
    key = ["match_id", "competition", "season"]

    def flat(column: str, *extra: str) -> DataFrame:
        return rec.select(*key, *extra, F.posexplode(column).alias("_i", "x")).select(*key, *extra, "_i", "x.*")

    def by_side(column: str) -> DataFrame:
        return flat(f"{column}_home", "home").withColumnRenamed("home", "team").unionByName(flat(f"{column}_away", "away").withColumnRenamed("away", "team"))

    return {
        "matches": rec.drop("goals", "cards", "lineup_home", "lineup_away", "changes_home", "changes_away", "kicks", "officials", "staff_home", "staff_away"),
        "goals": flat("goals").withColumnRenamed("player", "name"),
        "cards": flat("cards").withColumnRenamed("player", "name"),
        "appearances": by_side("lineup").withColumn("name", squish(F.col("name"))),
        "substitutions": by_side("changes").withColumnRenamed("_i", "ord"),
        "officials": flat("officials"),
        "staff": by_side("staff"),
        "kicks": flat("kicks"),
    }
