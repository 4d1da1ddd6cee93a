import json

from touchline.sources import readers, reports, writers
from touchline.sources.schemas import RECORD


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_hand_kept_files(spark, tmp_path):
    ranges = readers.id_ranges(spark, write(tmp_path / "r.txt", "# x\n10,12\n\nabc,1\n9,5\n20,20\n"))
    assert sorted(r["match_id"] for r in ranges.collect()) == ["10", "11", "12", "20"]
    ids, rules = readers.withdrawal_file(spark, write(tmp_path / "c.txt", "10058\nFK X,Liga 25/26,4\n# no\n"))
    assert [r[0] for r in ids.collect()] == ["10058"] and rules.first().asDict() == {"club": "FK X", "competition": "Liga 25/26", "from_round": 4}
    styles = readers.table_styles(spark, write(tmp_path / "s.txt", "[COMPETICION: A]\n1,#fff,up\n[COMPETICION: B]\n2,#000,down\n"))
    assert [(r["competition"], r["position"]) for r in styles.orderBy("position").collect()] == [("A", 1), ("B", 2)]
    table = readers.read_table(spark, "official_results", [str(tmp_path / "none.csv"), write(tmp_path / "o.csv", "id,a,b\n7,3,0\n")])
    assert table.first().asDict() == {"match_id": "7", "goals_home": 3, "goals_away": 0}
    assert readers.read_table(spark, "notes", [str(tmp_path / "none.csv")]).isEmpty()
    tsv = readers.read_table(spark, "competition_groups", [write(tmp_path / "g.tsv", "# c\nn\ts\tg\tt\nL\t25/26\tI\tA | B\n")], sep="\t", comment="#")
    assert readers.groups_table(tsv).first()["teams"] == ["A", "B"]


def test_records_and_masters(spark, tmp_path):
    row = {"match_id": "1", "competition": "L", "season": "25/26", "home": "A", "away": "B", "goals": [{"player": "x", "minute": 451}], "lineup_home": [{"name": " Ana  K ", "shirt": 1}], "ord": 1}
    path = write(tmp_path / "m.json", json.dumps(row) + "\n" + json.dumps({"match_id": "2", "ignored": True}))
    spark.read.schema(RECORD).json(path).write.parquet(str(tmp_path / "m"))
    rec = readers.records(spark, [str(tmp_path / "m")])
    flat = readers.masters(rec)
    assert rec.count() == 1 and flat["goals"].first()["minute"] == 451
    assert flat["appearances"].first()["name"] == "Ana K" and flat["appearances"].first()["team"] == "A" and flat["staff"].isEmpty()


PAGE = """<html><body><div class="team home">FK A</div><ul><li class="event goal"><span>9</span> Ana K <span>45+1</span></li>
<li class="event unknown">x</li><li class="event yellow">7 Eva 12'</li></ul></body></html>"""


def test_pages(spark):
    pages = spark.createDataFrame([("1", PAGE), ("2", "<p class='event goal'>9 X 3</p> match not played"), ("3", None)], "match_id string, html string")
    got = [tuple(r)[2:] for r in reports.report_events(pages).orderBy("n").collect()]
    assert got == [("goal", "Ana K", 9, 451), ("yellow", "Eva", 7, 12)]
    fields = {r["match_id"]: r["home"] for r in reports.page_fields(pages, {"home": "home"}).collect()}
    assert fields == {"1": "FK A", "2": None, "3": None}
    data = json.dumps({"success": True, "data": "<table><tr><td>Main referee</td><td>X <b>Y</b></td></tr></table>"})
    answers = spark.createDataFrame([("1", None, data, None), ("2", None, None, None), ("3", json.dumps({"success": True, "data": ""}), None, None)], "match_id string, finished string, played string, scheduled string")
    out = {r["match_id"]: r["officials"] for r in reports.officials_answers(answers).collect()}
    assert out["2"] is None and out["3"] == [] and out["1"][0]["name"] == "X Y"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("competition", "a"), ("team", "b"), ("team", "c")], "kind string, key string")
    got = writers.change_summary(df).first()
    assert got["changed"] is True and got["counts"] == {"competition": 1, "team": 2}
    writers.write_snapshot({"x": df}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3
    texts = spark.createDataFrame([("k", "en", "T"), ("k", "mk", "Т")], "key string, lang string, text string")
    assert "en" in writers.translations_json(texts).first()[0]
