"""Readers and writers."""

import json

import pytest
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.operators import catalog as c
from canvass.sources import editions, forms, submissions, tables


def form_json():
    survey = [
        {"name": "start", "type": "start", "$kuid": "a", "$xpath": "start"},
        {"name": "q1", "type": "select_one", "$kuid": "b", "$xpath": "g/q1", "label": ["Erste Frage?"],
         "select_from_list_name": "yn", "relevant": "selected(${q}, 'x')", "unknown": {"deep": 1}},
        {"name": "m", "type": "begin_kobomatrix", "$kuid": "c", "$xpath": "g/m", "label": ["M"], "kobo--matrix_list": "ml"},
    ]
    choices = [{"name": "ja", "$kuid": "d", "label": ["Ja"], "list_name": "yn"}, {"name": "nein", "list_name": "yn", "label": None}]
    return {"uid": "x", "content": {"survey": survey, "choices": choices}}


def test_form_definition(spark, tmp_path):
    path = tmp_path / "form.json"
    path.write_text(json.dumps(form_json(), indent=1))
    questions, choices = forms.read_form(spark, str(path))
    q = questions.orderBy("ord").collect()
    assert [(r["ord"], r["name"], r["col_name"], r["label"], r["list_name"], r["matrix_list"]) for r in q] == [
        (0, "start", "start", None, None, None), (1, "q1", "g/q1", "Erste Frage?", "yn", None), (2, "m", "g/m", "M", None, "ml"),
    ]
    assert [(r["ord"], r["name"], r["label"]) for r in choices.orderBy("ord").collect()] == [(0, "ja", "Ja"), (1, "nein", None)]

    forms.write_form_csv(questions, str(tmp_path / "csv"))
    back = forms.read_form_csv(spark, str(tmp_path / "csv")).orderBy("ord").collect()
    assert [(r["ord"], r["label"], r["relevant"]) for r in back] == [(r["ord"], r["label"], r["relevant"]) for r in q]

    objects = [json.loads(r["question"]) for r in forms.question_json(questions).orderBy("ord").collect()]
    assert objects[0]["label"] is None and objects[1]["col_name"] == "g/q1" and "ord" not in objects[0]
    forms.write_form_json(questions, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 3


def test_metadata_csv_without_order_column(spark, tmp_path):
    path = tmp_path / "survey.csv"
    lines = "".join(f'q{i},text,k{i},g/q{i},"Frage\n""{i}""",l{i},NA\n' for i in range(50))
    path.write_text("name,type,$kuid,col_name,label,select_from_list_name,relevant\n" + lines)
    got = forms.read_form_csv(spark, str(path)).orderBy("ord").collect()
    assert [r["name"] for r in got] == [f"q{i}" for i in range(50)]
    assert (got[3]["kuid"], got[3]["label"], got[3]["list_name"], got[3]["relevant"]) == ("k3", 'Frage\n"3"', "l3", None)


def test_two_labels_are_an_error(spark, tmp_path):
    bad = form_json()
    bad["content"]["survey"][1]["label"] = ["a", "b"]
    path = tmp_path / "bad.json"
    path.write_text(json.dumps(bad))
    with pytest.raises(Exception, match="more than one label"):
        forms.read_form(spark, str(path))[0].collect()


def test_battery_and_statements(spark):
    cat = local_table(
        spark, [("s", 2, "b", "l1"), ("s", 1, "z", "l2"), ("t", 3, "c", "l3")], "q_key string, ord int, name string, list_name string"
    )
    choices = local_table(spark, [("1", "l1"), ("2", "l2"), ("3", "l3")], "name string, list_name string")
    items, used = forms.battery(cat, choices, "s")
    assert items.count() == 2 and {r["list_name"] for r in used.collect()} == {"l1", "l2"}
    items, used = forms.statements(cat, choices, "s")
    assert [r["name"] for r in items.collect()] == ["b", "z"] and [r["list_name"] for r in used.collect()] == ["l2"]


def test_lookup_csv_reads_na_and_empty_as_missing(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text('Schreibweise in den Daten,Vereinheitlicht,Kommentar,Landesverband\n,NA,x,NA\n"a ""b"", c",A,,Nord\n')
    got = tables.read_spelling(spark, str(path)).collect()
    assert {tuple(r) for r in got} == {(None, None, None), ('a "b", c', "A", "Nord")}
    path.write_text("og_region,region_grouped,slug\nNord,Nord,nord\nNord,X,x\n")
    with pytest.raises(ValueError):
        tables.read_regions(spark, str(path))


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_submissions(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    raw = spark.sql("SELECT 7L AS _id, timestamp'2024-11-05 10:00:00' AS `end`, 'x y' AS `g/a`, 'drop' AS other")
    writer = raw.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    df = submissions.read_submissions(spark, path, 2024, ["g/a", "g/never"], fmt)
    r = df.collect()[0]
    assert (r["_id"], r["g/a"], r["year"], r["end"].year) == (7, "x y", 2024, 2024)
    assert r["g/never"] is None


def test_raw_export_has_no_system_columns(spark, tmp_path):
    df = local_table(spark, [(1, "u", "e", None)], "_id int, _uuid string, `meta/x` string, `g/a` string")
    submissions.write_raw_export(df, str(tmp_path / "raw"), "og_id")
    assert tables.read_table(spark, str(tmp_path / "raw")).columns == ["og_id", "g/a"]


def test_editions(spark, tmp_path):
    root = str(tmp_path)
    df = local_table(spark, [(2023, 1), (2024, 2), (2024, 3)], "year int, x int")
    editions.write_edition({"t": df}, root)
    editions.write_table(local_table(spark, [(2024, 9)], "year int, x int"), root, "t")
    stored = editions.load_all(spark, root, ["t"])["t"]
    assert sorted((r["year"], r["x"]) for r in stored.collect()) == [(2023, 1), (2024, 9)]
    one = editions.load_edition(spark, root, ["t"], 2023)["t"]
    assert [r["x"] for r in one.collect()] == [1]
    assert "PartitionFilters: [isnotnull(year" in plan(spark, one) or "PartitionFilters: [(year" in plan(spark, one)
    assert editions.edition_years(stored) == [2023, 2024]


def plan(spark, df):
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_current_and_previous():
    assert editions.current_and_previous([2023, 2024]) == (2024, 2023)
    assert editions.current_and_previous([2022, 2024]) == (2024, None)
    assert editions.current_and_previous([2022, 2023, 2024], "2023") == (2023, 2022)
    for wanted, text in (("2020", "not available"), ("abc", "not a valid year")):
        with pytest.raises(ValueError, match=text):
            editions.current_and_previous([2023], wanted)
    with pytest.raises(ValueError, match="no editions"):
        editions.current_and_previous([])


def test_bucketed_tables_join_without_shuffle(spark):
    n = spark.range(1000).withColumnRenamed("id", "tn_id").withColumn("year", F.lit(2024))
    editions.save_bucketed(n, "bucket_person", ["tn_id"], 4)
    editions.save_bucketed(n.withColumn("o", F.lit("x")), "bucket_long", ["tn_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        joined = spark.table("bucket_long").join(spark.table("bucket_person"), ["year", "tn_id"])
        assert joined.count() == 1000
        assert "Exchange hashpartitioning" not in plan(spark, joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.sql("DROP TABLE bucket_long")
        spark.sql("DROP TABLE bucket_person")


def test_find_questions_in_read_form(spark, tmp_path):
    path = tmp_path / "form.json"
    path.write_text(json.dumps(form_json()))
    questions, _ = forms.read_form(spark, str(path))
    specs = [c.Question("erste", "label", "Erste"), c.Question("matrix", "type", "begin_kobomatrix", contains=("label", "M"))]
    cat = c.load_catalog(questions.withColumn("autoname", F.col("name")), specs)
    assert cat.column("erste") == "g/q1" and cat.one("matrix")["matrix_list"] == "ml"
    assert cat.answer_columns() == ["g/q1"]


def test_submissions_by_name(spark, tmp_path):
    """Files that differ in columns, their order and types."""
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text('_id,end,q1,q2\n1,2024-05-01 10:00:00,a,NA\n2,2024-05-01 10:00:00,"x ""y""",b\n')
    (tmp_path / "csv" / "b.csv").write_text("q2,q1,_id,blockx_1,extra\nb2,a2,3,7,e\n")
    got = submissions.read_submissions(spark, str(tmp_path / "csv"), 2024, ["q1", "q2", "q3"], "csv", blocks=["blockx"])
    assert got.columns == ["_id", "end", "q1", "q2", "q3", "blockx_1", "year"]
    assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got.collect()) == [
        (1, "a", None, None, None, 2024), (2, 'x "y"', "b", None, None, 2024), (3, "a2", "b2", None, "7", 2024),
    ]
    spark.createDataFrame([(4, 5, "z")], "_id long, q1 int, q2 string").write.parquet(str(tmp_path / "pq"))
    got = submissions.read_submissions(spark, str(tmp_path / "pq"), 2024, ["q1", "q2", "q3"], "parquet")
    assert [(r["_id"], r["q1"], r["q2"], r["q3"]) for r in got.collect()] == [(4, "5", "z", None)]


def test_broken_json_line_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_id": 1, "q1": "a"}\n{"_id": 2, "q1"\n')
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        submissions.read_submissions(spark, str(tmp_path), 2024, ["q1"]).collect()


def test_line_breaks_and_splits(spark, tmp_path):
    (tmp_path / "m.csv").write_text('_id,q1\n1,"two\nlines"\n')
    got = submissions.read_submissions(spark, str(tmp_path / "m.csv"), 2024, ["q1"], "csv", multi_line=True)
    assert [r["q1"] for r in got.collect()] == ["two\nlines"]
    (tmp_path / "big.csv").write_text("_id,q1\n" + "".join(f"{i},{'x' * 90}\n" for i in range(60000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert submissions.read_submissions(spark, str(tmp_path / "big.csv"), 2024, ["q1"], "csv").rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
