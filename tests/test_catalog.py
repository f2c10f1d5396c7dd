"""Form metadata: searching, guards, matrices, choices."""

import pytest
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.operators import catalog as c
from workload import forms as f
from workload import operators


@pytest.fixture(scope="module")
def group_meta(spark):
    return f.metadata(spark, "og")


def test_find_questions(group_meta):
    assert c.find_questions(group_meta, "name", ".+?_[sS]tunden").count() == 3
    assert c.find_question(group_meta, "label", "hauptberuflich").collect()[0]["list_name"] == "staff"
    with pytest.raises(c.QuestionError):
        c.find_questions(group_meta, "name", "nothing here")
    with pytest.raises(c.QuestionError):
        c.find_questions(group_meta, "name", "Wochentag", "text")
    with pytest.raises(c.QuestionError):
        c.find_question(group_meta, "name", ".+?_[sS]tunden")


def test_load_catalog(group_meta):
    cat = c.load_catalog(group_meta, c.GROUP_QUESTIONS)
    assert {q.key for q in c.GROUP_QUESTIONS} == set(cat.rows)
    assert cat.column("anzahl_tn") == "block_aktive/Teilnehmende"
    assert cat.columns("bedarfe") == [f.S + n for n in ("technik", "geld", "werbung")]
    assert cat.list_name("bedarfe") == "need"
    assert f.E + "erfolg_header" not in cat.columns("gewinnung_erfolg")
    with pytest.raises(c.QuestionError):
        cat.one("bedarfe")
    with pytest.raises(c.QuestionError):
        cat.all("unknown")
    with pytest.raises(c.QuestionError):
        c.load_catalog(group_meta, [c.Question("x", "name", "_stunden")])
    with pytest.raises(c.QuestionError):
        c.load_catalog(group_meta, [c.Question("x", "name", "missing", many=True)])


def test_person_catalog(spark):
    meta = f.metadata(spark, "tn")
    cat = c.load_catalog(meta, c.eigenschaften_by_block(meta, c.PERSON_QUESTIONS))
    assert len(cat.all("eigenschaften")) == 3 and len(cat.all("aussagen")) == 4
    assert cat.one("hilfe_sonst")["type"] == "text"
    assert cat.one("info_aenderung")["type"] == "select_one"
    assert cat.one("info_wunsch")["type"] == "select_multiple"


def test_matrix_headers_keep_all_rows(spark):
    kinds = ["begin_kobomatrix", "integer", "integer", "integer", "end_kobomatrix", "text",
             "begin_kobomatrix", "integer", "end_kobomatrix"]
    rows = [(i, k, f"k{i}", f"n{i}") for i, k in enumerate(kinds)]
    meta = local_table(spark, rows, "ord int, type string, kuid string, name string")
    got = [(r["matrix"], r["name"]) for r in c.matrix_headers(meta).orderBy("ord").collect()]
    assert got == [("k0", "n1"), ("k0", "n2"), ("k0", "n3"), ("k6", "n7")]
    both = meta.withColumn("year", F.explode(F.array(F.lit(1), F.lit(2))))
    assert c.matrix_headers(both, ["year"]).count() == 8


def test_matrix_cells_by_column_name():
    cols = ["g/block_x_w_1_staff", "g/block_x_m_1_staff", "g/other_w_1_staff", "g/block_x_w_1_guest"]
    found = c.matrix_columns(cols, "block_x")
    assert found == [cols[0], cols[1], cols[3]]
    got = c.matrix_cell_list(found, [("staff", "S"), ("guest", "G")], [("w_1", "W"), ("m_1", "M")])
    assert got == [(cols[0], "S", "W"), (cols[1], "S", "M"), (cols[3], "G", "W")]


def test_choices(spark):
    choices = c.load_choices(f.choice_table(spark))
    assert choices.mapping("yesno") == {"ja": "Ja", "nein": "Nein"}
    assert choices.levels("complete") == ["ja", "zum Teil", "nein"]
    assert choices.mapping("unknown") == {} and choices.mapping(None) == {}
    twice = local_table(spark, [("a", "A", "l", 0), ("a", "B", "l", 1)], "name string, label string, list_name string, ord int")
    with pytest.raises(ValueError, match="twice"):
        c.load_choices(twice)
    with pytest.raises(ValueError):
        c.mapping_of(twice, ["l", "m"])


def test_only_form_sized_tables_reach_the_driver(spark, monkeypatch):
    monkeypatch.setattr(c, "MAX_FORM_ROWS", 10)
    assert len(c.form_scale(spark.range(10))) == 10
    with pytest.raises(ValueError, match="not the metadata"):
        c.form_scale(spark.range(11))
    with pytest.raises(ValueError, match="not the metadata"):
        c.load_choices(f.choice_table(spark))


def test_mappings_and_ranks(spark):
    table = f.choice_table(spark)
    m = c.patch_mapping(c.extend_mapping(c.mapping_of(table, "yesno"), "x", "X"), "ja", "JA")
    assert {tuple(r) for r in m.collect()} == {("ja", "JA"), ("nein", "Nein"), ("x", "X")}
    ranks = c.ranked_choices(table, "need", {"nein": 0, "eher_nein": 1, "eher_ja": 2, "ja": 3, "unsicher": None})
    assert {r["name"]: r["rank"] for r in ranks.collect()} == {"nein": 0, "eher_nein": 1, "eher_ja": 2, "ja": 3, "unsicher": None}
    short = c.short_choice_labels(table, "access", ["A", "B", "C", "D", "E"]).collect()
    assert [(r["label"], r["label_short"], r["label_manual"]) for r in short][0] == ("Mitgenommen", "Andere Person", "A")


def test_option_of_rule_has_one_meaning(spark, group_meta):
    rows = c.option_codes(group_meta.filter(F.col("col_name").startswith(f.E))).collect()
    for r in rows:
        assert r["option"] == c.rule_option(r["relevant"])
    assert {r["option"] for r in rows} == {"insgesamt", "flyer", "social_media", "sonstige"}


def test_sources_of_a_result(spark):
    meta = f.metadata(spark, "tn")
    cat = c.build_catalog(meta, c.PERSON_QUESTIONS)
    got = {r["q_key"]: (r["n_questions"], r["questions"]) for r in c.source_labels(cat, ["worte", "stunden"]).collect()}
    assert got == {"worte": (3, "Erstes\nZweites\nDrittes"), "stunden": (1, "Wie viele Stunden pro Woche?")}


def test_trait_scales(spark):
    meta = f.metadata(spark, "tn").filter(F.col("col_name").startswith(f.P2))
    got = c.trait_scales(meta, "(Bei uns|Wir).+?auf einer Skala").orderBy("y").collect()
    assert [(r["y"], r["label_short"].strip()) for r in got] == [
        (1, "Alle helfen SEP Jeder allein"), (2, "Offen SEP Eng"), (3, "Neues SEP Altes"),
    ]


def test_source_labels_query_groups_every_row(spark):
    sf = "/root/testdata/sf0.001"
    counted = operators.source_labels_whole(spark, sf).agg({"n_questions": "sum"}).first()[0]
    assert counted == spark.read.parquet(f"{sf}/part.parquet").count()
