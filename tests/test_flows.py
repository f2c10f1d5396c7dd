"""Cleaning of a handful of submissions, expected tables worked out by hand."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from canvass.functions.local import local_table
from canvass.plans import combine, groups, network, people, regions
from canvass.plans.editions import Editions, union_editions
from canvass.operators.catalog import Catalog, Choices
from workload import forms as f

GROUP_COLUMNS = [
    "_id", "year", "end", "_uuid", "meta/x", f.A + "F1_Wochentage", f.A + "Montag_Stunden", f.A + "F2_Anzahl_Auftritte",
    f.A + "F4_Hauptamt", "block_aktive/Mitarbeitende_inkl_Leitung", "block_aktive/Teilnehmende",
    f.D + "block_gender_weiblich_1_mitarbeitende", f.D + "block_gender_weiblich_1_teilnehmende",
    f.B + "tngewinnung_massnahmen", f.B + "tngewinnung_massnahmen_sonst", f.E + "insgesamt", f.E + "sonstige",
    f.S + "technik", f.W + "region", f.W + "ortsgruppe_name",
]
IN_TIME, LATE = "2024-11-01 10:00:00", "2025-01-01 00:00:00"
GROUP_ROWS = [
    (1, 2024, IN_TIME, "u", "m", "montag freitag", "2.7", "3", "ja_voll", "4", "21", "2", "x", "sonstige flyer", "Zeitung",
     "5", "4", "ja", "owl", "gruppe 1"),
    (2, 2024, IN_TIME, "u", "m", None, "1", None, "nein", "4.9", None, None, None, "flyer", "verwaist", None, "2", "quatsch",
     "nord", "Gruppe 1"),
    (3, 2024, LATE, "u", "m", "montag", "1", "1", "nein", "1", "1", "1", "1", None, None, "1", None, "ja", "nord", "Gruppe 2"),
    (4, 2024, IN_TIME, "u", "m") + (None,) * 15,
    (5, 2024, IN_TIME, "u", "m", None, None, "0", None, "0", "7", None, None, None, None, None, None, None, "anhalt", ""),
]


def frame(spark, columns, data):
    types = {"_id": "bigint", "year": "int"}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in columns)
    return local_table(spark, data, schema).withColumn("end", F.to_timestamp("end"))


@pytest.fixture(scope="module")
def spelling(spark):
    rows = [("gruppe 1", "Gruppe 1", "Ostwestfalen-Lippe"), ("Gruppe 1", "Gruppe 1", "Ostwestfalen-Lippe"),
            ("wilde 7", "Gruppe 7", "Nord"), (None, None, None)]
    return local_table(spark, rows, "og_name_orig string, og_name string, og_region string")


@pytest.fixture(scope="module")
def group_tables(spark):
    raw = frame(spark, GROUP_COLUMNS, GROUP_ROWS)
    return groups.clean_groups(raw, f.form(spark, "og"), f.region_map(spark))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_late_and_empty_submissions_are_gone(group_tables):
    assert [r[0] for r in rows(group_tables["og.data"], "og_id")] == [1, 2, 5]


def test_group_data(group_tables):
    got = rows(group_tables["og.data"], "og_id", "auftritte", "hat_hauptamt", "anzahl_ma_leitung", "anzahl_tn",
               "anzahl_insg", "og_region", "og_name_orig", "region_grouped")
    assert got == [
        (1, 3, "Ja", 4, 21, 25, "Ostwestfalen-Lippe (OWL)", "gruppe 1", None),
        (2, None, "Nein", 4, None, None, "Nord", "Gruppe 1", "Nord"),
        (5, 0, None, 0, 7, 7, "Anhalt", None, None),
    ]


def test_weekdays_with_absent_column(group_tables):
    assert rows(group_tables["og.long.wochentage"], "og_id", "wochentag", "stunden") == [
        (1, "Freitag", None), (1, "Montag", 2),
    ]


def test_gender_matrix(group_tables):
    assert rows(group_tables["og.long.gender_by_participant_type"], "og_id", "person_type", "gender", "n") == [
        (1, "Mitarbeitende (inkl. Leitung)", "weiblich", 2), (1, "Teilnehmende", "weiblich", None),
    ]


def test_measures_attach_text_only_when_ticked(group_tables):
    assert rows(group_tables["og.long.tn_gewinnung_massnahmen"], "og_id", "erfolg", "massnahme", "massnahme_sonst") == [
        (1, 4, "Sonstige Maßnahmen", "Zeitung"), (1, 5, "Insgesamt", None), (2, 2, "Sonstige Maßnahmen", None),
    ]


def test_needs_unknown_code_is_missing(group_tables):
    assert rows(group_tables["og.long.unterstuetzungsbedarfe"], "og_id", "bedarf", "bedarf_value") == [
        (1, "Technik", "ja"), (2, "Technik", None),
    ]


def test_typed_names_are_harmonized_and_first_kept(spark, group_tables, spelling):
    typed = dict(group_tables)
    typed["og.data"] = groups.harmonize_groups(group_tables["og.data"], spelling, f.region_map(spark))
    kept = groups.first_submissions(typed)
    assert rows(kept["og.data"], "og_id", "og_name", "og_region", "region_grouped", "og_region_orig") == [
        (1, "Gruppe 1", "Ostwestfalen-Lippe", "West", "Ostwestfalen-Lippe (OWL)"),
    ]
    assert {r[0] for r in rows(kept["og.long.unterstuetzungsbedarfe"], "og_id")} == {1}


@pytest.fixture(scope="module")
def listed_form(spark):
    """The same form, but the group name is chosen from a list."""
    form = f.form(spark, "og")
    name = Row(**(form.catalog.one("name").asDict() | {"list_name": "names"}))
    cat = Catalog(dict(form.catalog.rows) | {"name": [name]}, form.catalog.cut)
    choices = Choices(dict(form.choices.lists) | {"names": [("gruppe 1", "Gruppe Eins")]})
    return groups.Form(cat, choices, form.matrix_headers)


def test_editions_with_different_forms(spark, group_tables, listed_form, spelling):
    regs = f.region_map(spark)
    typed = dict(group_tables)
    typed["og.data"] = groups.harmonize_groups(group_tables["og.data"], spelling, regs)
    later = [(r[0] + 10, 2025, "2025-10-01 00:00:00", *r[3:]) for r in GROUP_ROWS]
    listed = groups.clean_groups(frame(spark, GROUP_COLUMNS, later), listed_form, regs)
    kept = groups.first_submissions(union_editions([typed, listed]))
    assert rows(kept["og.data"], "year", "og_id", "og_name", "og_region", "og_region_orig") == [
        (2024, 1, "Gruppe 1", "Ostwestfalen-Lippe", "Ostwestfalen-Lippe (OWL)"),
        (2025, 11, "Gruppe Eins", "Ostwestfalen-Lippe (OWL)", None),
    ]
    assert rows(kept["og.long.unterstuetzungsbedarfe"], "year", "og_id") == [(2024, 1), (2025, 11)]


def test_form_with_a_name_list(spark, listed_form):
    raw = frame(spark, GROUP_COLUMNS, GROUP_ROWS)
    out = groups.clean_groups(raw, listed_form, f.region_map(spark))
    assert rows(out["og.data"], "og_id", "og_name") == [(1, "Gruppe Eins"), (2, None), (5, None)]
    assert rows(groups.first_submissions(out)["og.data"], "og_id") == [(1,)]


PERSON_COLUMNS = [
    "_id", "year", "end", "_uuid", f.P1 + "Wort_1", f.P1 + "Wort_2", f.P2 + "eig_gemeinschaft", "block_zugang/zugangsweg",
    "block_zugang/zugangsweg_sonst", f.P3 + "kreativ", f.P3 + "lernen", f.P4 + "angebote_vor_ort",
    f.P4 + "andere_angebote_vor_ort", f.P4 + "zeit_pro_woche", f.P4 + "ortsgruppe_region", f.P4 + "ortsgruppe_name",
    f.P6 + "verantwortung", "block_demografie/jahre", "block_demografie/kontakt",
]
PERSON_ROWS = [
    (1, 2024, IN_TIME, "u", "Musik", None, "3", "sonstiges seminar", "per Zufall", "4", "6", "technik___licht andere_workshops",
     "Zirkus", "39.5", "hessen", "Singkreis gruppe 1", "ja", "15", "nein weiss"),
    (2, 2024, IN_TIME, "u", "Musik", "Spaß", None, "seminar", "ohne Haken", "3", None, "chor", None, "40", "nord", " GRUPPE", "nein",
     "99", "ja_gemeinde weiss"),
    (3, 2024, IN_TIME, "u", None, None, "6", None, None, None, None, "falsch", "x", "viel", "owl", None, None, "100", "nein"),
    (4, 2024, LATE, "u", "zu spät", None, "6", None, None, "1", "1", None, None, "1", "owl", "gruppe 1", "ja", "15", None),
    (5, 2024, IN_TIME, "u", None, None, "1", None, None, "6", "1", None, None, "2", "sued", "wilde 7", "ja", "x", None),
    (6, 2024, IN_TIME, "u", None, None, "1", None, None, "6", "1", None, None, None, "sued", "wilde 7", None, "20", None),
    (7, 2024, IN_TIME, "u", None, None, "1", None, None, "6", "1", None, None, "2", "sued", "Sing-Kreis wilde 7 ", "nein", "21", None),
]


@pytest.fixture(scope="module")
def person_tables(spark, spelling):
    raw = frame(spark, PERSON_COLUMNS, PERSON_ROWS)
    return people.clean_people(raw, f.form(spark, "tn"), spelling, f.region_map(spark), f.BRAND_WORDS)


def test_person_data(person_tables):
    got = rows(person_tables["tn.data"], "tn_id", "stunden_pro_woche", "og_name_orig", "og_name_cleaned", "og_name",
               "og_region_orig", "og_region", "region_grouped", "verantwortung_janein")
    assert got == [
        (1, 39.5, "Singkreis gruppe 1", "gruppe 1", "Gruppe 1", "Hessen", "Ostwestfalen-Lippe", "West", "Ja"),
        # a name that is not in the map: the person's own region is used
        (2, None, " GRUPPE", "GRUPPE", None, "Nord", "Nord", "Nord", "Nein"),
        # the missing spelling of the map does not match a missing name
        (3, None, None, "", None, "Ostwestfalen-Lippe", "Ostwestfalen-Lippe", "West", None),
        (5, 2.0, "wilde 7", "wilde 7", "Gruppe 7", "Süden", "Nord", "Nord", "Ja"),
        (6, None, "wilde 7", "wilde 7", "Gruppe 7", "Süden", "Nord", "Nord", None),
        (7, 2.0, "Sing-Kreis wilde 7 ", "wilde 7", "Gruppe 7", "Süden", "Nord", "Nord", "Nein"),
    ]
    assert "alter" not in person_tables["tn.data"].columns


def test_person_long_tables(person_tables):
    assert rows(person_tables["tn.long.woerter"], "tn_id", "wort") == [(1, "Musik"), (2, "Musik"), (2, "Spaß")]
    assert rows(person_tables["tn.long.zugangsweg"], "tn_id", "zugangsweg", "zugangsweg_sonst") == [
        (1, "Seminar", None), (1, "Sonstiges", "per Zufall"), (2, "Seminar", None),
    ]
    assert rows(person_tables["tn.long.angebote_vor_ort"], "tn_id", "angebot", "angebot_sonst") == [
        (1, "Andere Workshops", "Zirkus"), (1, "Technik/Licht", None), (2, "Chor", None), (3, None, None),
    ]
    assert rows(person_tables["tn.long.eigenschaften"], "tn_id", "eig", "value")[0] == (1, "eig_gemeinschaft", "3")


def test_statements_are_named_by_their_path(person_tables):
    wide = person_tables["tn.wide.aussagen"]
    assert wide.columns == ["year", "tn_id", "glaube_spiritualitaet", "kreativ", "lernen", "transfer"]
    assert rows(wide, "tn_id", "kreativ", "lernen", "transfer")[0] == (1, "4", "6", None)
    agg = {r["aussage"]: (r["total_non_na"], r["average"], r["zustimmung"], r["zustimmung_perc"])
           for r in person_tables["tn.agg.aussagen"].collect()}
    assert agg["kreativ"] == (5, 5.0, 4, 0.8) and agg["transfer"] == (0, None, 0, None)


def test_age_by_group_is_withheld_for_small_groups(person_tables):
    got = {r["og_name"]: (r["avg_alter"], r["n"]) for r in person_tables["tn.agg.alter_by_og"].collect()}
    # 20 and 21 are known, "x" is not: 20.5 rounds to the even 20
    assert got == {"Gruppe 1": (None, 1), "Gruppe 7": (20.0, 3), None: (None, 2)}


def test_demographics_hold_no_ids(person_tables):
    age = person_tables["tn.demo.alter"]
    assert age.columns == ["year", "alter"]
    assert sorted((r["alter"] for r in age.collect()), key=repr) == sorted([15, 99, None, None, 20, 21], key=repr)


def test_combined_totals(spark, group_tables, person_tables, spelling):
    typed = dict(group_tables)
    typed["og.data"] = groups.harmonize_groups(group_tables["og.data"], spelling, f.region_map(spark))
    og = groups.first_submissions(typed)["og.data"]
    total = combine.combined_totals(og, person_tables["tn.data"])
    assert rows(total, "region_grouped", "og_region", "og_name", "anzahl_insg", "anzahl_tn", "anzahl_ma_leitung") == sorted([
        ("West", "Ostwestfalen-Lippe", "Gruppe 1", 25, 21, 4),
        ("Nord", "Nord", "Gruppe 7", 3, 2, 1),
        ("Nord", "Nord", "keine Angabe", 1, 1, 0),
        ("West", "Ostwestfalen-Lippe", "keine Angabe", 1, 1, 0),
    ], key=repr)
    table = network.region_table(network.region_groups(og, person_tables["tn.data"]), f.region_map(spark))
    assert rows(table, "region_grouped", "slug", "n_og", "anzahl_insg") == [("Nord", "nord", 2, 4), ("West", "west", 2, 26)]
    overview = regions.region_overview(total, og, person_tables["tn.agg.alter_by_og"])
    footer = regions.overview_footer(overview).collect()[0]
    assert (footer["hat_hauptamt"], footer["anzahl_insg"], footer["auftritte"], footer["avg_alter"]) == (1, 30, 3, 20.0)


def test_editions_store(spark, tmp_path, group_tables, person_tables, spelling):
    store = Editions(spark, str(tmp_path), group_tables, person_tables, f.region_map(spark), spelling)
    assert store.table("og.agg.total_tn_by_og").count() == 4
    assert set(store.known) == {"og.data", "tn.data", "og.agg.total_tn_by_og"}
    assert rows(store.table("og.long.unterstuetzungsbedarfe"), "og_id") == [(1,)]
    store.build()
    assert set(store.names()) == set(store.known)
    assert store.table("og.long.angebote_vor_ort").count() == 0
    assert store.table("tn.long.aussagen").count() == 6 * 4


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_landed_submissions_give_the_same_tables(spark, tmp_path, group_tables, fmt):
    from canvass.sources.submissions import found_columns, read_submissions

    path, form = str(tmp_path / fmt), f.form(spark, "og")
    writer = frame(spark, GROUP_COLUMNS, GROUP_ROWS).drop("year").write.format(fmt)
    (writer.option("header", True).option("nullValue", "NA") if fmt == "csv" else writer).save(path)
    assert form.blocks() == ["block_gender", "group_jahre"]
    assert f.D + "block_gender_weiblich_1_mitarbeitende" in found_columns(spark, path, fmt)
    raw = read_submissions(spark, path, 2024, form.catalog.answer_columns(), fmt, form.blocks())
    landed = groups.clean_groups(raw, form, f.region_map(spark))
    for name, table in group_tables.items():
        cols = sorted(table.columns)
        assert rows(landed[name], *cols) == rows(table, *cols), name
