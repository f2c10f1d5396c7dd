"""Editions kept up to date, merged states, and the levels of the region report."""

import json
import os

import pytest
from pyspark.sql import functions as F

from canvass.operators import partials
from canvass.plans import regions
from canvass.sources import ledger
from workload import survey

SF = "/root/testdata/sf0.001"


def land(spark, folder, year, rows):
    path = f"{folder}/landing/{year}"
    spark.createDataFrame(rows, "year int, name string, n int").write.mode("overwrite").parquet(path)
    return path


def total(stored, submissions):
    rows = partials.numbered(stored("rows"), "name", ["year"])
    return partials.states(rows, ["year"], ["n"])


TABLES = {"rows": lambda stored, submissions: submissions.filter("n IS NULL OR n >= 0"), "total": total}


def refreshed(spark, folder, landed, tables=None, opened=None, **more):
    def read(paths):
        if opened is not None:
            opened.extend(paths)
        return spark.read.schema("year int, name string, n int").parquet(*paths)

    return ledger.refresh(spark, f"{folder}/store", landed, read, tables or TABLES, **more)


def told(spark, folder):
    out = partials.merged(ledger.kept_table(spark, f"{folder}/store", "total"), {"year": ["year"]})
    rows = out.select("year", partials.entities().alias("e"), partials.strict_total("n").alias("s"), partials.known_total("n").alias("k"))
    return sorted(tuple(r) for r in rows.collect())


def times(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{folder}/store/tables") for f in fs}


def test_only_changed_editions_are_made(spark, tmp_path):
    folder = str(tmp_path)
    landed = {y: land(spark, folder, y, [(y, "a", 1), (y, "b", 2), (y, None, None)]) for y in (2023, 2024)}
    assert refreshed(spark, folder, landed) == [2023, 2024]
    assert told(spark, folder) == [(2023, 3, None, 3), (2024, 3, None, 3)]
    assert refreshed(spark, folder, landed) == []
    before, opened = times(folder), []
    landed[2025] = land(spark, folder, 2025, [(2025, "a", 5)])
    assert refreshed(spark, folder, landed, opened=opened) == [2025]
    landed[2024] = land(spark, folder, 2024, [(2024, "a", 7), (2024, "a", 1), (2024, "x", -1)])
    assert refreshed(spark, folder, landed, opened=opened) == [2024]
    assert opened == [landed[2025], landed[2024]]
    after = times(folder)
    assert {p: after[p] for p in before} == before
    assert told(spark, folder) == [(2023, 3, None, 3), (2024, 1, 8, 8), (2025, 1, 5, 5)]
    # one edition is looked at alone
    one = ledger.kept_table(spark, f"{folder}/store", "rows", [2024])
    assert one.count() == 2 and all("edition=2024" in f for f in one.inputFiles())
    # new rules make everything anew; an edition that is gone leaves
    assert refreshed(spark, folder, landed, version="2") == [2023, 2024, 2025]
    assert refreshed(spark, folder, {2025: landed[2025]}, version="2") == []
    assert told(spark, folder) == [(2025, 1, 5, 5)]


def test_a_refresh_that_dies_is_not_seen(spark, tmp_path):
    folder = str(tmp_path)
    landed = {2024: land(spark, folder, 2024, [(2024, "a", 1)])}
    refreshed(spark, folder, landed)
    landed[2024] = land(spark, folder, 2024, [(2024, "a", 1), (2024, "b", 10)])

    def dies(stored, submissions):
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        refreshed(spark, folder, landed, TABLES | {"total": dies})
    assert told(spark, folder) == [(2024, 1, 1, 1)]
    assert len(ledger.Ledger(spark, f"{folder}/store").forgotten()) == 1
    assert refreshed(spark, folder, landed) == [2024]
    assert told(spark, folder) == [(2024, 2, 11, 11)]


def test_two_refreshes_do_not_both_count(spark, tmp_path):
    store = ledger.Ledger(spark, str(tmp_path))
    store.put(1, {"editions": {}, "schemas": {}})
    with pytest.raises(ledger.LedgerConflict):
        store.put(1, {"editions": {"1": {}}, "schemas": {}})
    number, content = store.newest()
    assert (number, json.dumps(content)) == (1, '{"editions": {}, "schemas": {}}')
    with pytest.raises(LookupError):
        ledger.kept_table(spark, str(tmp_path), "rows")


def test_empty_editions(spark, tmp_path):
    folder = str(tmp_path)
    landed = {y: land(spark, folder, y, rows) for y, rows in ((2023, []), (2024, [(2024, "a", -1)]))}
    assert refreshed(spark, folder, landed) == [2023, 2024]
    assert told(spark, folder) == []


def test_states_of_many_entities(spark):
    """More than one bucket of numbers, a column without values, NULL as a group."""
    n = 70_000
    df = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("who"),
        F.lit(None).cast("int").alias("nothing"),
    )
    cells = partials.states(partials.numbered(df, "who"), ["g"], ["nothing"])
    out = partials.merged(cells, {"all": [], "g": ["g"]}).select("level", "g", partials.entities(), partials.strict_total("nothing"),
                                                                  partials.known_total("nothing"))
    got = {tuple(r) for r in out.collect()}
    ids = [(i % 3 or None, i if i % 7 else None) for i in range(n)]
    want = {("all", None, len({w for _, w in ids}), None, 0)}
    want |= {("g", g, len({w for k, w in ids if k == g}), None, 0) for g in (None, 1, 2)}
    assert got == want


def test_overview_reads_each_form_once(spark):
    plan = survey.report_region_overview(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in plan.splitlines() if " Relation [" in line]
    # groups, people, and the spelling map of each
    assert len([s for s in scans if "o_orderkey" in s]) == 1 and len(scans) <= 4
    both = regions.region_overview(
        survey.tables(spark, SF)["totals"], survey.tables(spark, SF)["og.data"], survey.tables(spark, SF)["tn.agg.alter_by_og"])
    one = survey.report_region_overview(spark, SF)
    columns = sorted(both.columns)
    assert sorted(map(repr, one.select(columns).collect())) == sorted(map(repr, both.select(columns).collect()))
