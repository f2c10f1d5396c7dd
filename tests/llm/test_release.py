"""A worker's table does not outlive the operator that made it, and freed memory goes back to the system."""

import pytest

from canvass.llm import arrow, jaccard, secret_scan


def test_release():
    arrow.held("kind", 1, lambda: [1])
    assert arrow.held("kind", 1, lambda: [2]) == [1]
    arrow.release()
    assert arrow.HELD == {}


@pytest.mark.parametrize("stage", [
    lambda df: jaccard.classes_of(df, "doc_id", "text", 5), lambda df: jaccard.shingle_rows(df, "text", 5),
    lambda df: secret_scan.redact_secrets(df), lambda df: jaccard.keep_one_of_each(df, size=5, part=80, whole=100),
])
def test_stages_without_a_table_release_it(spark, stage):
    """Each of these stages finds workers that hold the table of the language stage."""
    df = spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(40)], "doc_id long, text string").repartition(4)

    def hold(batches):
        for batch in batches:
            arrow.held("language", 1, lambda: [1])
            yield batch

    def holds(batches):
        for batch in batches:
            yield batch.slice(0, 1 if arrow.HELD else 0)

    held = df.mapInArrow(hold, df.schema)
    for _ in range(3):
        held.count()
    for _ in range(4):
        stage(df).collect()
    assert df.mapInArrow(holds, df.schema).count() == 0
