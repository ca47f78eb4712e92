import pytest
from lakehist.operators import Ranking, bottom, top, top_bottom
from pyspark.sql import functions as F

SPEC = Ranking(
    metric="spend", keys=("id",), active="live", columns=("id", "spend"), label_column="half",
    top_label="best", bottom_label="worst", stamp_column="at", k=3,
)
STAMP = "2024-05-01 08:00:00"


@pytest.fixture
def customers(spark):
    rows = [(1, 10.0, True), (2, 30.0, True), (3, 30.0, True), (4, 30.0, True), (5, 99.0, False),
            (6, None, True), (7, 5.0, True), (8, 7.0, None)]
    return spark.createDataFrame(rows, "id long, spend double, live boolean")


def ids(df):
    return [r.id for r in df.collect()]


def test_ties_at_the_cut_go_to_the_lowest_key_and_inactive_rows_are_out(customers):
    assert ids(top(customers, SPEC, F.lit(STAMP))) == [2, 3, 4]
    assert ids(top(customers, Ranking(**{**SPEC.__dict__, "k": 2}), F.lit(STAMP))) == [2, 3]


def test_bottom_starts_with_unknown_spend_unless_skipped(customers):
    assert ids(bottom(customers, SPEC, F.lit(STAMP))) == [6, 7, 1]
    assert ids(bottom(customers, SPEC, F.lit(STAMP), skip_null=True)) == [7, 1, 2]


def test_both_halves_with_labels_and_stamp(customers):
    report = top_bottom(customers, SPEC, F.lit(STAMP))
    assert report.columns == ["id", "spend", "half", "at"]
    assert report.groupBy("half").count().orderBy("half").collect() == [("best", 3), ("worst", 3)]
    assert {r["at"] for r in report.collect()} == {STAMP}


def test_few_active_rows_appear_in_both_halves(spark):
    rows = spark.createDataFrame([(1, 1.0, True)], "id long, spend double, live boolean")
    assert [(r.id, r.half) for r in top_bottom(rows, SPEC, F.lit(STAMP)).collect()] == [(1, "best"), (1, "worst")]
