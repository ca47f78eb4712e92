from datetime import date, datetime, timezone

import pytest
from lakehist.functions import AsOf
from pyspark.sql import functions as F


def test_one_instant_gives_day_and_audit_in_the_business_zone():
    just_after_utc_midnight = AsOf(datetime(2024, 5, 2, 1, 30, tzinfo=timezone.utc))
    assert just_after_utc_midnight.day == date(2024, 5, 1)
    assert just_after_utc_midnight.audit_text == "2024-05-01 22:30:00"


def test_wall_clock_text_is_read_in_the_zone():
    assert AsOf.at("2024-05-01 22:30:00").instant == datetime(2024, 5, 2, 1, 30, tzinfo=timezone.utc)


def test_naive_instants_are_refused():
    with pytest.raises(ValueError, match="zone-aware"):
        AsOf(datetime(2024, 5, 1))


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Sao_Paulo"])
def test_literals_do_not_depend_on_the_session_zone(spark, zone):
    as_of = AsOf.at("2024-05-01 22:30:00")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            F.unix_seconds(as_of.timestamp()).alias("s"), as_of.date().alias("d"), as_of.audit().alias("a")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.s, row.d, row.a) == (int(as_of.instant.timestamp()), date(2024, 5, 1), "2024-05-01 22:30:00")
