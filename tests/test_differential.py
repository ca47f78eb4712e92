"""Random snapshots against the literal two-merge procedure, run by DuckDB's own MERGE."""

from collections import Counter
from dataclasses import replace

import duckdb
import pytest
from helpers import HISTORY, OPEN, SPEC, snapshot
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from lakehist.functions import AsOf
from lakehist.operators import MirrorSpec, scd1_mirror, scd2_bootstrap, scd2_delta, scd2_merge
from lakehist.operators.scd2 import CURRENT, UPDATED
from lakehist.sources import BatchTable
from pyspark.sql import functions as F

CITY = st.sampled_from([None, "a", "b"])
SPEND = st.sampled_from([None, 1.0, 2.0, float("nan")])


def snapshots(max_days=4):
    day = st.dictionaries(st.integers(1, 6), st.tuples(CITY, SPEND), max_size=6)
    return st.lists(day, min_size=2, max_size=max_days)


def as_rows(day):
    return [(key, city, spend) for key, (city, spend) in day.items()]


def clean(value):
    return "NaN" if isinstance(value, float) and value != value else value


def bag(rows):
    return Counter(tuple(clean(v) for v in row) for row in rows)


def duckdb_history(days, clocks, null_safe):
    con = duckdb.connect()
    con.execute("""CREATE TABLE history (id BIGINT, city VARCHAR, spend DOUBLE,
        start_date DATE, end_date DATE, current_flag BOOLEAN, updated BIGINT)""")
    test = "IS DISTINCT FROM" if null_safe else "<>"
    for n, (rows, clock) in enumerate(zip(days, clocks)):
        con.execute("CREATE OR REPLACE TABLE raw (id BIGINT, city VARCHAR, spend DOUBLE)")
        if rows:
            con.executemany("INSERT INTO raw VALUES (?, ?, ?)", rows)
        today, now = f"DATE '{clock.day}'", int(clock.instant.timestamp())
        if n:
            con.execute(f"""MERGE INTO history h USING raw r ON r.id = h.id AND h.current_flag
                WHEN MATCHED AND (r.city {test} h.city OR r.spend {test} h.spend)
                THEN UPDATE SET end_date = {today}, current_flag = FALSE, updated = {now}""")
        con.execute(f"""MERGE INTO history h USING raw r ON r.id = h.id AND h.current_flag
            WHEN NOT MATCHED THEN INSERT VALUES (r.id, r.city, r.spend, {today}, DATE '{OPEN}', TRUE, {now})
            WHEN NOT MATCHED BY SOURCE AND h.current_flag
            THEN UPDATE SET end_date = {today}, current_flag = FALSE, updated = {now}""")
        yield con.execute("SELECT * FROM history").fetchall()


@pytest.mark.parametrize("null_safe", [False, True])
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=snapshots())
def test_history_equals_two_merges_and_keeps_its_invariants(spark, null_safe, days):
    spec = replace(SPEC, null_safe=null_safe)
    clocks = [AsOf.at(f"2024-05-0{n + 1} 08:00:00") for n in range(len(days))]
    rows = [as_rows(d) for d in days]
    history = None
    for n, expected in enumerate(duckdb_history(rows, clocks, null_safe)):
        seen = snapshot(spark, *rows[n])
        merged = scd2_merge(history, seen, spec, clocks[n]) if n else scd2_bootstrap(seen, clocks[n])
        got = merged.withColumn("updated_at", F.unix_seconds("updated_at")).collect()
        assert bag(got) == bag(expected)
        history = spark.createDataFrame(merged.collect(), merged.schema)  # cut the lineage between batches

        live = [r for r in got if r.current_flag]
        assert len({r.id for r in live}) == len(live) == len(rows[n])
        assert all((r.end_date == OPEN) == r.current_flag for r in got)
        assert all(r.start_date <= r.end_date for r in got)
        if null_safe:
            assert bag((r.id, r.city, r.spend) for r in live) == bag(rows[n])
        spans = sorted((r.id, r.start_date, r.end_date) for r in got)
        assert all(a[0] != b[0] or a[2] <= b[1] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("null_safe", [False, True])
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=snapshots(max_days=2))
def test_mirror_equals_one_merge(spark, null_safe, days):
    spec = MirrorSpec(("id",), ("city", "spend"), "stamp", null_safe=null_safe)
    test = "IS DISTINCT FROM" if null_safe else "<>"
    con = duckdb.connect()
    for name, day, stamp in (("target", days[0], "old"), ("source", days[1], "new")):
        con.execute(f"CREATE TABLE {name} (id BIGINT, city VARCHAR, spend DOUBLE, stamp VARCHAR)")
        if day:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, '{stamp}')", as_rows(day))
    con.execute(f"""MERGE INTO target t USING source s ON t.id = s.id
        WHEN MATCHED AND (t.city {test} s.city OR t.spend {test} s.spend)
          THEN UPDATE SET city = s.city, spend = s.spend, stamp = s.stamp
        WHEN NOT MATCHED THEN INSERT VALUES (s.id, s.city, s.spend, s.stamp)
        WHEN NOT MATCHED BY SOURCE THEN DELETE""")
    target = snapshot(spark, *as_rows(days[0])).withColumn("stamp", F.lit("old"))
    source = snapshot(spark, *as_rows(days[1])).withColumn("stamp", F.lit("new"))
    assert bag(scd1_mirror(target, source, spec).collect()) == bag(con.execute("SELECT * FROM target").fetchall())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=snapshots(max_days=3), layout=st.lists(st.tuples(st.sampled_from([0, 2, 3]), st.booleans()), min_size=3, max_size=3))
def test_stored_history_equals_two_merges_under_any_layout(spark, tmp_path_factory, days, layout):
    """Bucket counts change from batch to batch, and some batches are run twice."""
    root = str(tmp_path_factory.mktemp("history"))
    clocks = [AsOf.at(f"2024-05-0{n + 1} 08:00:00") for n in range(len(days))]
    rows = [as_rows(d) for d in days]
    for n, expected in enumerate(duckdb_history(rows, clocks, null_safe=False)):
        buckets, twice = layout[n]
        table = BatchTable(root, HISTORY, SPEC.keys, CURRENT, buckets)
        for _ in range(1 + twice):
            seen = snapshot(spark, *rows[n])
            if n:
                seen = scd2_delta(table.read(spark, n - 1), seen, SPEC, clocks[n])
            else:
                seen = scd2_bootstrap(seen, clocks[0])
            table.write(seen, n)
        stored = table.read_history(spark).withColumn(UPDATED, F.unix_seconds(UPDATED))
        assert bag(stored.collect()) == bag(expected)
