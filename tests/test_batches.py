import threading
from pathlib import Path

import pytest
from helpers import HISTORY, SCHEMA, SPEC, bag, snapshot
from lakehist.functions import AsOf
from lakehist.operators import scd2_bootstrap, scd2_delta, scd2_merge
from lakehist.operators.scd2 import CURRENT
from lakehist.sources import BatchTable, SinkSpec, publish, read_snapshot, scratch_dir, superset
from lakehist.sources import files
from pyspark.errors import AnalysisException
from pyspark.sql.types import BooleanType, StructField, StructType

DAYS = [AsOf.at(f"2024-05-0{n} 08:00:00") for n in range(1, 6)]
SNAPSHOTS = [
    [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)],
    [(1, "a", 1.0), (2, "B", 2.0), (4, "d", 4.0)],
    [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)],
]


@pytest.fixture(params=[0, 3], ids=["plain", "bucketed"])
def table(request, tmp_path):
    return BatchTable(str(tmp_path / "history"), HISTORY, SPEC.keys, CURRENT, request.param)


def apply(spark, table, batch, rows):
    rows = snapshot(spark, *rows)
    if batch == 0:
        table.write(scd2_bootstrap(rows, DAYS[0]), 0)
    else:
        table.write(scd2_delta(table.read(spark, batch - 1), rows, SPEC, DAYS[batch]), batch, clustered=table.buckets > 0)


def test_stored_batches_equal_the_whole_table_merge(spark, table):
    whole = None
    for batch, rows in enumerate(SNAPSHOTS):
        for _ in range(2):  # every batch is repeated once
            apply(spark, table, batch, rows)
        frame = snapshot(spark, *rows)
        whole = scd2_merge(whole, frame, SPEC, DAYS[batch]) if batch else scd2_bootstrap(frame, DAYS[0])
        assert bag(table.read_history(spark)) == bag(whole)
        assert bag(table.read(spark)) == bag(whole.where(CURRENT))
        assert table.read_history(spark).dtypes == whole.dtypes
    assert list(table.batches(spark)) == [0, 1, 2]
    assert table.read_history(spark, 1).count() == 5  # earlier states stay readable


def test_an_unfinished_batch_is_invisible(spark, table):
    apply(spark, table, 0, SNAPSHOTS[0])
    apply(spark, table, 1, SNAPSHOTS[1])
    [marker] = Path(table.root).glob("_published/1-*")  # as if the job had died before it published
    marker.rename(Path(table.root) / "_started" / "1-0")
    assert table.latest(spark) == 0
    assert table.read_history(spark).count() == 3
    apply(spark, table, 1, SNAPSHOTS[1])
    assert table.latest(spark) == 1 and table.read_history(spark).count() == 5
    assert [p.name for p in Path(table.root).glob("batch=1/*")] == ["attempt=1"]
    assert not list(Path(table.root).glob("_started/[0-9]*"))


def test_a_first_batch_that_died_is_run_again(spark, table, monkeypatch):
    monkeypatch.setattr(BatchTable, "_drop_others", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        apply(spark, table, 0, SNAPSHOTS[0])
    [marker] = Path(table.root).glob("_published/0-*")
    marker.unlink()
    monkeypatch.undo()
    apply(spark, table, 0, SNAPSHOTS[1])
    assert table.read_history(spark).count() == 3


def test_lost_markers_never_start_the_history_over(spark, table):
    apply(spark, table, 0, SNAPSHOTS[0])
    apply(spark, table, 1, SNAPSHOTS[1])
    [marker] = Path(table.root).glob("_published/1-*")
    marker.unlink()
    with pytest.raises(FileExistsError, match="batch=1"):
        apply(spark, table, 1, SNAPSHOTS[1])
    [marker] = Path(table.root).glob("_published/0-*")
    marker.unlink()
    assert table.latest(spark) is None
    with pytest.raises(FileExistsError, match="neither published"):
        apply(spark, table, 0, SNAPSHOTS[0])
    assert list(Path(table.root).glob("batch=0/attempt=0/rows/current_flag=true/*.parquet"))


def test_success_files_do_not_matter(spark, table):
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark._jsc.hadoopConfiguration().set(name, "false")
    try:
        for batch, rows in enumerate(SNAPSHOTS):
            apply(spark, table, batch, rows)
    finally:
        spark._jsc.hadoopConfiguration().unset(name)
    assert list(table.batches(spark)) == [0, 1, 2] and table.read_history(spark).count() == 7


@pytest.mark.parametrize(("name", "buckets"), [("x[1]", 0), ("{a,b}", 0), ("star*", 0), ("it's", 0), ("it's", 2)])
def test_any_character_in_the_path(spark, tmp_path, name, buckets):
    table = BatchTable(str(tmp_path / name / "t"), HISTORY, SPEC.keys, CURRENT, buckets)
    for batch, rows in enumerate(SNAPSHOTS):
        apply(spark, table, batch, rows)
    assert table.read_history(spark).count() == 7 and table.read(spark).count() == 3
    assert Path(table.root).is_dir()
    if not buckets and "'" not in name:
        with pytest.raises(ValueError, match="pattern"):
            BatchTable(table.root, HISTORY, SPEC.keys, CURRENT, 2)


def test_closed_rows_do_not_add_a_file_for_every_bucket(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), HISTORY, SPEC.keys, CURRENT, 16)
    rows = [snapshot(spark, *[(k, f"c{n}", 1.0) for k in range(200)]) for n in range(2)]
    table.write(scd2_bootstrap(rows[0], DAYS[0]), 0)
    counts = []
    for batch in range(1, 21):
        table.write(scd2_delta(table.read(spark), rows[batch % 2], SPEC, DAYS[0]), batch, clustered=True)
        counts.append(len(table.read_history(spark).inputFiles()))
    assert table.read_history(spark).count() == 200 * 21
    assert counts[-1] - counts[0] == 19  # one file a batch


def test_all_keys_gone_and_back(spark, table):
    apply(spark, table, 0, SNAPSHOTS[0])
    apply(spark, table, 1, [])
    assert table.read(spark).count() == 0 and table.read_history(spark).count() == 3
    apply(spark, table, 2, SNAPSHOTS[0])
    assert table.read(spark).count() == 3 and table.read_history(spark).count() == 6


def test_empty_first_snapshot(spark, table):
    apply(spark, table, 0, [])
    assert table.read(spark).count() == 0 and table.read_history(spark).count() == 0
    assert table.read(spark).dtypes == table.read_history(spark).dtypes


def test_bucket_count_may_change_between_batches(spark, tmp_path):
    root = str(tmp_path / "history")
    for batch, buckets in enumerate([0, 4, 2]):
        table = BatchTable(root, HISTORY, SPEC.keys, CURRENT, buckets)
        rows = snapshot(spark, *SNAPSHOTS[batch])
        if batch == 0:
            table.write(scd2_bootstrap(rows, DAYS[0]), 0)
        else:
            table.write(scd2_delta(table.read(spark), rows, SPEC, DAYS[batch]), batch)
    assert table.batches(spark) == {0: 0, 1: 4, 2: 2}
    assert table.read_history(spark).count() == 7 and table.read(spark).count() == 3


def test_repeating_a_batch_with_other_buckets_replaces_it(spark, tmp_path):
    root = str(tmp_path / "history")
    for buckets in (4, 0):
        BatchTable(root, HISTORY, SPEC.keys, CURRENT, buckets).write(
            scd2_bootstrap(snapshot(spark, *SNAPSHOTS[0]), DAYS[0]), 0
        )
    table = BatchTable(root, HISTORY, SPEC.keys, CURRENT)
    assert table.batches(spark) == {0: 0} and table.read_history(spark).count() == 3


def test_bucketed_tables_leave_nothing_in_the_catalog(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), SCHEMA, ("id",), None, 3)
    table.write(snapshot(spark, *SNAPSHOTS[0]), 0)
    assert table.read(spark).count() == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lakehist_")]


def test_dynamic_partition_overwrite_does_not_leave_stale_rows(spark, table):
    apply(spark, table, 0, SNAPSHOTS[0])
    apply(spark, table, 1, [])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        apply(spark, table, 1, SNAPSHOTS[0])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert table.read_history(spark).count() == 3


def test_missing_batches_and_wrong_use_are_errors(spark, tmp_path):
    table = BatchTable(str(tmp_path / "none"), SCHEMA)
    assert table.latest(spark) is None
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.write(snapshot(spark, *SNAPSHOTS[0]), 0)
    with pytest.raises(FileNotFoundError):
        table.read(spark, 7)
    with pytest.raises(ValueError, match="keeps no history"):
        table.read_history(spark)
    with pytest.raises(ValueError, match="bucketing needs"):
        BatchTable("x", None, (), None, 4)


def test_superset_keeps_columns_and_types(spark):
    before = snapshot(spark, (1, "a", 1.0))
    after = superset(before.select("spend", "id").withColumn("new`one", before.id), before.schema)
    assert after.columns == ["id", "city", "spend", "new`one"]
    assert tuple(after.first()) == (1, None, 1.0, 1)
    with pytest.raises(ValueError, match="city"):
        superset(before.withColumn("city", before.id), before.schema)


def test_expired_states_are_refused_and_closed_rows_stay(spark, table):
    for batch in (0, 1, 2):
        apply(spark, table, batch, SNAPSHOTS[batch])
    before = bag(table.read_history(spark))
    table.expire(spark, 1)
    assert bag(table.read_history(spark)) == before and list(table.batches(spark)) == [0, 1, 2]
    for read in (table.read, table.read_history):
        with pytest.raises(FileNotFoundError, match="dropped"):
            read(spark, 1)
    apply(spark, table, 3, SNAPSHOTS[1])
    assert table.read(spark).count() == 3
    with pytest.raises(ValueError, match="newest"):
        table.expire(spark, 0)


def test_expiring_a_plain_table_drops_whole_batches(spark, tmp_path):
    table = BatchTable(str(tmp_path / "t"), SCHEMA)
    for batch in (0, 1, 2):
        table.write(snapshot(spark, (batch, "a", 1.0)), batch)
    table.expire(spark, 2)
    assert list(table.batches(spark)) == [1, 2]


def test_snapshot_columns_are_cast_and_must_be_there(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.sql("SELECT 1 AS id, 'a' AS city, CAST(2.5 AS DECIMAL(10, 2)) AS spend, 'x' AS other").write.parquet(path)
    rows = read_snapshot(spark, path, SCHEMA)
    assert rows.dtypes == [("id", "bigint"), ("city", "string"), ("spend", "double")]
    assert rows.collect() == [(1, "a", 2.5)]
    with pytest.raises(AnalysisException, match="phone"):
        read_snapshot(spark, path, StructType([*SCHEMA.fields, StructField("phone", BooleanType())]))


def test_missing_snapshot_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_snapshot(spark, str(tmp_path / "nowhere"), SCHEMA)


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_publish_replaces_what_was_there(spark, tmp_path, format):
    path = str(tmp_path / "served")
    publish(snapshot(spark, *SNAPSHOTS[0]), SinkSpec(format, path=path))
    publish(snapshot(spark, (9, "z", 9.0)), SinkSpec(format, {"compression": "none"}, path))
    assert [tuple(r) for r in read_snapshot(spark, path, SCHEMA, format).collect()] == [(9, "z", 9.0)]


def test_scratch_folders_are_fresh_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(shared) and second.startswith(shared)


def _two_at_once(spark, table, monkeypatch, meet):
    """Two merges of batch 1 in threads that wait for each other in ``meet``; what each of them raised."""
    apply(spark, table, 0, SNAPSHOTS[0])
    barrier, outcomes, original = threading.Barrier(2, timeout=60), {}, getattr(BatchTable, meet)

    def waits(self, *args):
        found = original(self, *args)
        if threading.current_thread().name in ("one", "two") and not getattr(threading.current_thread(), "met", False):
            threading.current_thread().met = True
            barrier.wait()
        return found

    monkeypatch.setattr(BatchTable, meet, waits)

    def job(rows):
        name = threading.current_thread().name
        try:
            apply(spark, table, 1, rows)
            outcomes[name] = None
        except Exception as error:
            outcomes[name] = error

    threads = [threading.Thread(target=job, args=(rows,), name=name) for name, rows in (("one", SNAPSHOTS[1]), ("two", SNAPSHOTS[2]))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return outcomes


def test_of_two_merges_at_once_one_publishes(spark, table, monkeypatch):
    """Both have listed the same state; the one that does not get the attempt writes nothing."""
    outcomes = _two_at_once(spark, table, monkeypatch, "_begun")
    [failed] = [n for n, e in outcomes.items() if e is not None]
    assert isinstance(outcomes[failed], FileExistsError)
    monkeypatch.undo()
    assert table.latest(spark) == 1
    assert [p.name for p in Path(table.root).glob("batch=1/*")] == ["attempt=0"]
    winner = SNAPSHOTS[1] if failed == "two" else SNAPSHOTS[2]
    assert sorted(r["id"] for r in table.read(spark).collect()) == sorted(r[0] for r in winner)
    apply(spark, table, 1, SNAPSHOTS[1])  # and a run of its own goes on from there
    assert table.read_history(spark).count() == 5


def test_a_merge_that_was_overtaken_does_not_publish(spark, table):
    """A second job starts and publishes while the first still writes."""
    apply(spark, table, 0, SNAPSHOTS[0])
    slow = scd2_delta(table.read(spark, 0), snapshot(spark, *SNAPSHOTS[1]), SPEC, DAYS[1])
    refuse = BatchTable._refuse_remains

    def overtaken(self, *args):
        refuse(self, *args)
        if not overtaken.done:
            overtaken.done = True
            files.claim(spark, f"{self.root}/_started/1-0")
            apply(spark, self, 1, SNAPSHOTS[2])

    overtaken.done = False
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(BatchTable, "_refuse_remains", overtaken)
        with pytest.raises(FileExistsError):
            table.write(slow, 1, clustered=table.buckets > 0)
    assert sorted(r["id"] for r in table.read(spark, 1).collect()) == sorted(r[0] for r in SNAPSHOTS[2])


def test_a_claim_is_granted_once(spark, tmp_path):
    path = str(tmp_path / "deep" / "claim")
    files.claim(spark, path)
    for _ in range(2):
        with pytest.raises(FileExistsError):
            files.claim(spark, path)
    assert files.exists(spark, path)
