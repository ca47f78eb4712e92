import os
import subprocess
import sys
from collections import Counter
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from lakehist import cli
from lakehist.functions import AsOf
from lakehist.operators import KeyContractError
from lakehist.plans import CUSTOMERS, Lake, run_all, run_bronze, run_gold, run_ranking, run_silver
from lakehist.sources import SinkSpec
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

DAY1, DAY2, DAY3 = (AsOf.at(f"2024-05-0{n} 09:00:00") for n in (1, 2, 3))


def customer(key, city="Rio", spent=100.0, active=True, name="Ana"):
    return (key, name, "Lima", "a@x", "1", city, "rj", date(2024, 4, 1), date(2024, 4, 20), spent, active)


@pytest.fixture
def drop(spark, tmp_path):
    """Write a raw snapshot and return its path."""

    def write(name, *rows):
        path = str(tmp_path / "drop" / name)
        spark.createDataFrame(list(rows), CUSTOMERS.raw).write.parquet(path)
        return path

    return write


@pytest.fixture(params=[0, 3], ids=["plain", "bucketed"])
def lake(request, tmp_path):
    return Lake(str(tmp_path / "lake"), buckets=request.param)


def test_paths_follow_layer_and_table(tmp_path):
    lake = Lake("gs://lake/")
    assert lake.raw == "gs://lake/raw/raw_customers/raw_customers.parquet"
    assert lake.bronze.root == "gs://lake/bronze/bronze_customers"
    assert replace(lake, raw_path="s3a://drop/x").raw == "s3a://drop/x"


def test_a_vanished_customer_leaves_every_layer_but_the_history(spark, lake, drop):
    first, second = drop("1", customer(1), customer(2)), drop("2", customer(1))
    run_all(spark, lake, DAY1, raw_path=first)
    run_all(spark, lake, DAY2, raw_path=second)
    closed = lake.bronze.read_history(spark).where("not current_flag").collect()
    assert [(r.customer_id, r.end_date) for r in closed] == [(2, date(2024, 5, 2))]
    assert [r.id_cliente for r in lake.silver.read(spark).collect()] == [1]
    assert [r.id_cliente for r in lake.gold.read(spark).collect()] == [1]


def test_a_returning_customer_gets_a_second_interval(spark, lake, drop):
    both, one = drop("1", customer(1), customer(2)), drop("2", customer(1))
    for as_of, path in [(DAY1, both), (DAY2, one), (DAY3, both)]:
        run_all(spark, lake, as_of, raw_path=path)
    spans = lake.bronze.read_history(spark).where("customer_id = 2").orderBy("start_date").collect()
    assert [(r.start_date, r.end_date) for r in spans] == [
        (date(2024, 5, 1), date(2024, 5, 2)), (date(2024, 5, 3), date(9999, 12, 31)),
    ]
    stamps = {r.id_cliente: r.data_atualizacao for r in lake.silver.read(spark).collect()}
    assert stamps == {1: "2024-05-01 09:00:00", 2: "2024-05-03 09:00:00"}


def test_a_change_that_cleaning_hides_moves_bronze_but_not_silver(spark, lake, drop):
    lower, upper = list(customer(1)), list(customer(1))
    upper[6] = "RJ"
    run_all(spark, lake, DAY1, raw_path=drop("1", tuple(lower)))
    run_all(spark, lake, DAY2, raw_path=drop("2", tuple(upper)))
    assert lake.bronze.read_history(spark).count() == 2
    assert [r.data_atualizacao for r in lake.silver.read(spark).collect()] == ["2024-05-01 09:00:00"]


def test_repeating_a_batch_gives_the_same_state(spark, lake, drop):
    first, second = drop("1", customer(1), customer(2)), drop("2", customer(1, city="Natal"), customer(3))
    run_all(spark, lake, DAY1, batch=0, raw_path=first)
    states = []
    for _ in range(2):
        run_all(spark, lake, DAY2, batch=1, raw_path=second)
        states.append(Counter(map(tuple, lake.bronze.read_history(spark).collect())))
        states.append(Counter(map(tuple, lake.silver.read(spark).collect())))
    assert states[0] == states[2] and states[1] == states[3]


def test_a_batch_others_build_on_cannot_be_rewritten(spark, lake, drop):
    path = drop("1", customer(1))
    run_bronze(spark, lake, DAY1, raw_path=path)
    run_bronze(spark, lake, DAY2, raw_path=path)
    with pytest.raises(ValueError, match="builds on it"):
        run_bronze(spark, lake, DAY3, batch=0, raw_path=path)


def test_running_a_layer_again_is_a_no_op(spark, lake, drop):
    path = drop("1", customer(1), customer(2))
    for as_of in (DAY1, DAY2):
        run_bronze(spark, lake, as_of, raw_path=path)
        run_silver(spark, lake, as_of)
    assert lake.bronze.read_history(spark).count() == 2
    assert {r.data_atualizacao for r in lake.silver.read(spark).collect()} == {"2024-05-01 09:00:00"}


def test_a_failed_key_check_publishes_nothing(spark, lake, drop):
    run_bronze(spark, lake, DAY1, raw_path=drop("1", customer(1)))
    with pytest.raises(KeyContractError):
        run_bronze(spark, lake, DAY2, raw_path=drop("2", customer(1), customer(1)))
    assert lake.bronze.latest(spark) == 0


def test_a_job_that_dies_while_writing_leaves_the_last_state(spark, lake, tmp_path, drop):
    run_all(spark, lake, DAY1, raw_path=drop("1", customer(1), customer(2)))
    good, bad = drop("2", customer(1, city="Natal"), customer(3)), str(tmp_path / "bad")
    flag = F.when(F.col("customer_id") == 3, "Ativo").otherwise("true")
    spark.read.parquet(good).withColumn("is_active", flag).write.parquet(bad)
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        run_bronze(spark, lake, DAY2, raw_path=bad)
    assert lake.bronze.latest(spark) == 0 and lake.bronze.read_history(spark).count() == 2
    run_all(spark, lake, DAY2, raw_path=good)
    assert lake.bronze.batches(spark) == {0: lake.buckets, 1: lake.buckets}
    assert lake.bronze.read_history(spark).count() == 4
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lakehist_")]


def test_the_layout_is_what_was_asked_for_or_what_there_is(spark, tmp_path, drop):
    path = drop("1", *[customer(n) for n in range(50)])
    base = str(tmp_path / "lake")
    for n, (asked, expected) in enumerate([(None, 0), (3, 3), (None, 3), (0, 0), (None, 0)]):
        lake = Lake(base, buckets=asked)
        run_all(spark, lake, DAY1, raw_path=path)
        assert lake.bronze.batches(spark)[n] == lake.silver.batches(spark)[n] == expected
    assert lake.bronze.read_history(spark).count() == lake.silver.read(spark).count() == 50
    assert {r.data_atualizacao for r in lake.silver.read(spark).collect()} == {DAY1.audit_text}


def test_the_layout_is_the_same_on_any_number_of_cores(tmp_path, drop):
    raw = drop("1", *[customer(n) for n in range(20)])
    script = Path(__file__).resolve().parent.parent / "jobs.py"
    layouts = []
    for cores in (2, 4):
        command = [sys.executable, str(script), "all", "--base", str(tmp_path / f"lake{cores}"), "--raw", raw, "--as-of", "2024-05-01"]
        options = f"--master local[{cores}] --conf spark.ui.enabled=false --conf spark.sql.warehouse.dir={tmp_path}/warehouse pyspark-shell"
        done = subprocess.run(command, env={**os.environ, "PYSPARK_SUBMIT_ARGS": options}, cwd=tmp_path, capture_output=True)
        assert done.returncode == 0, done.stderr[-2000:]
        layouts.append(sorted(p.name for p in tmp_path.glob(f"lake{cores}/*/*/_published/[0-9]*")))
    assert layouts[0] == layouts[1] == ["0-0-0"] * 3


def test_a_failing_repeat_leaves_every_layer_as_it_was(spark, lake, tmp_path, drop):
    run_all(spark, lake, DAY1, raw_path=drop("1", customer(1), customer(2)))
    run_all(spark, lake, DAY2, raw_path=drop("2", customer(1, city="Natal")))

    def state():
        frames = (lake.bronze.read_history(spark), lake.silver.read(spark), lake.gold.read(spark))
        return [Counter(map(tuple, frame.collect())) for frame in frames]

    before, bad = state(), str(tmp_path / "bad")
    rows = spark.read.parquet(drop("3", customer(1), customer(3)))
    rows.withColumn("is_active", F.when(F.col("customer_id") == 3, "Ativo").otherwise("true")).write.parquet(bad)
    for _ in range(2):
        with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
            run_bronze(spark, lake, DAY2, batch=1, raw_path=bad)
        assert lake.bronze.latest(spark) == 1 and state() == before
    run_all(spark, lake, DAY2, batch=1, raw_path=drop("4", customer(1, city="Natal")))
    assert state() == before


def test_a_clock_behind_the_history_or_of_another_zone_is_refused(spark, lake, drop):
    path, other = drop("1", customer(1)), drop("2", customer(1, city="Natal"))
    run_bronze(spark, lake, DAY2, raw_path=path)
    with pytest.raises(PySparkException, match="starts later"):
        run_bronze(spark, lake, DAY1, raw_path=other)
    assert lake.bronze.latest(spark) == 0
    with pytest.raises(ValueError, match="Asia/Tokyo"):
        run_bronze(spark, lake, AsOf.at("2024-05-03", "Asia/Tokyo"), raw_path=other)


def test_gold_keeps_a_column_that_the_rules_drop(spark, lake, drop):
    run_all(spark, lake, DAY1, raw_path=drop("1", customer(1)))
    fewer = replace(lake.entity, gold_columns=tuple(c for c in lake.entity.gold_columns if c != "cidade"))
    run_gold(spark, replace(lake, entity=fewer), DAY2)
    assert lake.gold.read(spark).columns == lake.gold.read(spark, 0).columns
    assert lake.gold.read(spark).first().cidade is None
    other = replace(fewer, attributes=lambda as_of: {"cidade": F.lit(1)})
    with pytest.raises(ValueError, match="cidade"):
        run_gold(spark, replace(lake, entity=other), DAY3)


def test_null_keys_may_be_kept(spark, tmp_path, drop):
    path = drop("1", customer(1))
    broken = str(tmp_path / "broken")
    spark.read.parquet(path).withColumn("customer_id", F.lit(None).cast("long")).write.parquet(broken)
    with pytest.raises(KeyContractError):
        run_bronze(spark, Lake(str(tmp_path / "strict")), DAY1, raw_path=broken)
    keeping = Lake(str(tmp_path / "keeping"), null_keys=True)
    for as_of in (DAY1, DAY2):
        run_all(spark, keeping, as_of, raw_path=broken)
    assert keeping.bronze.read_history(spark).count() == 2
    assert [r.data_atualizacao for r in keeping.silver.read(spark).collect()] == ["2024-05-02 09:00:00"]
    with pytest.raises(ValueError, match="one bucket"):
        Lake("x", buckets=4, null_keys=True)


def test_missing_sources_fail_the_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(AnalysisException):
        run_bronze(spark, lake, DAY1)
    for job in (run_silver, run_gold, run_ranking):
        with pytest.raises(FileNotFoundError):
            job(spark, lake, DAY1)


def test_sinks_receive_what_was_stored(spark, tmp_path, drop):
    served = {name: str(tmp_path / "served" / name) for name in ("gold", "ranking")}
    lake = Lake(
        str(tmp_path / "lake"),
        gold_sinks=(SinkSpec("parquet", path=served["gold"]),),
        ranking_sinks=(SinkSpec("json", path=served["ranking"]),),
    )
    rows = [customer(1, spent=20000.0), customer(2, spent=None), customer(3, active=False)]
    run_all(spark, lake, DAY1, raw_path=drop("1", *rows))
    gold = spark.read.parquet(served["gold"])
    assert Counter(map(tuple, gold.collect())) == Counter(map(tuple, lake.gold.read(spark).collect()))
    assert {r.id_cliente: r.nivel_cliente for r in gold.collect()} == {1: "Ouro", 2: "Novo", 3: "Novo"}
    ranking = spark.read.json(served["ranking"])
    assert Counter((r.categoria, r.id_cliente) for r in ranking.collect()) == Counter([
        ("Melhores clientes", 1), ("Melhores clientes", 2),
        ("Clientes a serem trabalhados", 1), ("Clientes a serem trabalhados", 2),
    ])
    assert {r.data_hora_analise for r in ranking.collect()} == {"2024-05-01 09:00:00"}


def test_only_the_states_to_keep_stay_on_storage(spark, lake, drop):
    lake = replace(lake, keep=2)
    for n, as_of in enumerate((DAY1, DAY2, DAY3)):
        path = drop(str(n), customer(1, city=f"c{n}"), customer(2))
        run_all(spark, lake, as_of, raw_path=path)
    assert lake.bronze.read_history(spark).count() == 4
    assert list(lake.silver.batches(spark)) == list(lake.gold.batches(spark)) == [1, 2]
    run_all(spark, lake, DAY3, batch=2, raw_path=path)
    assert lake.bronze.read_history(spark).count() == 4
    with pytest.raises(ValueError, match="at least 2"):
        replace(lake, keep=1)


def test_text_flags_are_read_as_booleans(spark, tmp_path, drop):
    path = str(tmp_path / "text")
    spark.read.parquet(drop("1", customer(1), customer(2, active=False))).withColumn(
        "is_active", F.col("is_active").cast("string")
    ).write.parquet(path)
    lake = Lake(str(tmp_path / "lake"))
    run_all(spark, lake, DAY1, raw_path=path)
    assert {r.id_cliente for r in run_ranking(spark, lake, DAY1).collect()} == {1}


def test_jobs_leave_the_session_settings_alone(spark, lake, drop):
    names = ("spark.sql.session.timeZone", "spark.sql.maxConcurrentOutputFileWriters")
    before = [spark.conf.get(n, None) for n in names]
    run_all(spark, lake, DAY1, raw_path=drop("1", customer(1)))
    assert [spark.conf.get(n, None) for n in names] == before


def test_an_existing_history_can_seed_a_lake(spark, tmp_path, lake, drop):
    other = Lake(str(tmp_path / "other"))
    for as_of, rows in [(DAY1, [customer(1), customer(2)]), (DAY2, [customer(1)])]:
        run_bronze(spark, other, as_of, raw_path=drop(as_of.audit_text, *rows))
    lake.bronze.write(other.bronze.read_history(spark), 0)
    run_bronze(spark, lake, DAY3, raw_path=drop("3", customer(1, city="Natal")))
    assert lake.bronze.read_history(spark).count() == 3


def test_command_line_runs_each_layer(spark, tmp_path, drop):
    base, raw = str(tmp_path / "lake"), drop("1", customer(1), customer(2))
    common = ["--base", base, "--as-of", "2024-05-01 09:00:00"]
    cli.main(["bronze", *common, "--raw", raw, "--buckets", "2"], spark)
    cli.main(["silver", *common, "--buckets", "2"], spark)
    cli.main(
        ["gold", *common, "--gold-sink", "csv", "--gold-path", f"{base}/served", "--gold-option", "header=true",
         "--ranking-sink", "parquet", "--ranking-path", f"{base}/ranking"],
        spark,
    )
    assert spark.read.csv(f"{base}/served", header=True).count() == 2
    assert spark.read.parquet(f"{base}/ranking").count() == 4
    cli.main(["all", *common, "--raw", raw], spark)
    assert Lake(base).bronze.batches(spark) == {0: 2, 1: 2}  # the count in use is kept
    assert Path(base, "gold").exists()
    with pytest.raises(SystemExit):
        cli.main(["bronze"], spark)


def test_a_missing_source_fails_the_process(tmp_path):
    script = Path(__file__).resolve().parent.parent / "jobs.py"
    command = [sys.executable, str(script), "bronze", "--base", str(tmp_path / "lake")]
    options = "--master local[1] --conf spark.ui.enabled=false pyspark-shell"
    done = subprocess.run(command, env={**os.environ, "PYSPARK_SUBMIT_ARGS": options}, cwd=tmp_path, capture_output=True)
    assert done.returncode != 0 and b"PATH_NOT_FOUND" in done.stderr
