"""Ingest, snapshot partitions, layer runs and streaming on small files."""

import datetime as dt
import itertools
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality
from ledgerline.plans import layers
from ledgerline.session import shared_dir
from ledgerline.sources import files
from ledgerline.sources.views import FEATURES
from ledgerline.streaming.snapshots import stream_snapshots


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_bronze(spark, tmp_path):
    path = tmp_path / "loans.csv"
    path.write_text("id,day\n1,2024-02-01\n2,3/02/2024\n3,soon\n")
    out = files.ingest_bronze(spark, str(path), "id int, day string", "loans", ["day", "absent"]).orderBy("id").collect()
    assert [r.day for r in out] == [dt.date(2024, 2, 1), dt.date(2024, 2, 3), None]
    assert {r.bronze_source_file for r in out} == {"loans.csv"} and all(r.bronze_ingest_timestamp for r in out)
    by_row = files.add_ingest_metadata(files.read_bronze_csv(spark, str(path), "id int, day string"))
    assert {r.bronze_source_file for r in by_row.collect()} == {"loans.csv"}
    empty = tmp_path / "empty.csv"
    empty.write_text("id,day\n")
    with pytest.raises(files.EmptySourceError):
        files.ingest_bronze(spark, str(empty), "id int, day string", "empty")


def test_rerun_replaces_only_its_snapshot(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    day = dt.date
    first = [(day(2024, 1, 1), 1), (day(2024, 1, 1), 2), (day(2024, 2, 1), 3)]
    df = spark.createDataFrame(first, "snapshot_date date, loan_id int")
    files.ingest_snapshots(df, path)
    changed = spark.createDataFrame([(day(2024, 2, 1), 30), (day(2024, 3, 1), 99)], "snapshot_date date, loan_id int")
    for _ in range(2):
        files.ingest_snapshot(changed, day(2024, 2, 1), path)
    got = {(r.snapshot_date, r.loan_id) for r in files.read_partitions(spark, path).collect()}
    assert got == {(day(2024, 1, 1), 1), (day(2024, 1, 1), 2), (day(2024, 2, 1), 30)}
    assert files.read_partitions(spark, path).count() == 3
    one = files.read_partitions(spark, path).where(F.col("snapshot_date") == "2024-02-01")
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()


def test_month_starts(spark):
    got = [r.snapshot_date for r in files.month_starts(spark, dt.date(2023, 11, 15), dt.date(2024, 2, 1)).collect()]
    assert got == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_prediction_file(spark, tmp_path):
    path = str(tmp_path / "out")
    files.write_predictions(spark.createDataFrame([(1, 0.123456), (2, 3.0)], "row_id int, meter_reading double"), path)
    lines = sorted(line for part in (tmp_path / "out").glob("*.csv") for line in part.read_text().splitlines() if "row_id" not in line)
    assert lines == ["1,0.1235", "2,3.0000"]


def test_named_tables(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    assert files.load_named(spark, {"t": path}, "t").count() == 3
    with pytest.raises(KeyError):
        files.load_named(spark, {"t": path}, "u")


def test_stream_takes_every_file_once(spark, tmp_path):
    landing, target, marks = (str(tmp_path / n) for n in ("landing", "target", "marks"))
    (tmp_path / "landing").mkdir()
    for n in (1, 2, 3):
        (tmp_path / "landing" / f"{n}.csv").write_text(f"snapshot_date,loan_id\n2024-0{n}-01,{n}\n2024-01-01,{n}0\n")
        for _ in range(2):  # the second run finds nothing new
            stream_snapshots(spark, landing, "snapshot_date date, loan_id int", target, marks).awaitTermination()
    rows = files.read_partitions(spark, target)
    assert sorted(r.loan_id for r in rows.collect()) == [1, 2, 3, 10, 20, 30]
    assert rows.where("snapshot_date = '2024-01-01'").count() == 4


def write_sources(root):
    root.mkdir()
    loans = ["loan_id,customer_id,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"]
    for customer, paid in (("a", [0, 100, 100]), ("b", [0, 0, 0, 0, 0])):
        for i, amount in enumerate(paid):
            overdue = 0 if customer == "a" else 100 * i
            loans.append(f"L{customer},{customer},2024-01-01,10,{i},1000,100,{amount},{overdue},{1000 - sum(paid[: i + 1])},2024-0{i + 1}-01")
    (root / "loan_daily.csv").write_text("\n".join(loans) + "\n")
    (root / "attributes.csv").write_text(
        "customer_id,name,age,ssn,occupation,snapshot_date\na,Ann,34_,123-45-6789,_______,2024-01-01\nb,Bob,-5,bad, media_manager ,1/02/2024\nc,Cy,50,111-11-1111,Teacher,2024-01-01\n"
    )
    names = [part.split()[0] for part in layers.SCHEMAS["financials"].split(", ")]
    base = {n: "" for n in names} | {
        "monthly_inhand_salary": "10.5", "num_bank_accounts": "2", "num_credit_card": "1", "interest_rate": "5", "delay_from_due_date": "3",
        "num_credit_inquiries": "1", "credit_utilization_ratio": "30.5", "total_emi_per_month": "4", "payment_of_min_amount": "Yes",
    }
    rows = [
        base | {"customer_id": "a", "annual_income": "$90000_", "outstanding_debt": "100_", "credit_mix": "Good", "credit_history_age": "22 Years and 1 Months"},
        base | {"customer_id": "b", "annual_income": "1.2.3", "outstanding_debt": "900", "credit_mix": "Bad", "payment_behaviour": "High_spent_Large_value_payments"},
    ]
    (root / "financials.csv").write_text("\n".join([",".join(names)] + [",".join(r[n] for n in names) for r in rows]) + "\n")
    clicks = [",".join([*FEATURES, "customer_id", "snapshot_date"])]
    clicks += [",".join([str(i + k) for k in range(20)] + ["a", f"2024-0{i}-01"]) for i in (1, 2)]
    (root / "clickstream.csv").write_text("\n".join(clicks) + "\n")


def test_whole_run(spark, tmp_path):
    source, root = tmp_path / "raw", str(tmp_path / "lake")
    write_sources(source)
    layers.run(spark, root, str(source))
    gold = {r.customer_id: r for r in files.read_layer(spark, root, "gold", "features").collect()}
    assert sorted(gold) == ["a", "b", "c"]
    assert (gold["a"].has_defaulted, gold["b"].has_defaulted, gold["c"].has_defaulted) == (False, True, None)
    assert (gold["a"].has_clickstream_data, gold["b"].has_clickstream_data) == (True, False)
    assert (gold["b"].max_missed_payments, gold["b"].num_defaulted_loans) == (4, 2)
    assert gold["c"].default_risk_score is None and gold["b"].age is None and gold["b"].record_count == 0
    assert gold["b"].default_risk_score == 50 + 10 + 6 + 0 + 10 + 5 + 3 + 2 + 0 + 0 + 1
    labels = files.read_layer(spark, root, "gold", "labels")
    assert labels.columns[:4] == ["customer_id", "has_defaulted", "default_risk_score", "has_clickstream_data"]
    detail = files.read_layer(spark, root, "silver", "clickstream").orderBy("snapshot_date").collect()
    assert [(r.row_num_by_customer, r.months_since_first) for r in detail] == [(1, 0), (2, 1)]
    layers.run(spark, root, str(source), "silver", "attributes")
    with pytest.raises(ValueError):
        layers.run(spark, root, str(source), "platinum")


def test_table_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    row = quality.table_summary("t", df, ["a", "b", "c"]).first()
    assert (row.source, row.row_count, row.missing_columns, row.null_counts) == ("t", 2, ["c"], {"b": 1}) and row.validation_timestamp


def test_quality_checks(spark):
    df = spark.createDataFrame([(1000.0, 1, 100.0, 0.0, 900.0), (1000.0, 2, 100.0, 50.0, 700.0)], "loan_amt double, installment_num int, due_amt double, overdue_amt double, balance double")
    counts = {r.matches: r.row_count for r in quality.match_counts(df, quality.expected_balance(), F.col("balance")).collect()}
    assert counts == {True: 1, False: 1}
    assert quality.mismatches(df, quality.expected_balance(), F.col("balance"), ["installment_num"], 5).first().expected == 850.0
    tables = {n: spark.createDataFrame([(k,) for k in keys], "id int") for n, keys in {"x": [1, 2, 2], "y": [2, 3], "z": [2, 3, 4]}.items()}
    got = {r.table: (r.unique_keys, r.in_all, r.missing_elsewhere) for r in quality.key_overlap(tables, "id").collect()}
    assert got == {"x": (2, 1, 1), "y": (2, 1, 1), "z": (3, 1, 2)}
    assert tuple(quality.key_changes(tables["x"], tables["y"], "id").first()) == (2, 2, 1, 1)
    assert sorted(r.id for r in quality.keep_listed(tables["z"], tables["y"], "id").collect()) == [2, 3]


def test_lost_snapshot_is_removed(spark, tmp_path):
    path = str(tmp_path / "snaps")
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 2, 1))], "id int, snapshot_date date")
    files.ingest_snapshots(rows, path)
    files.ingest_snapshot(rows.where("id = 2"), dt.date(2024, 1, 1), path)
    assert [r.id for r in files.read_partitions(spark, path).collect()] == [2]


def test_csv_with_columns_in_another_order_is_refused(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([(1, 2)], "b int, a int").coalesce(1).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="(?i)header|conform"):
        files.read_bronze_csv(spark, path, "a int, b int").collect()


def test_rows_that_do_not_fit_are_kept(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.createDataFrame([("1", "x"), ("oops", "y")], "a string, b string").coalesce(1).write.option("header", True).csv(path)
    got = {r.b: (r.a, r._corrupt_record) for r in files.read_bronze_csv(spark, path, files.with_corrupt("a int, b string")).collect()}
    assert got == {"x": (1, None), "y": (None, "oops,y")}


def test_date_window_prunes(spark, tmp_path):
    from ledgerline.operators.tables import date_window

    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(60)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, day date")
    df.withColumn("month", F.trunc("day", "month")).write.partitionBy("month").parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    window = date_window(stored, "month", dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert sorted(r.id for r in window.collect()) == list(range(31, 60))
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    inner = date_window(stored, "day", dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert sorted(r.id for r in inner.collect()) == [4, 5]
    assert "GreaterThanOrEqual(day" in inner._jdf.queryExecution().executedPlan().toString()
    timed = df.withColumn("at", F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS"))
    assert sorted(r.id for r in date_window(timed, "at", dt.date(2024, 1, 5), dt.date(2024, 1, 6)).collect()) == [4, 5]


def test_backfill_leaves_unchanged_months_alone(spark, tmp_path):
    from ledgerline.plans import layers

    names = [c.split()[0] for c in layers.SCHEMAS["loan_daily"].split(", ")]
    day = {"loan_start_date": "2023-01-05", "tenure": "10", "loan_amt": "100", "due_amt": "10", "paid_amt": "10", "overdue_amt": "0", "balance": "5"}

    def write(path, rows):
        made = [tuple({**day, "loan_id": f"L{i}", "customer_id": f"c{i}", "installment_num": "6", "snapshot_date": d, **more}[c] for c in names) for i, d, more in rows]
        spark.createDataFrame(made, ", ".join(f"{c} string" for c in names)).write.mode("overwrite").option("header", True).csv(path)
        return path

    rows = [(i, f"2023-0{1 + i % 3}-11", {}) for i in range(12)]
    source = write(f"{tmp_path}/a.csv", rows)

    def files_of():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "lake").rglob("part-*")}

    store = layers.backfill_labels(spark, f"{tmp_path}/lake", source)
    first = files_of()
    layers.backfill_labels(spark, f"{tmp_path}/lake", source)
    layers.backfill_labels(spark, f"{tmp_path}/lake", write(f"{tmp_path}/b.csv", rows[::-1]))  # the order of rows changes nothing
    assert files_of() == first
    rows[4] = (4, rows[4][1], {"overdue_amt": "40"})
    layers.backfill_labels(spark, f"{tmp_path}/lake", write(f"{tmp_path}/c.csv", rows))
    second = files_of()
    new = {p for p in second if p not in first and "manifest" not in p}
    assert new and all("snapshot_month=2023-02-01" in p for p in new)
    assert {r.snapshot_month for r in spark.read.parquet(store).collect()} == {dt.date(2023, k, 1) for k in (1, 2, 3)}
    layers.backfill_labels(spark, f"{tmp_path}/lake", write(f"{tmp_path}/d.csv", [r for r in rows if "-03-" not in r[1]]))
    assert {r.snapshot_month for r in spark.read.parquet(store).collect()} == {dt.date(2023, k, 1) for k in (1, 2)}
    third = files_of()
    layers.backfill_labels(spark, f"{tmp_path}/lake", f"{tmp_path}/c.csv", [dt.date(2023, 1, 1)])  # asked for: made in any case
    made = {p for p in files_of() if p not in third and "manifest" not in p}
    assert made and all("snapshot_month=2023-01-01" in p for p in made)


def test_run_summary_is_one_document(spark, tmp_path):
    from ledgerline.operators import quality

    a = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    tables = {"b": (a, ["k", "v", "w"]), "a": (a.limit(0), ["k"])}
    quality.write_run_summary(quality.run_summary(tables, 2.0), f"{tmp_path}/s")
    row = quality.read_run_summary(spark, f"{tmp_path}/s").first()
    assert (row.pipeline_run.tables_processed, row.pipeline_run.total_rows_processed, row.pipeline_run.runtime_seconds) == (2, 2, 2.0)
    assert [(t.source, t.row_count, t.missing_columns, t.null_counts) for t in row.table_summaries] == [("a", 0, [], {}), ("b", 2, ["w"], {"v": 1})]


def test_rows_that_lie_by_month_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    hints, kind = [], type(spark.range(1))
    plain = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, *a: hints.append(a[0]) or plain(df, *a))
    rows = spark.createDataFrame([(i, dt.date(2023, 1 + i % 3, 1)) for i in range(30)], "id int, snapshot_date date")
    first = files.ingest_snapshots(rows, f"{tmp_path}/a")
    assert hints == ["rebalance"]
    second = files.ingest_snapshots(files.read_partitions(spark, first), f"{tmp_path}/b", laid_out=True)
    assert hints == ["rebalance"]
    assert sorted(map(tuple, files.read_partitions(spark, second).collect())) == sorted(map(tuple, rows.collect()))


def test_snapshots_leave_no_shuffle_files(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.length())) if n.startswith("shuffle_")}

    keys = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters")
    before, settings = shuffled(), [spark.conf.get(k) for k in keys]
    rows = spark.range(3000).select("id", F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 3).cast("int")).alias("snapshot_date"))
    files.ingest_snapshots(rows, f"{tmp_path}/a")
    until = time.time() + 5  # they are removed in the background
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert files.read_partitions(spark, f"{tmp_path}/a").count() == 3000
    assert [spark.conf.get(k) for k in keys] == settings


def test_more_snapshots_than_a_task_keeps_open(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 1).select("id", F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") % 130).cast("int")).alias("snapshot_date"))
    files.ingest_snapshots(rows, f"{tmp_path}/a", laid_out=True)
    assert sorted(map(tuple, files.read_partitions(spark, f"{tmp_path}/a").collect())) == sorted(map(tuple, rows.collect()))


def test_backfill_manifest_stages_the_ledger_once_and_reads_whole_ledgers(spark, tmp_path, monkeypatch):
    from checks import storage

    names = [c.split()[0] for c in layers.SCHEMAS["loan_daily"].split(", ")]
    days = [dt.date(1997, 1 + i % 4, 1 + i % 28) if i % 50 else None for i in range(4000)]
    made = [(i, i % 700, dt.date(1996, 12, 5), 10, 6, *((i * k) % 99991 / 100 for k in (7, 11, 13, 17, 19)), days[i]) for i in range(4000)]
    kinds = ("bigint", "bigint", "date", "int", "int", *["double"] * 5, "date")
    ledger = spark.createDataFrame(made, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
    for view in ("ledger", "attributes", "financials", "clicks"):
        monkeypatch.setattr(storage.views, view, lambda *_: ledger)
    numbers = itertools.count()
    monkeypatch.setattr(storage, "stage_path", lambda _, name: f"{tmp_path}/{name}-{next(numbers)}")
    read, plain = [], layers.backfill_labels

    def backfill(spark, root, path):
        read.append(sorted(map(str, map(tuple, spark.read.option("header", True).csv(path).select("loan_id", "paid_amt", "snapshot_date").collect()))))
        return plain(spark, root, path)

    monkeypatch.setattr(storage.layers, "backfill_labels", backfill)
    told = sorted(map(tuple, storage.backfill_manifest(spark, "").collect()))
    # Rows without a day are a month of their own, which the last ledger doesn't have either.
    assert told == [(1, 5, 5), (2, 0, 5), (3, 1, 5), (4, 2, 3)]
    paid = names.index("paid_amt")

    def rows(keep=lambda day: True, february=None):
        of_day = lambda d: february if february and d and d.month == 2 else None
        return sorted(str((str(r[0]), of_day(r[-1]) or str(r[paid]), r[-1] and str(r[-1]))) for r in made if keep(r[-1]))

    assert read == [rows(), rows(), rows(february="0.5"), rows(lambda d: d is not None and d.month != 2)]
    staged = sum(p.stat().st_size for p in tmp_path.rglob("*.csv*") if p.is_file() and not p.name.startswith("."))
    once = f"{tmp_path}/once"
    ledger.write.option("header", True).csv(once)
    assert staged < sum(p.stat().st_size for p in (tmp_path / "once").glob("*.csv"))
