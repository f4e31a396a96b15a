"""Tables survive whatever stops a write to them."""

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martloom.operators.quality import FAIL, Expectation, enforce
from martloom.plans import audits
from martloom.plans.model import RetailModel
from martloom.plans.publish import CONFORMED, MARTS, gate, publish, publish_to_catalog, release, stored_counts
from martloom.plans.rules import RULES
from martloom.session import scratch_dir
from martloom.sources import store
from martloom.sources.ingest import EmptySourceError, folder_headers, load_table, read_folder, save_table, write_table
from martloom.sources.schemas import FileSource
from martloom.sources.star import raw_tables
from tests.plans import plan_text

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def target(spark):
    return f"{scratch_dir(spark, 'store')}/table"


def ids(spark, target):
    return sorted(r.id for r in spark.read.parquet(target).collect())


def neighbours(spark, target):
    files = store._Files(spark, target)
    return sorted(s.getPath().getName() for s in files.fs.listStatus(files.target.getParent()))


def breaking(df):
    return enforce(df, [Expectation("small", "id < 90", FAIL)])


def test_a_failed_write_leaves_the_old_rows(spark, target):
    write_table(spark.range(3), target)
    with pytest.raises(PySparkException, match="small"):
        write_table(breaking(spark.range(0, 100, 1, 10)), target)
    assert ids(spark, target) == [0, 1, 2]
    assert neighbours(spark, target) == ["table"]


def test_a_failed_audit_leaves_the_old_rows(spark, target):
    write_table(spark.range(3), target)

    def audit(staged):
        raise store.AuditError(str(staged.count()))

    with pytest.raises(store.AuditError, match="7"):
        write_table(spark.range(7), target, audits=(audit,))
    assert ids(spark, target) == [0, 1, 2] and neighbours(spark, target) == ["table"]


def test_a_failed_first_write_leaves_nothing(spark, target):
    with pytest.raises(PySparkException):
        write_table(breaking(spark.range(100)), target)
    assert neighbours(spark, target) == []


def test_a_table_may_be_replaced_by_what_it_holds(spark, target):
    write_table(spark.range(10), target)
    for _ in range(2):
        write_table(spark.read.parquet(target).filter("id % 2 = 0").withColumn("id", F.col("id") / 2).select(F.col("id").cast("bigint")), target)
    assert ids(spark, target) == [0, 1, 2]


def test_an_interrupted_swap_is_undone(spark, target):
    write_table(spark.range(4), target)
    files = store._Files(spark, target)
    files.move(files.target, files.beside("replaced"))
    write_table_later = store.open_folder(spark, target)
    assert sorted(r.id for r in write_table_later.collect()) == [0, 1, 2, 3]
    files.move(files.target, files.beside("replaced"))
    with pytest.raises(PySparkException):
        write_table(breaking(spark.range(100)), target)
    assert ids(spark, target) == [0, 1, 2, 3]


def test_a_swap_that_fails_goes_back(spark, target, monkeypatch):
    write_table(spark.range(4), target)
    move, calls = store._Files.move, []

    def failing(self, source, to):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("lost")
        move(self, source, to)

    monkeypatch.setattr(store._Files, "move", failing)
    with pytest.raises(OSError, match="lost"):
        write_table(spark.range(9), target)
    assert ids(spark, target) == [0, 1, 2, 3] and neighbours(spark, target) == ["table"]


def test_names_that_look_alike_are_told_apart(spark, target):
    write_table(spark.range(1), target)
    write_table(spark.range(2), f"{target}-2")
    files = store._Files(spark, f"{target}-2")
    files.move(files.target, files.beside("replaced"))
    store._Files(spark, target).recover()
    write_table(spark.range(5), target)
    store._Files(spark, f"{target}-2").recover()
    assert ids(spark, f"{target}-2") == [0, 1]


def test_partitions_and_other_formats(spark, target):
    rows = spark.range(6).withColumn("k", F.col("id") % 2)
    write_table(rows, target, partition_by=("k",))
    write_table(rows.filter("id > 1"), target, partition_by=("k",))
    assert ids(spark, target) == [2, 3, 4, 5]
    write_table(rows, f"{target}-json", fmt="json")
    assert spark.read.json(f"{target}-json").count() == 6


def test_append_joins_only_when_audited(spark, target):
    write_table(spark.range(2), target)

    def audit(staged):
        assert staged.count() == 1

    write_table(spark.range(5, 6), target, mode="append", audits=(audit,))
    with pytest.raises(AssertionError):
        write_table(spark.range(5), target, mode="append", audits=(audit,))
    assert ids(spark, target) == [0, 1, 5]


def test_catalog_tables(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    save_table(spark.range(3), name, bucket_by=(2, "id"))
    with pytest.raises(PySparkException, match="small"):
        save_table(breaking(spark.range(100)), name, bucket_by=(2, "id"))
    assert spark.table(name).count() == 3
    save_table(spark.table(name).filter("id > 0"), name, bucket_by=(2, "id"))
    assert spark.table(name).count() == 2
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Num Buckets"] == "2"
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__replaced_{uuid.uuid4().hex}")
    store.recover_table(spark, name)
    assert spark.table(name).count() == 2


# --- ingest through it


def landed(spark, text):
    folder = scratch_dir(spark, "landing")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(folder)
    return folder


def test_a_load_that_fails_keeps_the_table(spark, target):
    schema = "id bigint, n int"
    load_table(spark, FileSource(landed(spark, "id,n\n1,1\n2,2"), "t", schema), target)
    with pytest.raises(EmptySourceError):
        load_table(spark, FileSource(landed(spark, "id,n"), "t", schema), target)
    assert ids(spark, target) == [1, 2]
    report = load_table(spark, FileSource(landed(spark, "id,n\n7,1\n8,-2"), "t", schema, dq_rules={"n": "n > 0"}), target)
    assert (report.rows_read, report.violations, ids(spark, target)) == (2, {"n": 1}, [7])


# --- folders of unlike files


def test_unlike_files_meet_by_header(spark):
    folder = scratch_dir(spark, "unlike")
    for name, text in {
        "a/one.csv": "id,name\n1,x\n2,y",
        "a/deep/er/two.csv": "name,id\nz,3",
        "three.csv": 'id,"a b",body\n4,q,"two\nlines"',
        "only_header.csv": "id,late",
        "ignored.txt": "id\n9",
    }.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{folder}/empty.csv")
    headers = folder_headers(spark, folder, "*.txt")
    assert set(headers) == {("id", "name"), ("name", "id"), ("id", "a b", "body"), ("id", "late"), ("id",)}
    rows = read_folder(
        spark, folder, "*.txt", lineage=True, options_for=lambda h: {"multiLine": True, "quote": '"', "escape": '"'} if "body" in h else {}
    )
    assert set(rows.columns) == {"id", "name", "a b", "body", "late", "source_file"}
    found = {r["id"]: (r["name"], r["a b"], r["body"]) for r in rows.filter("source_file NOT LIKE '%ignored%'").collect()}
    assert found == {"1": ("x", None, None), "2": ("y", None, None), "3": ("z", None, None), "4": (None, "q", "two\nlines")}


def test_folder_errors(spark):
    folder = scratch_dir(spark, "unlike")
    spark.createDataFrame([("id,ID\n1,2",)], "value string").coalesce(1).write.text(folder)
    with pytest.raises(ValueError, match="repeats"):
        read_folder(spark, folder, "*.txt")
    with pytest.raises(EmptySourceError):
        read_folder(spark, folder, "*.csv")


# --- published tables


@pytest.fixture(scope="module")
def published_model(spark):
    model, target = RetailModel(raw_tables(spark, SF_DIR)), scratch_dir(spark, "published")
    return model, target, publish(model, target)


def test_counts_of_publishing_are_those_of_the_report(spark, published_model):
    from martloom.plans.catalog import QUERIES

    _, _, reports = published_model
    counted = {(r.table, rule.name): (r.rows_seen - r.violations[rule.name], r.violations[rule.name]) for r in reports for rule in RULES.get(r.table, ())}
    listed = QUERIES["dq_report"](RetailModel(raw_tables(spark, SF_DIR))).collect()
    assert counted == {(r.table_name, r.rule_name): (r.passed, r.violations) for r in listed}
    assert len(counted) == 35
    dropped = {name for (name, rule), (_, bad) in counted.items() if bad}
    assert {"payments_clean", "geo_zip_prefix"} <= dropped


def test_counts_come_from_footers(spark, published_model):
    _, target, reports = published_model
    counts = stored_counts(spark, target)
    text = plan_text(counts)
    assert text.count("PushedAggregation: [COUNT(*)]") == len(CONFORMED + MARTS)
    assert {r.table_name: r.row_count for r in counts.collect()} == {r.table: r.rows for r in reports}


def test_gate_and_release(spark, monkeypatch):
    target = scratch_dir(spark, "release")
    tables = ("payments_clean", "payments_order_agg", "product_catalog", "order_items_revenue", "orders_revenue", "revenue_monthly")
    model = RetailModel(raw_tables(spark, SF_DIR))
    release(model, target, tables)
    before = spark.read.parquet(f"{target}/current/revenue_monthly").collect()
    broken = audits.invariants

    def failing(*tables):
        return broken(*tables).withColumn("status", F.when(F.col("check_name") == "no_negative_payments", "FAIL").otherwise(F.col("status")))

    monkeypatch.setattr(audits, "invariants", failing)
    with pytest.raises(PySparkException, match="invariant failed: no_negative_payments"):
        release(RetailModel(raw_tables(spark, SF_DIR)).sampled(0.5), target, tables)
    assert spark.read.parquet(f"{target}/current/revenue_monthly").collect() == before
    monkeypatch.undo()
    assert gate(model).count() == 8


def test_catalog_publish_survives_a_rule(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    tables = ("payments_clean", "payments_order_agg")
    publish_to_catalog(RetailModel(raw_tables(spark, SF_DIR)), "kept", buckets=4, tables=tables)
    before = spark.table("kept.payments_order_agg").count()
    model = RetailModel(raw_tables(spark, SF_DIR))
    model.payments_clean = model.payments_clean.withColumn("order_id", F.when(F.col("order_id") != "1", F.col("order_id")))
    with pytest.raises(PySparkException, match="order_id_not_null"):
        publish_to_catalog(model, "kept", buckets=4, tables=("payments_order_agg",))
    assert spark.table("kept.payments_order_agg").count() == before > 0
