"""Rules, audits and ingest."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation, functions as F

from martloom.operators.lookup import grain, orphans
from martloom.functions import as_money, money_sum
from martloom.operators.quality import DROP, FAIL, WARN, Expectation, as_drop_rules, enforce, observe, violation_report
from martloom.plans import audits
from martloom.plans.rules import RULES
from martloom.operators.sampling import sample_by_key
from martloom.session import scratch_dir
from martloom.sources.ingest import (
    EmptySourceError,
    load_table,
    read_folder,
    read_source,
    read_tables,
    save_table,
    write_csv,
    write_table,
)
from martloom.sources.schemas import FileSource, default_config, sources_from_config
from tests.plans import plan_text

ROWS = [(1, "a"), (-1, "b"), (None, "c"), (5, None)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "x int, k string")


def test_null_violates(rows):
    report = {r.rule_name: r for r in violation_report(rows, [Expectation("pos", "x >= 0"), Expectation("k", "k IS NOT NULL", DROP)], "t").collect()}
    assert (report["pos"].passed, report["pos"].violations, report["pos"].action) == (2, 2, "warn")
    assert (report["k"].passed, report["k"].violations) == (3, 1)


def test_drop_and_warn(rows):
    kept = enforce(rows, [Expectation("pos", "x >= 0", DROP), Expectation("k", "k IS NOT NULL", WARN)])
    assert sorted(r.x for r in kept.collect()) == [1, 5]


def test_no_rules_change_nothing(rows):
    assert enforce(rows, as_drop_rules({})).count() == 4


def test_fail_stops_even_when_a_drop_rule_covers_the_row(rows):
    rules = [Expectation("k", "k IS NOT NULL", DROP), Expectation("small", "x < 5 OR x IS NULL", FAIL)]
    with pytest.raises(PySparkException, match="expectation failed: small"):
        enforce(rows, rules).collect()


def test_fail_passes_clean_rows(rows):
    assert enforce(rows, [Expectation("k", "length(coalesce(k, 'x')) = 1", FAIL)]).count() == 4


def test_unknown_action():
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_observation_counts_in_the_same_pass(spark, rows):
    rules = [Expectation("pos", "x >= 0", DROP)]
    watch = Observation()
    write_table(enforce(observe(rows, rules, watch), rules), scratch_dir(spark, "observed"))
    assert watch.get == {"rows_seen": 4, "pos": 2}


def test_rule_counts_match_the_catalogue():
    actions = [r.action for rules in RULES.values() for r in rules]
    assert {a: actions.count(a) for a in (WARN, DROP, FAIL)} == {WARN: 14, DROP: 12, FAIL: 9}


def test_grain_and_orphans(spark, rows):
    (row,) = grain(rows.union(rows.limit(1)), ["x", "k"], "t").collect()
    assert row.row_count - row.unique_keys == 1 and row.repeated_keys == 1
    parents = spark.createDataFrame([("a",)], "k string")
    assert {r.k for r in orphans(rows, parents, "k").collect()} == {"b", "c", None}


def test_row_count_audit(spark):
    want = spark.createDataFrame([("a", 2), ("b", 1), ("gone", 1)], "table_name string, row_count bigint")
    have = spark.createDataFrame([("a", 2), ("b", 3)], "table_name string, row_count bigint")
    got = {r.table_name: (r.status, r.difference) for r in audits.row_count_audit(have, want).collect()}
    assert got == {"a": ("PASS", 0), "b": ("FAIL", 2), "gone": ("FAIL", None)}


def test_gate_raises_on_failure(spark):
    report = spark.createDataFrame([("one", "PASS"), ("two", "FAIL")], "check_name string, status string")
    assert audits.require_pass(report.filter("status = 'PASS'")).count() == 1
    with pytest.raises(PySparkException, match="invariant failed: two"):
        audits.require_pass(report).collect()


# --- ingest


def text_source(spark, name, text, **options):
    folder = scratch_dir(spark, "landing")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(folder)
    return FileSource(path=folder, table_name=name, **options)


def test_bad_values_become_null_and_rules_drop_them(spark):
    source = text_source(spark, "t", "id,n\na,1\nb,x\n,3", schema="id string, n int", dq_rules={"n": "n > 0", "id": "id IS NOT NULL"})
    frame = read_tables(spark, [source])["t"]
    assert [(r.id, r.n) for r in frame.collect()] == [("a", 1)]
    assert frame.columns[-1] == "ingestion_ts"


def test_multiline_text_with_quotes(spark):
    options = dict(schema="id string, body string", multiLine=True, quote='"', escape='"')
    source = text_source(spark, "t", 'id,body\n1,"first ""line""\nsecond, line"\n2,plain', **options)
    got = {r.id: r.body for r in read_source(spark, source).collect()}
    assert got == {"1": 'first "line"\nsecond, line', "2": "plain"}


def test_load_counts_once_and_writes(spark):
    source = text_source(spark, "t", "id,n\na,1\nb,\nc,0", schema="id string, n int", dq_rules={"n": "n > 0"})
    target = scratch_dir(spark, "bronze")
    report = load_table(spark, source, target, lineage=True)
    assert (report.rows_read, report.violations) == (3, {"n": 2})
    (row,) = spark.read.parquet(target).collect()
    assert row.id == "a" and "landing-" in row.source_file and row.ingestion_ts is not None


def test_empty_source_fails(spark):
    source = text_source(spark, "t", "id,n", schema="id string, n int")
    with pytest.raises(EmptySourceError):
        load_table(spark, source, scratch_dir(spark, "bronze"))


def test_empty_source_leaves_the_old_table(spark):
    target = scratch_dir(spark, "bronze")
    load_table(spark, text_source(spark, "t", "id,n\na,1\nb,2\nc,3", schema="id string, n int"), target)
    with pytest.raises(EmptySourceError):
        load_table(spark, text_source(spark, "t", "id,n", schema="id string, n int"), target)
    assert spark.read.parquet(target).count() == 3


def test_sample_of_a_small_fraction(spark):
    kept = sample_by_key(spark.range(1_000_000), "id", 0.00004).count()
    assert 20 <= kept <= 65


def test_malformed_amounts_are_missing_and_huge_ones_stop_the_job(spark):
    amounts = spark.createDataFrame([("NaN",), ("Infinity",), ("x",), ("5.0",)], "v string").select(as_money("v").alias("v"))
    assert [r.v for r in amounts.collect()] == [None, None, None, 5.0]
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.createDataFrame([(1e17,), (5.0,)], "v double").agg(money_sum("v")).collect()


def test_load_mode_append(spark):
    source = text_source(spark, "t", "id,n\na,1", schema="id string, n int", load_mode="append")
    target = scratch_dir(spark, "bronze")
    load_table(spark, source, target)
    load_table(spark, source, target)
    assert spark.read.parquet(target).count() == 2


def test_config_shape():
    config = json.loads(json.dumps(default_config("/landing/")))
    sources = {s.table_name: s for s in sources_from_config(config)}
    assert len(sources) == 9
    assert sources["raw_order_reviews"].reader_options()["multiLine"] == "true"
    assert sources["raw_orders"].reader_options()["timestampFormat"] == "yyyy-MM-dd HH:mm:ss"
    assert "quote" not in sources["raw_orders"].reader_options()
    assert sources["raw_customers"].path == "/landing/raw_customers.csv"


def test_timestamp_format_is_used(spark):
    source = text_source(spark, "t", "at\n2022-03-04 05:06:07", schema="at timestamp", timestamp_format="yyyy-MM-dd HH:mm:ss")
    (row,) = read_source(spark, source).select(F.date_format("at", "yyyy/MM/dd HH-mm-ss").alias("at")).collect()
    assert row.at == "2022/03/04 05-06-07"


def test_csv_keeps_white_space_and_folder_reads_text(spark):
    folder = scratch_dir(spark, "landing")
    source = FileSource(path=folder, table_name="t", schema="a string, b int")
    write_csv(spark.createDataFrame([(" x ", 1), (None, 2)], "a string, b int"), folder, source)
    assert {(r.a, r.b) for r in read_source(spark, source).collect()} == {(" x ", 1), (None, 2)}
    assert dict(read_folder(spark, folder).dtypes) == {"a": "string", "b": "string"}


def test_bucketed_tables_join_without_a_shuffle(spark):
    left = spark.range(100).withColumnRenamed("id", "order_id")
    save_table(left, "left_b", bucket_by=(4, "order_id"))
    save_table(left.withColumn("y", F.lit(1)), "right_b", bucket_by=(4, "order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "order_id")
        assert joined.count() == 100
        assert "Exchange hashpartitioning" not in plan_text(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

