"""Shape of the plans: what is shuffled, broadcast and read."""

import re

import pytest
from pyspark.sql import functions as F

from suite import projection
from suite.queries import queries
from tallymill.operators import first_hit
from tallymill.operators.diagnose import rule_metrics
from tallymill.operators.reconcile import match, reconcile
from tests.frames import inc, increments, rep, reports
from tallymill.plans.serving import best_match, serving_view_sql
from tallymill.sinks import publish as publish_module


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def flagship(spark, sf_dir):
    incs, reps = projection.increments(spark, sf_dir), projection.reports(spark, sf_dir)
    return reconcile(incs, reps, tie_breakers=["rep_id"])


def test_wide_rows_are_shuffled_once(flagship):
    """By all keys, as one; the verdicts meet them there."""
    plan = plan_of(flagship)
    assert len(re.findall(r"Exchange hashpartitioning\((?:xxhash64\(_unit|_hash)", plan)) == 2


def test_reports_are_scanned_once(spark, sf_dir):
    """At run time: equal shuffles are reused, so one scan feeds all lookups."""
    result = reconcile(projection.increments(spark, sf_dir), projection.reports(spark, sf_dir))
    result.write.format("noop").mode("overwrite").save()
    result.collect()
    final = plan_of(result).split("== Initial Plan ==")[0]
    scans = [x for x in final.splitlines() if "FileScan" in x and "o_orderpriority" in x]
    assert len(scans) == 1


def test_rule_metrics_shuffle_no_facts(spark, sf_dir):
    """Facts are counted per key in the map tasks, before the first exchange."""
    incs, reps = projection.increments(spark, sf_dir), projection.reports(spark, sf_dir)
    plan = plan_of(rule_metrics(incs, reps))
    for line in plan.splitlines():
        assert "NOTA" not in line or "Exchange" not in line
    assert len(re.findall(r"partial_count\(1\)", plan)) == 1
    joins = re.findall(r"SortMergeJoin \[_unit[^\]]*\]", plan)
    assert joins and all("_baixa" not in j or "_exec" not in j for j in joins)


def test_no_cross_join_and_no_python(flagship, spark, sf_dir):
    view = best_match(projection.view_reports(spark, sf_dir), projection.increments(spark, sf_dir))
    for plan in (plan_of(flagship), plan_of(view)):
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan and "Pandas" not in plan


def test_nothing_is_broadcast(spark):
    """On inputs without a join of their own."""
    incs, reps = increments(spark, inc()), reports(spark, rep())
    plan = plan_of(match(incs, reps))
    assert "Broadcast" not in plan


def test_scans_read_needed_columns_only(spark, sf_dir):
    counted = reconcile(
        projection.increments(spark, sf_dir), projection.reports(spark, sf_dir)
    ).groupBy("REGRA_ORIGEM").count()
    assert "l_quantity" not in plan_of(counted)
    assert "o_totalprice" not in plan_of(counted)


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "reports")
    spark.sql(
        "SELECT '1' `UC / MD`, '109' COD, DATE '2026-01-05' DATA_EXECUCAO, 'E' EQUIPE,"
        " 'OK' STATUS, 'SUL' REGIONAL, 'BT' GRUPO"
    ).write.parquet(path)
    incs = spark.sql("SELECT 1 INSTALACAO, DATE '2026-01-05' DATA_EXECUCAO, 109 IRREGULARIDADE, 5 INC_TOTAL")
    plan = plan_of(best_match(spark.read.parquet(path), incs))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    for column in ("STATUS", "REGIONAL", "GRUPO", "DATA_EXECUCAO"):
        assert column in pushed


def test_view_reads_increments_once_and_not_before_the_month(spark, tmp_path):
    reps, incs = str(tmp_path / "reports"), str(tmp_path / "incs")
    spark.sql(
        "SELECT '1' `UC / MD`, '109' COD, DATE '2026-01-15' DATA_EXECUCAO, 'E' EQUIPE,"
        " 'OK' STATUS, 'SUL' REGIONAL, 'BT' GRUPO"
    ).write.parquet(reps)
    increments(spark, inc(exec="2026-01-05")).write.parquet(incs)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW plan_r AS SELECT * FROM parquet.`{reps}`")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW plan_i AS SELECT * FROM parquet.`{incs}`")
    day = "2026-01-10"
    frames = (
        best_match(spark.read.parquet(reps), spark.read.parquet(incs), day),
        spark.sql(serving_view_sql("plan_r", "plan_i", day)),
    )
    for frame in frames:
        assert [r["INC_TOTAL"] for r in frame.collect()] == [5]
        final = plan_of(frame).split("== Initial Plan ==")[0]
        scans = [x for x in final.splitlines() if "FileScan" in x and "INC_TOTAL" in x]
        assert len(scans) == 1
        assert "GreaterThanOrEqual(DATA_EXECUCAO,2026-01-01)" in scans[0]


def test_the_serving_view_broadcasts_no_totals(spark, tmp_path):
    """Totals in few columns of a wide table look small; small here as well."""
    reps, incs = str(tmp_path / "reps"), str(tmp_path / "incs")
    spark.sql(
        "SELECT '1' `UC / MD`, '109' COD, DATE '2026-01-15' DATA_EXECUCAO, 'E' EQUIPE,"
        " 'OK' STATUS, 'SUL' REGIONAL, 'BT' GRUPO"
    ).write.parquet(reps)
    increments(spark, inc(exec="2026-01-05")).write.parquet(incs)
    sql = serving_view_sql(f"parquet.`{reps}`", f"parquet.`{incs}`", "2026-01-10")
    plan = plan_of(spark.sql(sql))
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 3


@pytest.mark.parametrize("all_keys", ["true", "false"])
def test_a_hot_key_is_split(spark, tmp_path, all_keys):
    """One key owns most rows; no task of the final join gets all of them,
    whichever way joins may share a partitioning."""
    conf = {
        "spark.sql.requireAllClusterKeysForCoPartition": all_keys,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "8",
    }
    rows = [inc(7, 109, "2026-01-05", nota=str(n) * 20) for n in range(4000)]
    rows += [inc(n, 109, "2026-01-05") for n in range(10, 400)]
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        incs = increments(spark, *rows).repartition(16)
        incs.write.parquet(str(tmp_path / "incs"))
        incs = spark.read.parquet(str(tmp_path / "incs"))
        result = reconcile(incs, reports(spark, rep(7, exec="2026-01-05")))
        result.write.parquet(str(tmp_path / "out"))
        files = spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name()).count()
        assert files.agg(F.max("count")).first()[0] <= 2000
        assert files.agg(F.sum("count")).first()[0] == 4390
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_keys_are_dealt_by_unit_once(spark, sf_dir):
    """The distinct keys and the reports are; no lookup's join deals them again."""
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(setting)
    result = queries()["reconcile"](spark, sf_dir)
    try:
        assert spark.conf.get(setting) == "false"
        plan = plan_of(result)
    finally:
        spark.conf.set(setting, before)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)
    by_unit = [re.sub(r"#\d+L?", "", keys) for keys in dealt if "hash" not in keys]
    assert "_unit" in by_unit and "unit" in by_unit
    # Of several keys: the profile's and the reduced reports' own grouping, before.
    several = {k for k in by_unit if "," in k and "unit" in k}
    assert all(k.count(",") >= 3 for k in several), several


def test_the_verdicts_hash_is_not_shuffled(spark):
    """Both sides of the final join are sorted by one number, made after the shuffle."""
    plan = plan_of(match(increments(spark, inc()), reports(spark, rep())))
    assert len(re.findall(r"Sort \[xxhash64\([^\]]*\) ASC NULLS FIRST\]", plan)) == 2
    assert not re.search(r"AS _hash\b", plan)


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    """All keys have one hash, and each increment still gets its own report."""
    one = "xxhash64({0} - {0})"
    monkeypatch.setattr(first_hit.F, "xxhash64", lambda *keys: F.expr(one.format(keys[0])))
    units = range(1, 9)
    incs = increments(spark, *[inc(n, 109, "2026-01-05") for n in units])
    reps = reports(spark, *[rep(n, exec="2026-01-05", team=f"T{n}") for n in units])
    found = reconcile(incs, reps).select("INSTALACAO", "EQUIPE").collect()
    assert sorted(map(tuple, found)) == [(n, f"T{n}") for n in units]


@pytest.mark.parametrize(
    "name",
    ["publish_replace", "publish_append", "publish_empty_group", "publish_uncommitted", "largest_totals"],
)
def test_increments_are_joined_once(spark, sf_dir, monkeypatch, name):
    """A query that reconciles the same increments again reads them from a table."""
    plans, whole = [], publish_module.sink_types
    monkeypatch.setattr(
        publish_module, "sink_types", lambda result: plans.append(plan_of(result)) or whole(result)
    )
    queries()[name](spark, sf_dir)
    assert len(plans) == 2 and not [p for p in plans if "l_orderkey" in p]
