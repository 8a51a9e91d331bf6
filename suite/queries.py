"""Registered queries: every operator over the whole test tables."""

import uuid
from functools import partial

from pyspark.sql import functions as F

from suite import projection as p
from suite.oracle import ALONE, LOOKUPS, RULE_NAMES, VIEW_DAY
from tallymill.functions.domain import (
    code_class,
    month_start,
    normalised_class,
    previous_month,
)
from tallymill.functions.values import (
    clean_text,
    int_or_zero,
    lenient_date,
    lenient_int,
    strict_int,
    unit_id,
)
from tallymill.operators.clean import clean_increment, clean_reports
from tallymill.operators.diagnose import (
    group_counts,
    open_report_count,
    rule_metrics,
    unit_profiles,
)
from tallymill.operators.formats import date_format_report, detect_date_formats
from tallymill.operators.lookup import keep_first
from tallymill.operators.reconcile import final_projection, reconcile
from tallymill.plans.daily import run_daily
from tallymill.plans.rules import WATERFALL, null_safe
from tallymill.plans.serving import best_match, create_serving_view
from tallymill.schema import (
    DATE_COLUMNS,
    GROUP_TABLE,
    INTEGER_COLUMNS,
    MONTHS,
    TEXT_COLUMNS,
)
from tallymill.session import tune
from tallymill.sinks.kept import kept_reports, merge_reports
from tallymill.sinks.pending import export_pending
from tallymill.sinks.publish import (
    largest_of,
    merge_largest,
    prepare,
    publish,
    run_ledger,
)
from tallymill.sinks.shared import run_folder, shared_folder
from tallymill.sources.snapshot import read_snapshot

TIES = ["rep_id"]


def reconciled(spark, sf_dir, rules=WATERFALL):
    return reconcile(p.increments(spark, sf_dir), p.reports(spark, sf_dir), rules, TIES)


def staged(spark, sf_dir):
    """Reconciling of increments and reports that are tables, as each is read more than once."""
    folder = f"{run_folder(spark)}/inputs-{uuid.uuid4().hex}"
    tables = {"increments": p.increments(spark, sf_dir), "reports": p.reports(spark, sf_dir)}
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}")
        tables[name] = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
    return lambda rules=WATERFALL: reconcile(*tables.values(), rules, TIES)


def reconcile_kept(spark, sf_dir):
    """Reports come in three lots, which are merged into the kept ones."""
    name, root = f"kept_{uuid.uuid4().hex}", shared_folder(spark, "kept")
    reports = p.reports(spark, sf_dir)
    for lot in range(3):
        merge_reports(reports.where(F.col("rep_id") % 3 == lot), name, root, TIES, buckets=8)
    kept = kept_reports(spark, name)
    return reconcile(p.increments(spark, sf_dir), None, tie_breakers=TIES, kept=kept)


def clean_columns(spark, sf_dir, function, names, keep=("NOTA",)):
    cleaned = [function(F.col(c)).alias(c) for c in names]
    return p.raw_increments(spark, sf_dir).select(*keep, *cleaned)


def detected_dates(spark, sf_dir):
    raw = p.raw_increments(spark, sf_dir)
    formats = detect_date_formats(raw, DATE_COLUMNS)
    return raw.select("NOTA", *[lenient_date(F.col(c), formats[c]).alias(c) for c in DATE_COLUMNS])


def classed_reports(spark, sf_dir):
    return (
        p.reports(spark, sf_dir)
        .withColumn("classificacao", code_class(F.col("irregularidade")))
        .withColumn("mes_ano_exec", month_start(F.col("data_exec_rep")))
    )


def dedup(spark, sf_dir, open_only=False):
    reports = classed_reports(spark, sf_dir)
    if open_only:
        reports = reports.where("data_baixa_rep IS NULL")
    attr = "classificacao" if open_only else "irregularidade"
    return keep_first(reports, ["instalacao", attr, "mes_ano_exec"], TIES)


def one_rule(spark, sf_dir, rule):
    return reconciled(spark, sf_dir, [rule]).select(ALONE.split(", "))


def fresh_routes():
    """Routes to tables that no other run uses."""
    run = uuid.uuid4().hex
    return {group: f"{table}_{run}" for group, table in GROUP_TABLE.items()}


def published(spark, routes):
    """All published tables as one, each row with the plain name of its table."""
    frames = [
        spark.read.table(table).withColumn("tabela", F.lit(GROUP_TABLE[group]))
        for group, table in routes.items()
    ]
    return frames[0].unionByName(frames[1])


def publish_replace(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    reconciled_by = staged(spark, sf_dir)
    publish(reconciled_by(WATERFALL[:1]), root, routes)
    publish(reconciled_by(), root, routes)
    return published(spark, routes)


def publish_append(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    reconciled_by = staged(spark, sf_dir)
    publish(reconciled_by(WATERFALL[:1]), root, routes)
    publish(reconciled_by(), root, routes, strategy="append")
    return published(spark, routes)


def publish_routing(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    publish(reconciled(spark, sf_dir), root, routes)
    return published(spark, routes).groupBy("tabela", "GRUPO").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def publish_empty_group(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    reconciled_by = staged(spark, sf_dir)
    publish(reconciled_by(), root, routes)
    later = reconciled_by(WATERFALL[:1])
    publish(later.where("GRUPO <> 'GESTAO CENTRALIZADA'"), root, routes)
    return published(spark, routes)


def publish_layout(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    publish(reconciled(spark, sf_dir), root, routes, layout="range")
    return published(spark, routes)


def publish_curve_layout(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    publish(reconciled(spark, sf_dir), root, routes, layout="curve")
    return published(spark, routes)


def layout_lookups(spark, sf_dir):
    """A lookup on each indexed column of tables laid out along the curve."""
    rows = publish_curve_layout(spark, sf_dir)
    found = [
        rows.where(sql)
        .groupBy("tabela")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("INC_TOTAL").alias("total"))
        .withColumn("lookup", F.lit(name))
        for name, sql in LOOKUPS.items()
    ]
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return out


def publish_uncommitted(spark, sf_dir):
    """A second day that is written in full and whose commit never comes."""
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    reconciled_by = staged(spark, sf_dir)
    publish(reconciled_by(WATERFALL[:1]), root, routes)
    prepare(reconciled_by(), root, routes)
    return published(spark, routes)


def publish_append_repeated(spark, sf_dir):
    """The same load appended twice, after another."""
    routes, root = fresh_routes(), shared_folder(spark, "publish")
    reconciled_by = staged(spark, sf_dir)
    loads = {"one": WATERFALL[:1], "two": WATERFALL}
    for load in ("one", "two", "two", "one"):
        rows = reconciled_by(loads[load])
        publish(rows, root, routes, "append", load_id=load)
    return published(spark, routes)


def two_loads(spark, sf_dir, purpose):
    """Published tables of two appended loads, of the first halves and second of notes."""
    routes, root = fresh_routes(), shared_folder(spark, purpose)
    reconciled_by = staged(spark, sf_dir)
    result = reconciled_by()
    odd = F.col("NOTA").cast("bigint") % 2 == 1
    publish(result.where(odd), root, routes)
    publish(result.where(~odd), root, routes, strategy="append")
    return routes, root


def largest_totals(spark, sf_dir):
    """Kept with each load, and the largest over both."""
    routes, _ = two_loads(spark, sf_dir, "largest")
    frames = [
        spark.read.table(largest_of(spark, table)).withColumn("tabela", F.lit(GROUP_TABLE[group]))
        for group, table in routes.items()
    ]
    keys = ["tabela", "INSTALACAO", "DATA_EXECUCAO", "IRREGULARIDADE"]
    rows = frames[0].unionByName(frames[1])
    return rows.groupBy(*keys).agg(F.max("INC_TOTAL").alias("INC_TOTAL"))


def serving_view_of_loads(spark, sf_dir):
    """The named view over two loads, whose totals are merged into one partition."""
    routes, root = two_loads(spark, sf_dir, "serving")
    merge_largest(spark, routes["BAIXA TENSAO"])
    return named_view(spark, sf_dir, routes, root)


def pending_export(spark, sf_dir):
    path = shared_folder(spark, "pending")
    export_pending(reconciled(spark, sf_dir), path)
    return spark.read.parquet(path)


def serving_view(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "serving")
    publish(reconciled(spark, sf_dir), root, routes)
    return named_view(spark, sf_dir, routes, root)


def named_view(spark, sf_dir, routes, root):
    run = uuid.uuid4().hex
    p.view_reports(spark, sf_dir).write.parquet(f"{root}/reports")
    spark.sql(f"CREATE VIEW reports_{run} AS SELECT * FROM parquet.`{root}/reports`")
    view = f"vw_increment_bt_{run}"
    create_serving_view(spark, f"reports_{run}", routes["BAIXA TENSAO"], view, VIEW_DAY)
    return spark.read.table(view)


_DROPPED = {}


def drop_snapshots(spark, sf_dir):
    """A drop folder with an older and a newer snapshot, written once a session.

    Reading a folder is what is tested; writing it is the fixture's part.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DROPPED:
        _DROPPED[key] = _write_snapshots(spark, sf_dir)
    return _DROPPED[key]


def _write_snapshots(spark, sf_dir):
    folder = shared_folder(spark, "input")
    raw = p.raw_increments(spark, sf_dir)
    for name, rows in (("2026-01-01", raw.select("NOTA")), ("2026-01-02", raw)):
        (
            rows.write.option("header", True)
            .option("compression", "gzip")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/{name}.csv")
        )
    return folder


def snapshot_scan(spark, sf_dir):
    return read_snapshot(spark, drop_snapshots(spark, sf_dir))


def daily_run(spark, sf_dir):
    routes, root = fresh_routes(), shared_folder(spark, "daily")
    reports = clean_reports(p.raw_reports(spark, sf_dir), keep=TIES)
    folder = drop_snapshots(spark, sf_dir)
    run_daily(spark, folder, reports, root, tie_breakers=TIES, routes=routes)
    return published(spark, routes)


def daily_ledger(spark, sf_dir):
    """What the ledger says after two runs, under the plain names of the tables."""
    routes, root = fresh_routes(), shared_folder(spark, "daily")
    reports = clean_reports(p.raw_reports(spark, sf_dir), keep=TIES)
    folder = drop_snapshots(spark, sf_dir)
    for strategy in ("replace", "append"):
        run_daily(spark, folder, reports, root, tie_breakers=TIES, routes=routes, strategy=strategy)
    plain = F.col("name")
    for group, table in routes.items():
        plain = F.replace(plain, F.lit(table), F.lit(GROUP_TABLE[group]))
    runs = run_ledger(spark, f"{root}/tables", routes).select("run", plain.alias("name"), "count")
    return runs.groupBy("name", "count").agg(F.count_distinct("run").alias("runs"))


def queries():
    registered = {
        "scan_project_rename": lambda s, d: clean_reports(p.raw_reports(s, d), keep=TIES).withColumn(
            "hora_exec_rep", F.date_format("hora_exec_rep", "yyyy-MM-dd HH:mm:ss.SSS")
        ),
        "clean_dates": lambda s, d: clean_columns(s, d, lenient_date, DATE_COLUMNS),
        "date_formats": lambda s, d: date_format_report(p.raw_increments(s, d), DATE_COLUMNS).unionByName(
            date_format_report(p.raw_reports(s, d), ["DATA_EXECUCAO", "DATA BAIXADO"]).withColumn(
                "column", F.concat(F.lit("rep "), "column")
            )
        ),
        "clean_dates_detected": detected_dates,
        "clean_int_zero": lambda s, d: clean_columns(s, d, int_or_zero, INTEGER_COLUMNS),
        "clean_int_null": lambda s, d: clean_columns(s, d, lenient_int, MONTHS),
        "clean_int_strict": lambda s, d: p.raw_reports(s, d).select(
            "rep_id", strict_int(F.col("COD")).alias("irregularidade")
        ),
        "clean_uc": lambda s, d: p.raw_reports(s, d).select(
            "rep_id", unit_id(F.col("`UC / MD`")).alias("instalacao")
        ),
        "clean_text": lambda s, d: clean_columns(s, d, clean_text, TEXT_COLUMNS, ()),
        "clean_increment": lambda s, d: clean_increment(p.raw_increments(s, d)),
        "class_map": lambda s, d: p.reports(s, d).select(
            "rep_id",
            "irregularidade",
            code_class(F.col("irregularidade")).alias("classificacao"),
        ),
        "class_normalise": lambda s, d: p.scan(s, d, p.INCREMENTS).select(
            "NOTA",
            "IRREGULARIDADE",
            "SRC_CLASSIF",
            normalised_class(F.col("IRREGULARIDADE"), F.col("SRC_CLASSIF")).alias(
                "CLASSIFICACAO_IRREG"
            ),
        ),
        "month_keys": lambda s, d: p.increments(s, d).select(
            "NOTA",
            month_start(F.col("DATA_EXECUCAO")).alias("mes_ano_exec"),
            month_start(F.col("DATA_BAIXA")).alias("mes_ano_baixa"),
            previous_month(F.col("DATA_BAIXA")).alias("mes_anterior"),
        ),
        "dedup_keep_first": dedup,
        "dedup_keep_first_no_baixa": partial(dedup, open_only=True),
        "reconcile": reconciled,
        "reconcile_kept": reconcile_kept,
        "reconcile_null_safe": lambda s, d: reconcile(
            p.increments(s, d, keep_missing_class=True), p.reports(s, d), null_safe(), TIES
        ),
        "uc_profiles": lambda s, d: unit_profiles(p.reports(s, d)),
        "pending_reasons": lambda s, d: reconciled(s, d).select(
            "INSTALACAO", "IRREGULARIDADE", "CLASSIFICACAO_IRREG", "MATCH_OK", "MOTIVO_PENDENCIA"
        ),
        "rule_metrics": lambda s, d: rule_metrics(
            p.increments(s, d), p.reports(s, d), tie_breakers=TIES
        ),
        "group_counts": lambda s, d: group_counts(reconciled(s, d)),
        "open_report_count": lambda s, d: open_report_count(p.reports(s, d)),
        "pending_export": pending_export,
        "final_projection": lambda s, d: final_projection(
            reconciled(s, d).withColumn("working_column", F.lit(1))
        ),
        "publish_replace": publish_replace,
        "publish_append": publish_append,
        "publish_routing": publish_routing,
        "publish_empty_group": publish_empty_group,
        "publish_layout": publish_layout,
        "publish_curve_layout": publish_curve_layout,
        "layout_lookups": layout_lookups,
        "publish_uncommitted": publish_uncommitted,
        "publish_append_repeated": publish_append_repeated,
        "largest_totals": largest_totals,
        "serving_view_of_loads": serving_view_of_loads,
        "daily_ledger": daily_ledger,
        "best_match_view": lambda s, d: best_match(
            p.view_reports(s, d), p.increments(s, d), VIEW_DAY
        ),
        "serving_view": serving_view,
        "snapshot_scan": snapshot_scan,
        "daily_run": daily_run,
    }
    for name, rule in zip(RULE_NAMES, WATERFALL):
        registered[name] = partial(one_rule, rule=rule)
    return {name: partial(_tuned, query) for name, query in registered.items()}


def _tuned(query, spark, sf_dir):
    """A query with the settings that the command line starts its session with."""
    tune(spark)
    return query(spark, sf_dir)
