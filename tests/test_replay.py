"""The one-pass plan against brute force, on test tables and on skewed data."""

import random
from collections import Counter
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from suite import projection
from tallymill.operators.clean import clean_reports
from tallymill.operators.reconcile import reconcile
from tallymill.plans.rules import WATERFALL, null_safe
from tallymill.schema import CODE_CLASS, RESULT_COLUMNS
from tests.frames import inc, increments, rep, reports

DAY = {"exec": "DATA_EXECUCAO", "baixa": "DATA_BAIXA"}


def month_of(day):
    return None if day is None else day.year * 12 + day.month


def first_key(report):
    unit, code, executed, closed, team = report[:5]
    ties = report[5:] or (
        closed is None,
        -(closed.toordinal()) if closed else 0,
        (code is not None, code or 0),
        (team is None, team or ""),
    )
    return (executed is None, -(executed.toordinal()) if executed else 0, *ties)


def replay(increment, of_unit):
    """Try every rule in order on the sorted reports of the increment's unit."""
    code, cls = increment["IRREGULARIDADE"], increment["CLASSIFICACAO_IRREG"]
    for rule in WATERFALL:
        day = increment[DAY[rule.inc_month]]
        if day is None or (rule.by == "code" and not code):
            continue
        for report in of_unit:
            attr = report[1] if rule.by == "code" else CODE_CLASS.get(report[1])
            rep_day = report[2] if rule.rep_month == "exec" else report[3]
            if rule.open_only and report[3] is not None:
                continue
            if rep_day is None or attr is None or attr != (code if rule.by == "code" else cls):
                continue
            if month_of(rep_day) + rule.lag != month_of(day):
                continue
            if report[4] is not None:
                return {
                    "EQUIPE": report[4], "MATCH_OK": True, "REGRA_ORIGEM": rule.id,
                    "MOTIVO_PENDENCIA": None,
                    "DATA_EXECUCAO": increment["DATA_EXECUCAO"] or report[2],
                    "IRREGULARIDADE": report[1] if code == 0 else code,
                }
            break
    reason = "outros"
    if not of_unit:
        reason = "sem_uc_no_reports"
    elif code in [r[1] for r in of_unit]:
        reason = "mismatch_mes"
    elif cls in [CODE_CLASS.get(r[1]) for r in of_unit]:
        reason = "mismatch_cod"
    return {
        "EQUIPE": None, "MATCH_OK": False, "REGRA_ORIGEM": "SEM_MATCH", "MOTIVO_PENDENCIA": reason,
    }


def replay_all(incs, reps):
    by_unit = {}
    for report in sorted(reps, key=first_key):
        by_unit.setdefault(report[0], []).append(report)
    rows = [i | replay(i, by_unit.get(i["INSTALACAO"], [])) for i in incs]
    return Counter(tuple(r[c] for c in RESULT_COLUMNS) for r in rows)


def as_counter(result):
    assert result.columns == RESULT_COLUMNS
    return Counter(tuple(r) for r in result.collect())


def test_test_tables(spark, sf_dir):
    incs, reps = projection.increments(spark, sf_dir), projection.reports(spark, sf_dir)
    names = ["instalacao", "irregularidade", "data_exec_rep", "data_baixa_rep", "equipe", "rep_id"]
    want = replay_all(
        [r.asDict() for r in incs.collect()],
        [tuple(r) for r in reps.select(names).collect()],
    )
    got = as_counter(reconcile(incs, reps, tie_breakers=["rep_id"]))
    assert got == want
    rules = Counter(r[RESULT_COLUMNS.index("REGRA_ORIGEM")] for r in got.elements())
    assert rules == {
        "R1": 42, "R2": 26, "R3": 38, "R4": 16, "R5": 32, "R4-1": 6, "R5-1": 12,
        "SEM_MATCH": 5828,
    }


def skewed_data(seed=7, n=1500):
    """A third of the increments are copies of one row, a third have one unit."""
    rnd = random.Random(seed)
    start = date(2025, 10, 1)

    def some_day(missing=0.2):
        return None if rnd.random() < missing else start + timedelta(rnd.randrange(150))

    def text(day):
        return day and day.isoformat()

    codes = [0, 109, 115, 175, 201, 300, 999]
    reps = [
        rep(1 + rnd.randrange(20) if i % 3 else 7, rnd.choice([*codes, None]), text(some_day()),
            text(some_day(0.5)), rnd.choice(["A", "B", None]))
        for i in range(n // 3)
    ]
    copied = inc(7, 109, "2026-01-05", "2026-01-20", "C100")
    incs = []
    for i in range(n):
        code = rnd.choice(codes)
        cls = CODE_CLASS.get(code) or rnd.choice(["", "C100", "ACAO"])
        row = inc(rnd.randrange(25), code, text(some_day()), text(some_day()), cls)
        incs.append((copied, row | {"INSTALACAO": 7}, row)[i % 3])
    return incs, reps


def test_skewed_data(spark):
    incs, reps = skewed_data()
    result = reconcile(increments(spark, *incs).repartition(4), reports(spark, *reps))
    assert as_counter(result) == replay_all(incs, reps)


def test_later_time_of_one_day_wins(spark):
    """Whatever the order of the rows; and a team wins what else is a tie."""
    raw = [
        ("123", "109", "2026-01-06 08:00:00", None, "AAA"),
        ("123", "109", "2026-01-06T17:00:00.5", None, "BBB"),
        ("123", "109", "2026-01-06 17:00", None, "CCC"),
        ("124", "109", "2026-01-06", None, None),
        ("124", "109", "2026-01-06", None, "DDD"),
        ("125", "109", "2026-01-06 09:00:00", None, None),
        ("125", "109", "2026-01-06 08:00:00", None, "EEE"),
    ]
    names = "`UC / MD` string, COD string, DATA_EXECUCAO string, `DATA BAIXADO` string, EQUIPE string"
    incs = increments(spark, *[inc(unit, 109, "2026-01-06") for unit in (123, 124, 125)])
    for rows in (raw, raw[::-1]):
        reps = clean_reports(spark.createDataFrame(rows, names))
        got = {r["INSTALACAO"]: r["EQUIPE"] for r in reconcile(incs, reps).collect()}
        # A first report without a team hides an earlier one that has a team.
        assert got == {123: "BBB", 124: "DDD", 125: None}


def test_no_class_text_is_taken_for_a_missing_class(spark):
    rows = [inc(1, 999, "2026-01-05", None, cls) for cls in ("", "<none>", "=", "C100")]
    for rules in (WATERFALL, null_safe()):
        got = reconcile(increments(spark, *rows), reports(spark, rep(2)), rules)
        assert sorted(r["CLASSIFICACAO_IRREG"] for r in got.collect()) == ["", "<none>", "=", "C100"]


def test_missing_units_reach_no_report(spark):
    rows = [inc(unit, 109, "2026-01-05", nota=str(unit)) for unit in (0, None, 1)]
    got = reconcile(increments(spark, *rows), reports(spark, rep(1, exec="2026-01-05")))
    assert {(r["NOTA"], r["INSTALACAO"], r["REGRA_ORIGEM"], r["MOTIVO_PENDENCIA"]) for r in got.collect()} == {
        ("0", 0, "SEM_MATCH", "sem_uc_no_reports"),
        ("None", None, "SEM_MATCH", "sem_uc_no_reports"),
        ("1", 1, "R1", None),
    }


days = st.sampled_from([None, "2025-12-01", "2025-12-31", "2026-01-01", "2026-01-31", "2026-02-10"])
codes = st.sampled_from([0, 109, 115, 300, 999])
units = st.integers(1, 3)
some_incs = st.builds(
    lambda u, c, e, b, k: inc(u, c, e, b, CODE_CLASS.get(c) or k),
    units, codes, days, days, st.sampled_from(["", "C100", "ACAO"]),
)
some_reps = st.builds(rep, units, codes, days, days, st.sampled_from(["A", "B", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(some_incs, min_size=20, max_size=60), st.lists(some_reps, min_size=5, max_size=40))
def test_any_data(spark, incs, reps):
    got = as_counter(reconcile(increments(spark, *incs), reports(spark, *reps)))
    assert got == replay_all(incs, reps)
    for row in got:
        r = dict(zip(RESULT_COLUMNS, row))
        assert r["MATCH_OK"] == (r["EQUIPE"] is not None) == (r["MOTIVO_PENDENCIA"] is None)
        assert r["MATCH_OK"] == (r["REGRA_ORIGEM"] != "SEM_MATCH")
