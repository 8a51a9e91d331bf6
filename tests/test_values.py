"""Cleaning of single values, and the column contract."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallymill.functions.domain import code_class, month_number, month_start, previous_month
from tallymill.functions.values import (
    ISO_DATE,
    clean_text,
    int_or_zero,
    lenient_date,
    lenient_instant,
    lenient_int,
    strict_int,
    unit_id,
)
from tallymill.operators.clean import clean_increment, clean_reports
from tallymill.schema import CODE_CLASS, INCREMENT_COLUMNS, INCREMENT_SCHEMA


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_dates(spark):
    texts = ["2026-01-06 13:14:15", "2026-01-06", " 2026-01-06 ", "31/12/2025", "", None, "2026-02-30"]
    d = date(2026, 1, 6)
    assert apply(spark, lenient_date, texts) == [d, d, d, None, None, None, None]


def test_iso_forms_of_a_time(spark):
    texts = {
        "2026-01-06 08:00:00.123": (8, 0, 0, 123000),
        "2026-01-06T08:00:00": (8, 0, 0),
        "2026-01-06 08:00": (8, 0),
        " 2026-01-06T23:30:00.000001Z ": (23, 30, 0, 1),
        "2026-01-06T23:30:00-03:00": (23, 30),  # as written, whatever the offset
        "2026-01-06 23:30:00 +0530": (23, 30),
        "2026-01-06": (0, 0),
    }
    want = [datetime(2026, 1, 6, *time) for time in texts.values()]
    assert apply(spark, lenient_instant, texts) == want
    assert apply(spark, lenient_date, texts) == [date(2026, 1, 6)] * len(texts)
    junk = ["2026-01-06T", "2026-01-06 25:00:00", "2026-1-6", "2026-01-06 08", "2026-01-06-03:00"]
    assert apply(spark, lenient_instant, junk) == [None] * len(junk)


def test_typed_dates_are_taken_as_they_are(spark):
    raw = spark.sql(
        "SELECT '7' `UC / MD`, 109 COD, TIMESTAMP'2026-01-06 08:00:00.123' DATA_EXECUCAO,"
        " DATE'2026-01-20' `DATA BAIXADO`, 'T' EQUIPE"
    )
    row = clean_reports(raw).first()
    assert (row["data_exec_rep"], row["data_baixa_rep"]) == (date(2026, 1, 6), date(2026, 1, 20))
    assert row["hora_exec_rep"] == datetime(2026, 1, 6, 8, 0, 0, 123000)


def test_unread_dates_are_counted(spark):
    raw = raw_increment(spark, DATA_EXECUCAO="31/12/2025", DATA_BAIXA=" ")
    seen = Observation()
    clean_increment(raw, seen=seen).collect()
    assert seen.get == {"unread DATA_EXECUCAO": 1, "unread DATA_BAIXA": 0}


def test_dates_with_another_format(spark):
    formats = (ISO_DATE, "dd/MM/yyyy")
    got = apply(spark, lambda c: lenient_date(c, formats), ["31/12/2025", "2025-12-31", "x"])
    assert got == [date(2025, 12, 31), date(2025, 12, 31), None]


def test_integers(spark):
    texts = ["0311", " 12 ", "1e3", "1,2", "n/a", "", None, "-7", "50.0", "\t8 ", "8\u00a0"]
    want = [311, 12, 1000, None, None, None, None, -7, 50, 8, None]
    assert apply(spark, lenient_int, texts) == want
    assert apply(spark, int_or_zero, texts) == [w or 0 for w in want]


@pytest.mark.parametrize("text", ["1.5", "inf", "-Infinity"])
def test_fraction_fails_or_becomes_null(spark, text):
    with pytest.raises(PySparkException):
        apply(spark, lenient_int, [text])
    assert apply(spark, lambda c: lenient_int(c, "null"), [text, "4"]) == [None, 4]
    assert apply(spark, lambda c: int_or_zero(c, "null"), [text]) == [0]


def test_unknown_fraction_mode():
    with pytest.raises(ValueError):
        lenient_int(F.lit("1"), "round")


def test_strict_integers_tolerate_from_above_only(spark):
    texts = ["2.0", "2.00000000001", "3.9999999999", "109.5", "x", None, "3.11e2", " 175 "]
    assert apply(spark, strict_int, texts) == [2, 2, None, None, None, None, 311, 175]


def test_unit_ids(spark):
    texts = ["0011126302", " UC-000123 /X", "000", "", "junk", None, "12.0"]
    assert apply(spark, unit_id, texts) == [11126302, 123, None, None, None, None, 120]


def test_texts(spark):
    texts = [" a b ", "nan", "None", "NaN", " None ", None, "\t x \n", "NAN"]
    assert apply(spark, clean_text, texts) == ["a b", "", "", "", "None", "", "x", "NAN"]
    assert apply(spark, lambda c: clean_text(c, True), [None, "nan", " a"]) == [None, "", "a"]


def test_every_code_has_its_class(spark):
    rows = [(c,) for c in range(100, 330)] + [(None,), (0,)]
    got = spark.createDataFrame(rows, "c bigint").select("c", code_class(F.col("c")).alias("k"))
    assert {r["c"]: r["k"] for r in got.collect() if r["k"]} == CODE_CLASS
    assert len(CODE_CLASS) == 37


def test_months_cross_years(spark):
    df = spark.createDataFrame([(date(2026, 1, 31),), (date(2025, 12, 1),), (None,)], "d date")
    c = F.col("d")
    got = df.select(month_start(c), previous_month(c), month_number(c)).collect()
    assert [tuple(r) for r in got] == [
        (date(2026, 1, 1), date(2025, 12, 1), 2026 * 12 + 1),
        (date(2025, 12, 1), date(2025, 11, 1), 2025 * 12 + 12),
        (None, None, None),
    ]
    assert got[0][2] - 1 == got[1][2]


def raw_increment(spark, **values):
    row = dict.fromkeys([*INCREMENT_COLUMNS, "EXTRA"]) | values
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))


def test_clean_increment_types_and_defaults(spark):
    raw = raw_increment(spark, IRREGULARIDADE="0311", INSTALACAO="x", CLASSIFICACAO_IRREG="ACAO")
    cleaned = clean_increment(raw)
    assert cleaned.columns == INCREMENT_COLUMNS
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in INCREMENT_SCHEMA]
    row = cleaned.first()
    assert (row["INSTALACAO"], row["CMPT"], row["INC_TOTAL"]) == (0, 0, 0)
    assert row["MES_01"] is None and row["GRUPO"] == "" and row["DATA_BAIXA"] is None
    assert (row["IRREGULARIDADE"], row["CLASSIFICACAO_IRREG"]) == (311, "C300")


def test_class_keeps_source_text_of_unknown_codes(spark):
    rows = raw_increment(spark, IRREGULARIDADE="999", CLASSIFICACAO_IRREG=" REGU ")
    assert clean_increment(rows).first()["CLASSIFICACAO_IRREG"] == "REGU"
    missing = clean_increment(raw_increment(spark)).first()["CLASSIFICACAO_IRREG"]
    kept = clean_increment(raw_increment(spark), keep_missing_class=True)
    assert (missing, kept.first()["CLASSIFICACAO_IRREG"]) == ("", None)


def test_missing_columns_are_all_named(spark):
    raw = raw_increment(spark).drop("INC_TOTAL", "NOTA")
    with pytest.raises(KeyError, match="NOTA.*INC_TOTAL"):
        clean_increment(raw)


def test_clean_reports_drops_rows_without_unit(spark):
    rows = [
        ("0012", "109.0", "2026-01-02", "", "T"),
        ("000", "109", "2026-01-02", None, "T"),
        (None, "109", None, None, None),
    ]
    names = "`UC / MD` string, COD string, DATA_EXECUCAO string, `DATA BAIXADO` string, EQUIPE string"
    got = clean_reports(spark.createDataFrame(rows, names)).collect()
    assert [tuple(r) for r in got] == [
        (12, 109, date(2026, 1, 2), None, "T", datetime(2026, 1, 2))
    ]
