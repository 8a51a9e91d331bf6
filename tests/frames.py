"""Small hand-made increments and reports."""

from datetime import date

from tallymill.schema import INCREMENT_SCHEMA, MONTHS, REPORT_SCHEMA


def day(text):
    return None if text is None else date.fromisoformat(text)


def inc(unit=1, code=109, exec=None, baixa=None, cls="", group="BAIXA TENSAO", total=5, nota="n"):
    row = dict.fromkeys(MONTHS)
    return row | {
        "GRUPO": group, "PROJETO": "p", "CMPT": 202601, "NOTA": nota, "INSTALACAO": unit,
        "DATA_EXECUCAO": day(exec), "DATA_BAIXA": day(baixa), "CLASSIFICACAO_IRREG": cls,
        "IRREGULARIDADE": code, "INC_TOTAL": total,
    }


def rep(unit=1, code=109, exec=None, baixa=None, team="T"):
    return (unit, code, day(exec), day(baixa), team)


def increments(spark, *rows):
    names = INCREMENT_SCHEMA.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], INCREMENT_SCHEMA)


def reports(spark, *rows):
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)
