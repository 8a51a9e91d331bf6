"""DuckDB SQL for the registered queries, over the same projections.

Written from the meaning of each operator: one row_number lookup and one left
join per rule, scalar cleaning by DuckDB's own functions, and a lateral top-1
for the view.
"""

from suite.projection import (
    INCREMENTS,
    RAW_INCREMENTS,
    RAW_REPORTS,
    REPORTS,
    VIEW_REPORTS,
)
from tallymill.plans.rules import WATERFALL, null_safe
from tallymill.schema import (
    CODE_CLASS,
    GROUP_TABLE,
    INCREMENT_COLUMNS,
    MATCH_COLUMNS,
    MISSING_CELLS,
    MONTHS,
    RESULT_COLUMNS,
)

Q = '"'
RULE_NAMES = [
    "rule_r1", "rule_r2", "rule_r3", "rule_r4_same_month", "rule_r4_previous_month",
    "rule_r5_same_month", "rule_r5_previous_month", "rule_r4_1", "rule_r5_1",
]


def duck(text):
    return text.replace("{q}", Q)


def class_of(code):
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CODE_CLASS.items())
    return f"CASE {code} {whens} END"


def month(day):
    return f"CAST(date_trunc('month', {day}) AS DATE)"


def month_before(day):
    return f"CAST(date_trunc('month', {day}) - INTERVAL 1 MONTH AS DATE)"


# --- cleaning ---------------------------------------------------------------
def instant(c):
    forms = ["%Y-%m-%d %H:%M:%S.%g", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"]
    tries = [f"try_strptime(replace(trim({c}), 'T', ' '), '{f}')" for f in forms]
    return f"coalesce({', '.join(tries)})"


def date(c):
    return f"CAST({instant(c)} AS DATE)"


def integer(c):
    return f"CAST(TRY_CAST(trim({c}) AS DECIMAL(38,9)) AS BIGINT)"


def strict(c):
    number = f"TRY_CAST(trim({c}) AS DOUBLE)"
    return (
        f"CASE WHEN {number} - floor({number}) < 1e-9"
        f" THEN CAST(round({number}) AS BIGINT) END"
    )


def unit(c):
    return f"TRY_CAST(ltrim(regexp_replace({c}, '[^0-9]', '', 'g'), '0') AS BIGINT)"


def text(c):
    return f"CASE WHEN {c} IS NULL OR {c} IN ('nan', 'None', 'NaN') THEN '' ELSE trim({c}) END"


def parts(c, form):
    return f"try_strptime(replace(replace(trim({c}), '.', '/'), '-', '/'), '{form}')"


# The layouts that the test columns have, and the others with what reads them.
FORMATS = {
    "iso": instant,
    "day first": lambda c: parts(c, "%d/%m/%Y"),
    "month first": lambda c: parts(c, "%m/%d/%Y"),
    "year first": lambda c: f"try_strptime(trim({c}), '%Y/%m/%d')",
    "compact": lambda c: f"try_strptime(trim({c}), '%Y%m%d')",
}


def format_counts(name, column, source):
    """Of these columns none is ambiguous: what reads a text is chosen."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{f}' AS format,"
        f" count(*) FILTER (WHERE trim({column}) <> '') AS n_texts, count({read(column)}) AS n_read,"
        f" count({read(column)}) > 0 AS chosen FROM ({source})"
        for f, read in FORMATS.items()
    )


DATES = [f"{date(c)} AS {c}" for c in ("DATA_EXECUCAO", "DATA_BAIXA")]
INTEGERS = [
    f"coalesce({integer(c)}, 0) AS {c}"
    for c in ("INSTALACAO", "CMPT", "IRREGULARIDADE", "INC_TOTAL")
]
MONTH_INTEGERS = [f"{integer(c)} AS {c}" for c in MONTHS]
TEXTS = [f"{text(c)} AS {c}" for c in ("GRUPO", "PROJETO", "NOTA")]
CLASS_TEXT = f"{text('CLASSIFICACAO_IRREG')} AS CLASSIFICACAO_IRREG"


def from_raw(*columns):
    return f"SELECT {', '.join(columns)} FROM ({RAW_INCREMENTS})"


CLEAN_INCREMENTS = f"""
SELECT * REPLACE (coalesce({class_of("IRREGULARIDADE")}, CLASSIFICACAO_IRREG)
                  AS CLASSIFICACAO_IRREG)
FROM ({from_raw(*DATES, *INTEGERS, *MONTH_INTEGERS, *TEXTS, CLASS_TEXT)})
"""

CLEAN_REPORTS = f"""
SELECT rep_id, {unit('"UC / MD"')} AS instalacao, {strict("COD")} AS irregularidade,
 {date("DATA_EXECUCAO")} AS data_exec_rep, {date('"DATA BAIXADO"')} AS data_baixa_rep,
 EQUIPE AS equipe, {instant("DATA_EXECUCAO")} AS hora_exec_rep
FROM ({duck(RAW_REPORTS)}) WHERE {unit('"UC / MD"')} IS NOT NULL
"""

SNAPSHOT = "SELECT {} FROM ({})".format(
    ", ".join(
        f"CASE WHEN {c} NOT IN ({', '.join(repr(w) for w in MISSING_CELLS)}) THEN {c} END AS {c}"
        for c in [*INCREMENT_COLUMNS, "COLUNA_EXTRA"]
    ),
    RAW_INCREMENTS,
)

# --- reconciliation ---------------------------------------------------------
CLASSED = f"""
SELECT * EXCLUDE (SRC_CLASSIF),
 coalesce({class_of("IRREGULARIDADE")}, SRC_CLASSIF) AS CLASSIFICACAO_IRREG
FROM ({INCREMENTS})
"""
CLASSED_MISSING = CLASSED.replace(", SRC_CLASSIF)", ", nullif(SRC_CLASSIF, ''))")

_ORDER = "ORDER BY data_exec_rep DESC NULLS LAST, rep_id"
_TIMED = "ORDER BY hora_exec_rep DESC NULLS LAST, rep_id"


def waterfall(inc=CLASSED, rep=REPORTS, rules=WATERFALL, order=_ORDER):
    """CTEs ending in ``found``: increments, winning step, its report, reason."""
    ctes = [
        f"inc AS ({inc})",
        f"rep AS (SELECT *, {class_of('irregularidade')} AS class,"
        f" {month('data_exec_rep')} AS exec, {month('data_baixa_rep')} AS baixa FROM ({rep}))",
        "codes AS (SELECT DISTINCT instalacao, irregularidade FROM rep"
        " WHERE irregularidade IS NOT NULL)",
        "classes AS (SELECT DISTINCT instalacao, class FROM rep WHERE class IS NOT NULL)",
        "units AS (SELECT DISTINCT instalacao FROM rep)",
    ]
    joins, step, team, day, code = "", "CASE", "CASE step", "CASE step", "CASE step"
    columns = []
    for k, rule in enumerate(rules, start=1):
        attr = "irregularidade" if rule.by == "code" else "class"
        keys = f"instalacao, {attr}, {rule.rep_month}"
        base = "WHERE data_baixa_rep IS NULL" if rule.open_only else ""
        ctes.append(
            f"l{k} AS (SELECT * FROM rep {base}"
            f" QUALIFY row_number() OVER (PARTITION BY {keys} {order}) = 1)"
        )
        inc_day = "i.DATA_EXECUCAO" if rule.inc_month == "exec" else "i.DATA_BAIXA"
        same = "IS NOT DISTINCT FROM" if rule.null_safe else "="
        what = (
            f"l{k}.irregularidade = i.IRREGULARIDADE AND i.IRREGULARIDADE <> 0"
            if rule.by == "code"
            else f"l{k}.class {same} i.CLASSIFICACAO_IRREG"
        )
        when = month_before(inc_day) if rule.lag else month(inc_day)
        joins += (
            f"\nLEFT JOIN l{k} ON l{k}.instalacao = i.INSTALACAO AND {what}"
            f" AND l{k}.{rule.rep_month} = {when}"
        )
        step += f" WHEN l{k}.equipe IS NOT NULL THEN {k}"
        columns.append(f"l{k}.equipe AS e{k}, l{k}.data_exec_rep AS d{k}, l{k}.irregularidade AS c{k}")
        team += f" WHEN {k} THEN e{k}"
        day += f" WHEN {k} THEN d{k}"
        code += f" WHEN {k} THEN c{k}"
    rule_id = "CASE step " + " ".join(
        f"WHEN {k} THEN '{r.id}'" for k, r in enumerate(rules, start=1)
    )
    ctes.append(
        f"joined AS (SELECT i.*, {step} END AS step, {', '.join(columns)},"
        " u.instalacao IS NOT NULL AS has_unit, k.instalacao IS NOT NULL AS has_code,"
        " c.instalacao IS NOT NULL AS has_class"
        f"\nFROM inc i {joins}"
        "\nLEFT JOIN units u ON u.instalacao = i.INSTALACAO"
        "\nLEFT JOIN codes k ON k.instalacao = i.INSTALACAO"
        " AND k.irregularidade = i.IRREGULARIDADE"
        "\nLEFT JOIN classes c ON c.instalacao = i.INSTALACAO"
        " AND c.class = i.CLASSIFICACAO_IRREG)"
    )
    ctes.append(
        f"found AS (SELECT * REPLACE ("
        f"coalesce(DATA_EXECUCAO, {day} END) AS DATA_EXECUCAO,"
        f" CASE WHEN step IS NOT NULL AND IRREGULARIDADE = 0 THEN {code} END"
        " ELSE IRREGULARIDADE END AS IRREGULARIDADE),"
        f" IRREGULARIDADE AS source_code, DATA_EXECUCAO AS source_day,"
        f" {team} END AS EQUIPE, step IS NOT NULL AS MATCH_OK,"
        f" coalesce({rule_id} END, 'SEM_MATCH') AS REGRA_ORIGEM,"
        " CASE WHEN step IS NOT NULL THEN NULL WHEN NOT has_unit THEN 'sem_uc_no_reports'"
        " WHEN has_code THEN 'mismatch_mes' WHEN has_class THEN 'mismatch_cod'"
        " ELSE 'outros' END AS MOTIVO_PENDENCIA FROM joined)"
    )
    return "WITH " + ",\n".join(ctes)


RESULT = ", ".join(RESULT_COLUMNS)
ALONE = (
    "GRUPO, INSTALACAO, IRREGULARIDADE, CLASSIFICACAO_IRREG, DATA_EXECUCAO, DATA_BAIXA,"
    " INC_TOTAL, EQUIPE, MATCH_OK"
)


def reconciled(columns=RESULT, tail="", **parts):
    return f"{waterfall(**parts)}\nSELECT {columns} FROM found {tail}"


def table_rows(result, table=None):
    """Result rows under the name of the table their group goes to."""
    whens = " ".join(
        f"WHEN '{g}' THEN '{t}'" for g, t in GROUP_TABLE.items() if table in (None, t)
    )
    return (
        f"SELECT * FROM (SELECT CASE GRUPO {whens} END AS tabela, * FROM ({result}))"
        " WHERE tabela IS NOT NULL"
    )


def _tried(k, rule):
    day = "source_day" if rule.inc_month == "exec" else "DATA_BAIXA"
    usable = f"{day} IS NOT NULL" + (" AND source_code <> 0" if rule.by == "code" else "")
    return f"count(*) FILTER (WHERE coalesce(step, 10) >= {k} AND {usable})"


RULE_METRICS = waterfall() + "\n" + "\nUNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS step, '{r.id}' AS rule, {_tried(k, r)} AS tried,"
    f" count(*) FILTER (WHERE step = {k}) AS resolved FROM found"
    for k, r in enumerate(WATERFALL, start=1)
)

FULL = reconciled()
FIRST_RULE = reconciled(rules=WATERFALL[:1])

_DAILY = reconciled(inc=CLEAN_INCREMENTS, rep=CLEAN_REPORTS, order=_TIMED)
_ROUTED = ", ".join(f"'{g}'" for g in GROUP_TABLE)
_COUNTS = {
    "rows": "count(*)",
    "matched": "count(*) FILTER (WHERE MATCH_OK)",
    "pending": "count(*) FILTER (WHERE NOT MATCH_OK)",
    "unrouted": f"count(*) FILTER (WHERE GRUPO NOT IN ({_ROUTED}))",
    **{
        f"rule {r}": f"count(*) FILTER (WHERE REGRA_ORIGEM = '{r}')"
        for r in ("R1", "R2", "R3", "R4", "R5", "R4-1", "R5-1", "SEM_MATCH")
    },
    **{f"table {t}": f"count(*) FILTER (WHERE GRUPO = '{g}')" for g, t in GROUP_TABLE.items()},
    **{
        f"export {t[-2:]}": f"count(*) FILTER (WHERE GRUPO = '{g}' AND NOT MATCH_OK)"
        for g, t in GROUP_TABLE.items()
    },
}
LEDGER = (
    f"WITH done AS ({_DAILY}), raw AS ({RAW_INCREMENTS}), said AS ("
    + " UNION ALL ".join(
        [f"SELECT '{name}' AS name, {sql} AS count FROM done" for name, sql in _COUNTS.items()]
        + [
            f"SELECT 'unread {c}', count(*) FILTER (WHERE {date(c)} IS NULL AND trim({c}) <> '') FROM raw"
            for c in ("DATA_EXECUCAO", "DATA_BAIXA")
        ]
        + [f"SELECT 'reports', count(*) FROM ({CLEAN_REPORTS})"]
    )
    + ") SELECT name, count, CAST(2 AS BIGINT) AS runs FROM said"
)

VIEW_DAY = "1998-01-01"
# Every increment of a report's unit and month is a candidate; how near it is
# to the report, and then its total, ranks it.
VIEW = f"""
WITH asked AS (
 SELECT *, row_number() OVER () AS ask, {month("DATA_EXECUCAO")} AS mes
 FROM ({duck(VIEW_REPORTS)})
 WHERE STATUS <> 'CANCELADO' AND REGIONAL = 'SUL' AND GRUPO = 'BT'
   AND DATA_EXECUCAO >= DATE '{VIEW_DAY}'
),
offered AS (
 SELECT CAST(INSTALACAO AS VARCHAR) AS uc, CAST(IRREGULARIDADE AS VARCHAR) AS code,
  DATA_EXECUCAO AS dia, {month("DATA_EXECUCAO")} AS mes, INC_TOTAL FROM ({{inc}})
),
ranked AS (
 SELECT ask, o.INC_TOTAL, row_number() OVER (PARTITION BY ask ORDER BY
   (o.dia = a.DATA_EXECUCAO)::INT + (o.dia = a.DATA_EXECUCAO AND coalesce(o.code = a.COD, FALSE))::INT DESC,
   o.INC_TOTAL DESC NULLS LAST) AS place
 FROM asked a JOIN offered o ON o.uc = a."UC / MD" AND o.mes = a.mes
)
SELECT a."UC / MD", a.STATUS, a.DATA_EXECUCAO, a.COD, a.EQUIPE,
 coalesce(r.INC_TOTAL, 0) AS INC_TOTAL
FROM asked a LEFT JOIN ranked r ON r.ask = a.ask AND r.place = 1
"""

# A lookup on each indexed column.
LOOKUPS = {
    "unit": "INSTALACAO = 7",
    "code": "IRREGULARIDADE = 307",
    "executed": "DATA_EXECUCAO BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'",
    "closed": "DATA_BAIXA = DATE '1996-05-02'",
    "class": "CLASSIFICACAO_IRREG = 'C300'",
    "matched": "MATCH_OK",
    "reason": "MOTIVO_PENDENCIA = 'mismatch_cod'",
}

REP = f"(SELECT *, {class_of('irregularidade')} AS classificacao FROM ({REPORTS}))"
_REP_MONTH = (
    f"SELECT *, {month('data_exec_rep')} AS mes_ano_exec FROM {REP}"
)


def keep_first(keys, where=""):
    return (
        f"SELECT * FROM ({_REP_MONTH}) {where}"
        f" QUALIFY row_number() OVER (PARTITION BY {keys} {_ORDER}) = 1"
    )


def oracle_sql():
    sql = {
        "scan_project_rename": (
            "SELECT * REPLACE (strftime(hora_exec_rep, '%Y-%m-%d %H:%M:%S.%g') AS hora_exec_rep)"
            f" FROM ({CLEAN_REPORTS})"
        ),
        "clean_dates": from_raw("NOTA", *DATES),
        "date_formats": " UNION ALL ".join(
            [format_counts(c, c, RAW_INCREMENTS) for c in ("DATA_EXECUCAO", "DATA_BAIXA")]
            + [
                format_counts(f"rep {c}", f'"{c}"', duck(RAW_REPORTS))
                for c in ("DATA_EXECUCAO", "DATA BAIXADO")
            ]
        ),
        "clean_dates_detected": from_raw(
            "NOTA",
            *[
                f"CAST(coalesce({instant(c)}, {parts(c, '%d/%m/%Y')}) AS DATE) AS {c}"
                for c in ("DATA_EXECUCAO", "DATA_BAIXA")
            ],
        ),
        "clean_int_zero": from_raw("NOTA", *INTEGERS),
        "clean_int_null": from_raw("NOTA", *MONTH_INTEGERS),
        "clean_int_strict": (
            f"SELECT rep_id, {strict('COD')} AS irregularidade FROM ({duck(RAW_REPORTS)})"
        ),
        "clean_uc": (
            f"SELECT rep_id, {unit(chr(34) + 'UC / MD' + chr(34))} AS instalacao"
            f" FROM ({duck(RAW_REPORTS)})"
        ),
        "clean_text": from_raw(*TEXTS, CLASS_TEXT),
        "clean_increment": CLEAN_INCREMENTS,
        "class_map": (
            f"SELECT rep_id, irregularidade, {class_of('irregularidade')} AS classificacao"
            f" FROM ({REPORTS})"
        ),
        "class_normalise": (
            "SELECT NOTA, IRREGULARIDADE, SRC_CLASSIF,"
            f" coalesce({class_of('IRREGULARIDADE')}, SRC_CLASSIF) AS CLASSIFICACAO_IRREG"
            f" FROM ({INCREMENTS})"
        ),
        "month_keys": (
            f"SELECT NOTA, {month('DATA_EXECUCAO')} AS mes_ano_exec,"
            f" {month('DATA_BAIXA')} AS mes_ano_baixa,"
            f" {month_before('DATA_BAIXA')} AS mes_anterior FROM ({INCREMENTS})"
        ),
        "dedup_keep_first": keep_first("instalacao, irregularidade, mes_ano_exec"),
        "dedup_keep_first_no_baixa": keep_first(
            "instalacao, classificacao, mes_ano_exec", "WHERE data_baixa_rep IS NULL"
        ),
        "reconcile": FULL,
        "reconcile_kept": FULL,
        "reconcile_null_safe": reconciled(inc=CLASSED_MISSING, rules=null_safe()),
        "uc_profiles": (
            "SELECT instalacao,"
            " coalesce(array_to_string(list_sort(list(DISTINCT irregularidade)"
            " FILTER (WHERE irregularidade IS NOT NULL)), ','), '') AS codes,"
            " coalesce(array_to_string(list_sort(list(DISTINCT classificacao)"
            " FILTER (WHERE classificacao IS NOT NULL)), ','), '') AS classes"
            f" FROM {REP} GROUP BY instalacao"
        ),
        "pending_reasons": reconciled(
            "INSTALACAO, IRREGULARIDADE, CLASSIFICACAO_IRREG, MATCH_OK, MOTIVO_PENDENCIA"
        ),
        "rule_metrics": RULE_METRICS,
        "group_counts": reconciled(
            "GRUPO, count(*) AS n_rows, count(*) FILTER (WHERE MATCH_OK) AS matched,"
            " count(*) FILTER (WHERE NOT MATCH_OK) AS pending",
            "GROUP BY GRUPO",
        ),
        "open_report_count": (
            "SELECT count(*) AS reports, count(*) FILTER (WHERE data_baixa_rep IS NULL)"
            f" AS open_reports FROM ({REPORTS})"
        ),
        "pending_export": reconciled(
            ", ".join([*INCREMENT_COLUMNS, *MATCH_COLUMNS])
            + ", CASE GRUPO WHEN 'BAIXA TENSAO' THEN 'bt' ELSE 'at' END AS grupo_sufixo",
            "WHERE NOT MATCH_OK AND GRUPO IN ('BAIXA TENSAO', 'GESTAO CENTRALIZADA')",
        ),
        "final_projection": reconciled(),
        "publish_replace": table_rows(FULL),
        "publish_append": f"{table_rows(FIRST_RULE)} UNION ALL {table_rows(FULL)}",
        "publish_routing": (
            f"SELECT tabela, GRUPO, count(*) AS n_rows FROM ({table_rows(FULL)}) GROUP BY ALL"
        ),
        "publish_empty_group": (
            f"{table_rows(FIRST_RULE, 'increment_bt')} UNION ALL"
            f" {table_rows(FULL, 'increment_at')}"
        ),
        "publish_layout": table_rows(FULL),
        "publish_curve_layout": table_rows(FULL),
        "layout_lookups": " UNION ALL ".join(
            f"SELECT tabela, count(*) AS n_rows, CAST(sum(INC_TOTAL) AS BIGINT) AS total,"
            f" '{name}' AS lookup FROM ({table_rows(FULL)}) WHERE {sql} GROUP BY tabela"
            for name, sql in LOOKUPS.items()
        ),
        "publish_uncommitted": table_rows(FIRST_RULE),
        "publish_append_repeated": f"{table_rows(FIRST_RULE)} UNION ALL {table_rows(FULL)}",
        "largest_totals": (
            "SELECT tabela, INSTALACAO, DATA_EXECUCAO, IRREGULARIDADE, max(INC_TOTAL) AS INC_TOTAL"
            f" FROM ({table_rows(FULL)}) WHERE INSTALACAO IS NOT NULL AND DATA_EXECUCAO IS NOT NULL"
            " GROUP BY ALL"
        ),
        "serving_view_of_loads": VIEW.replace(
            "{inc}", f"SELECT * FROM ({FULL}) WHERE GRUPO = 'BAIXA TENSAO'"
        ),
        "daily_ledger": LEDGER,
        "best_match_view": VIEW.replace("{inc}", CLASSED),
        "serving_view": VIEW.replace(
            "{inc}", f"SELECT * FROM ({FULL}) WHERE GRUPO = 'BAIXA TENSAO'"
        ),
        "snapshot_scan": SNAPSHOT,
        "daily_run": table_rows(
            reconciled(inc=CLEAN_INCREMENTS, rep=CLEAN_REPORTS, order=_TIMED)
        ),
    }
    for name, rule in zip(RULE_NAMES, WATERFALL):
        sql[name] = reconciled(ALONE, rules=[rule])
    return sql
