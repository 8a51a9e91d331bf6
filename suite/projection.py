"""The star-schema test tables seen as increments and reports.

Each text is plain SQL that Spark and DuckDB both run over views ``orders`` and
``lineitem``; ``{q}`` is the quote of identifiers.
"""

from pyspark.sql import functions as F

from tallymill.functions.domain import normalised_class
from tallymill.schema import INCREMENT_COLUMNS

CODE = """CASE {key} WHEN 0 THEN 109 WHEN 1 THEN 175 WHEN 2 THEN 201 WHEN 3 THEN 202
   WHEN 4 THEN 301 WHEN 5 THEN 307 WHEN 6 THEN 311 WHEN 7 THEN 999 ELSE 0 END"""

REPORTS = f"""
SELECT o_orderkey rep_id,
 CASE WHEN o_custkey%10=0 THEN o_custkey + 10000000 ELSE o_custkey END instalacao,
 CAST({CODE.format(key="o_orderkey % 8")} AS BIGINT) irregularidade,
 CASE WHEN o_orderkey%23=0 THEN NULL ELSE CAST(o_orderdate AS DATE) END data_exec_rep,
 CASE WHEN o_orderstatus='O' THEN NULL
      ELSE CAST(o_orderdate + INTERVAL 20 DAY AS DATE) END data_baixa_rep,
 CASE WHEN o_orderkey%17=0 THEN NULL ELSE o_orderpriority END equipe
FROM orders
"""

_MONTHS = ",\n ".join(
    f"CASE WHEN (l_partkey + {m}) % 5 = 0 THEN NULL"
    f" ELSE CAST(l_quantity AS BIGINT) * {m} END MES_{m:02d}"
    for m in range(1, 13)
)

# SRC_CLASSIF is the class text of the source; the class proper is added by
# the function under test, or by CLASS in SQL.
INCREMENTS = f"""
SELECT CASE WHEN l_linenumber=7 THEN 'OUTROS' WHEN l_linestatus='O' THEN 'BAIXA TENSAO'
            ELSE 'GESTAO CENTRALIZADA' END GRUPO,
 concat('PRJ', CAST(l_suppkey % 50 AS STRING)) PROJETO,
 CAST(year(l_shipdate)*100 + month(l_shipdate) AS BIGINT) CMPT,
 CAST(l_orderkey AS STRING) NOTA,
 o_custkey INSTALACAO,
 CASE WHEN l_returnflag='A' THEN NULL ELSE CAST(l_shipdate AS DATE) END DATA_EXECUCAO,
 CASE WHEN l_linenumber=6 THEN NULL
      ELSE CAST(l_shipdate + INTERVAL 20 DAY AS DATE) END DATA_BAIXA,
 CAST({CODE.format(key="l_partkey % 9")} AS BIGINT) IRREGULARIDADE,
 CASE l_suppkey % 6 WHEN 0 THEN 'C100' WHEN 1 THEN 'REGU' WHEN 2 THEN 'C200'
   WHEN 3 THEN 'ACAO' WHEN 4 THEN 'C300' ELSE '' END SRC_CLASSIF,
 {_MONTHS},
 CAST(l_quantity AS BIGINT) INC_TOTAL
FROM lineitem JOIN orders ON l_orderkey=o_orderkey
"""

RAW_REPORTS = f"""
SELECT o_orderkey rep_id,
 CASE WHEN o_custkey%10=0 THEN '000' WHEN o_custkey%13=0 THEN NULL
      WHEN o_custkey%7=0 THEN concat(' UC-', lpad(CAST(o_custkey AS STRING),8,'0'), ' ')
      ELSE lpad(CAST(o_custkey AS STRING),10,'0') END {{q}}UC / MD{{q}},
 CASE o_orderkey % 11 WHEN 0 THEN 'x9' WHEN 1 THEN '109.5' WHEN 2 THEN '3.11e2'
      WHEN 3 THEN NULL WHEN 4 THEN ' 175 ' WHEN 5 THEN '0201' WHEN 6 THEN '307.0'
      ELSE CAST({CODE.format(key="o_orderkey % 8")} AS STRING) END COD,
 CASE WHEN o_orderkey%23=0 THEN NULL WHEN o_orderkey%29=0 THEN '31/12/2025'
      WHEN o_orderkey%3=0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
      ELSE concat(CAST(CAST(o_orderdate AS DATE) AS STRING), CASE o_orderkey%7
        WHEN 0 THEN 'T08:00:00' WHEN 1 THEN ' 17:30' WHEN 2 THEN ' 08:00:00.125'
        WHEN 3 THEN 'T23:59:59.999' WHEN 4 THEN ' 00:00:00' ELSE ' 12:34:56' END)
      END DATA_EXECUCAO,
 CASE WHEN o_orderstatus='O' THEN '' ELSE CAST(o_orderdate + INTERVAL 20 DAY AS STRING)
      END {{q}}DATA BAIXADO{{q}},
 CASE WHEN o_orderkey%17=0 THEN NULL ELSE o_orderpriority END EQUIPE
FROM orders
"""

RAW_INCREMENTS = """
SELECT CASE WHEN l_linenumber=7 THEN NULL WHEN l_linestatus='O' THEN ' BAIXA TENSAO '
            ELSE 'GESTAO CENTRALIZADA' END GRUPO,
 CASE l_linenumber WHEN 1 THEN 'nan' WHEN 2 THEN 'None' WHEN 3 THEN NULL
      WHEN 4 THEN ' None ' ELSE concat(' PRJ', CAST(l_suppkey AS STRING)) END PROJETO,
 CASE WHEN l_linenumber=5 THEN ''
      ELSE CAST(year(l_shipdate)*100+month(l_shipdate) AS STRING) END CMPT,
 lpad(CAST(l_orderkey AS STRING),12,'0') NOTA,
 CASE WHEN o_custkey%50=0 THEN 'SEM UC'
      ELSE lpad(CAST(o_custkey AS STRING),10,'0') END INSTALACAO,
 CASE WHEN l_returnflag='A' THEN '' ELSE CAST(l_shipdate AS STRING) END DATA_EXECUCAO,
 CASE WHEN l_linenumber=6 THEN '31/12/2025'
      ELSE concat(CAST(CAST(l_shipdate + INTERVAL 20 DAY AS DATE) AS STRING),
        CASE l_partkey%3 WHEN 0 THEN 'T07:08:09' WHEN 1 THEN ' 07:08:09.5' ELSE '' END)
      END DATA_BAIXA,
 CASE l_suppkey % 6 WHEN 0 THEN ' C100 ' WHEN 1 THEN 'REGU' WHEN 2 THEN 'C200'
   WHEN 3 THEN 'NaN' WHEN 4 THEN NULL ELSE 'ACAO' END CLASSIFICACAO_IRREG,
 CASE WHEN l_partkey%9=8 THEN NULL
      ELSE lpad(CAST(300 + l_partkey%9 AS STRING),4,'0') END IRREGULARIDADE,
 """ + ",\n ".join(
    f"CASE WHEN l_linenumber=1 THEN 'n/a'"
    f" ELSE CAST(CAST(l_quantity AS BIGINT) * {m} AS STRING) END MES_{m:02d}"
    for m in range(1, 13)
) + """,
 CASE WHEN l_linenumber=2 THEN '1e3' ELSE CAST(l_quantity AS STRING) END INC_TOTAL,
 'x' COLUNA_EXTRA
FROM lineitem JOIN orders ON l_orderkey=o_orderkey
"""

# Reports as the serving view reads them: unit and code are text.
VIEW_REPORTS = f"""
SELECT r.rep_id, CAST(r.instalacao AS STRING) {{q}}UC / MD{{q}},
 CAST(r.irregularidade AS STRING) COD, r.data_exec_rep DATA_EXECUCAO, r.equipe EQUIPE,
 CASE WHEN rep_id%19=0 THEN NULL WHEN o_orderstatus='F' THEN 'CANCELADO' ELSE 'OK' END STATUS,
 CASE WHEN o_custkey%2=0 THEN 'SUL' ELSE 'NORTE' END REGIONAL,
 CASE WHEN o_orderkey%3=0 THEN 'AT' ELSE 'BT' END GRUPO
FROM ({REPORTS}) r JOIN orders o ON o.o_orderkey = r.rep_id
"""


def scan(spark, sf_dir, text):
    """Run one of the texts on Spark, without leaving views behind."""
    names = [t for t in ("orders", "lineitem") if f"FROM {t}" in text or f"JOIN {t}" in text]
    for name in names:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
        text = text.replace(f"JOIN {name}", f"JOIN {{{name}}}")
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
    return spark.sql(text.replace("{q}", "`"), **frames)


def raw_increments(spark, sf_dir):
    return scan(spark, sf_dir, RAW_INCREMENTS)


def raw_reports(spark, sf_dir):
    return scan(spark, sf_dir, RAW_REPORTS)


def reports(spark, sf_dir):
    return scan(spark, sf_dir, REPORTS)


def increments(spark, sf_dir, keep_missing_class=False):
    source = "nullif(SRC_CLASSIF, '')" if keep_missing_class else "SRC_CLASSIF"
    named = normalised_class(F.col("IRREGULARIDADE"), F.expr(source))
    rows = scan(spark, sf_dir, INCREMENTS).withColumn("CLASSIFICACAO_IRREG", named)
    return rows.select(INCREMENT_COLUMNS)


def view_reports(spark, sf_dir):
    return scan(spark, sf_dir, VIEW_REPORTS)
