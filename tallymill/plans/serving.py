"""Best increment per report, for reporting tools.

Each report row gets the ``INC_TOTAL`` of one increment of the same unit: one of
the same day and code, else of the same day, else of the same month; the
largest among equals, and 0 when there is none.  Unit and code are compared as
text, so zero-padded text does not match.  One increment may serve many report
rows: a sum over the view can count it more than once.

Increments are reduced to their largest total per unit, day and code before any
join, those to the largest per day, and those per month, so increments are read
once, from the month of the first day on, and no pairs within a unit are formed.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.first_hit import Way, first_hit
from tallymill.sinks.publish import largest_of

# --- Fixed values -----------------------------------------------------------
VIEW_FILTER = "STATUS <> 'CANCELADO' AND REGIONAL = 'SUL' AND GRUPO = 'BT'"
VIEW_SINCE = "2026-01-01"
VIEW_COLUMNS = ["UC / MD", "STATUS", "DATA_EXECUCAO", "COD", "EQUIPE"]
# --- End of fixed values ----------------------------------------------------

_NO_CODE = "<none>"
_KEYS = ["_unit", "_day", "_month", "_code"]


def best_match(reports: DataFrame, increments: DataFrame, since: str = VIEW_SINCE) -> DataFrame:
    """The filtered reports with the total of their best increment."""
    wanted = reports.where(f"{VIEW_FILTER} AND DATA_EXECUCAO >= DATE '{since}'")
    facts = wanted.selectExpr(
        *[f"`{c}`" for c in VIEW_COLUMNS],
        "coalesce(`UC / MD`, '') AS _unit",
        "DATA_EXECUCAO AS _day",
        "trunc(DATA_EXECUCAO, 'MM') AS _month",
        f"coalesce(COD, '{_NO_CODE}') AS _code",
    )
    offers = (
        increments.where(f"DATA_EXECUCAO >= trunc(DATE '{since}', 'MM')")
        .selectExpr(
            "string(INSTALACAO) AS unit",
            "DATA_EXECUCAO AS day",
            "string(IRREGULARIDADE) AS code",
            "INC_TOTAL AS total",
        )
        .where("unit IS NOT NULL")
    )

    def largest(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.groupBy(*columns).agg(F.max("total").alias("total"))

    def way(step: int, rows: DataFrame, *columns: str) -> Way:
        hit = f"named_struct('step', {step}, 'total', total) AS hit"
        return Way(rows.selectExpr(*columns, hit), {c: f"_{c}" for c in columns})

    by_code = largest(offers, "unit", "day", "code")
    by_day = largest(by_code, "unit", "day")
    by_month = largest(by_day.selectExpr("unit", "trunc(day, 'MM') AS month", "total"), "unit", "month")
    ways = [
        way(1, by_code.where("code IS NOT NULL"), "unit", "day", "code"),
        way(2, by_day, "unit", "day"),
        way(3, by_month, "unit", "month"),
    ]
    found = first_hit(facts, _KEYS, ways)
    return found.selectExpr(
        *[f"`{c}`" for c in VIEW_COLUMNS], "coalesce(hit.total, 0) AS INC_TOTAL"
    )


def serving_view_sql(reports: str, increments: str, since: str = VIEW_SINCE) -> str:
    """The same result as SQL text over two tables.

    ``increments`` may be a published table or its largest totals: the largest of the
    largest is the same.  Spark takes the largest totals for smaller than they are, as their
    table has many more columns; hence the merge hint, or they end in a broadcast.
    """
    return f"""
WITH by_code AS (
  SELECT string(INSTALACAO) unit, DATA_EXECUCAO day, string(IRREGULARIDADE) code,
         max(INC_TOTAL) total, true found
  FROM {increments} WHERE DATA_EXECUCAO >= trunc(DATE '{since}', 'MM') GROUP BY 1, 2, 3
),
by_day AS (SELECT unit, day, max(total) total, true found FROM by_code GROUP BY 1, 2),
by_month AS (SELECT unit, trunc(day, 'MM') month, max(total) total FROM by_day GROUP BY 1, 2)
SELECT /*+ MERGE(by_code, by_day, by_month) */
       g.`UC / MD`, g.STATUS, g.DATA_EXECUCAO, g.COD, g.EQUIPE,
       coalesce(CASE WHEN by_code.found THEN by_code.total
                     WHEN by_day.found THEN by_day.total
                     ELSE by_month.total END, 0) INC_TOTAL
FROM {reports} g
LEFT JOIN by_code ON by_code.unit = g.`UC / MD` AND by_code.day = g.DATA_EXECUCAO
                 AND by_code.code = g.COD
LEFT JOIN by_day ON by_day.unit = g.`UC / MD` AND by_day.day = g.DATA_EXECUCAO
LEFT JOIN by_month ON by_month.unit = g.`UC / MD`
                  AND by_month.month = trunc(g.DATA_EXECUCAO, 'MM')
WHERE {VIEW_FILTER.replace("STATUS", "g.STATUS").replace("REGIONAL", "g.REGIONAL")
       .replace("GRUPO", "g.GRUPO")} AND g.DATA_EXECUCAO >= DATE '{since}'
"""


def create_serving_view(
    spark: SparkSession,
    reports: str,
    increments: str = "increment_bt",
    name: str = "vw_increment_bt",
    since: str = VIEW_SINCE,
) -> None:
    """A named view; it is computed when read, so it follows each snapshot.

    On a published table it reads the largest totals that every snapshot carries along,
    a row per unit, day and code, and no increments.
    """
    read = largest_of(spark, increments) or increments
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {serving_view_sql(reports, read, since)}")
