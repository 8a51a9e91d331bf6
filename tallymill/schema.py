"""Column contracts and the fixed values of the domain."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# They must read exactly like this for results to be right.

MONTHS = [f"MES_{m:02d}" for m in range(1, 13)]

INCREMENT_COLUMNS = [
    "GRUPO", "PROJETO", "CMPT", "NOTA", "INSTALACAO",
    "DATA_EXECUCAO", "DATA_BAIXA", "CLASSIFICACAO_IRREG", "IRREGULARIDADE",
    *MONTHS, "INC_TOTAL",
]

MATCH_COLUMNS = ["EQUIPE", "MATCH_OK", "REGRA_ORIGEM", "MOTIVO_PENDENCIA"]

RESULT_COLUMNS = [
    "GRUPO", "PROJETO", "CMPT", "NOTA", "INSTALACAO",
    "DATA_EXECUCAO", "DATA_BAIXA", "CLASSIFICACAO_IRREG", "IRREGULARIDADE",
    *MATCH_COLUMNS, *MONTHS, "INC_TOTAL",
]

# Irregularity code -> class.
CODE_CLASS = {
    109: "C100", 115: "C100", 129: "C100", 154: "REGU", 164: "C100",
    165: "C100", 168: "C100", 171: "C100", 172: "C100", 174: "C100",
    175: "REGU", 176: "C100", 188: "C100",
    201: "C200", 202: "C200", 203: "C200", 204: "C200", 210: "C200",
    211: "C200", 212: "C200", 214: "C200", 215: "C200", 221: "C200",
    300: "ACAO", 301: "ACAO", 302: "ACAO", 303: "ACAO", 305: "ACAO",
    306: "ACAO", 307: "C300", 308: "C300", 309: "ACAO", 310: "C300",
    311: "C300", 312: "ACAO", 314: "ACAO", 315: "ACAO",
}

NO_MATCH = "SEM_MATCH"
REASON_NO_UNIT = "sem_uc_no_reports"
REASON_MONTH = "mismatch_mes"
REASON_CODE = "mismatch_cod"
REASON_OTHER = "outros"

# Group -> published table, and group -> suffix of its pending export.
GROUP_TABLE = {"BAIXA TENSAO": "increment_bt", "GESTAO CENTRALIZADA": "increment_at"}
GROUP_SUFFIX = {"BAIXA TENSAO": "bt", "GESTAO CENTRALIZADA": "at"}

# Longest text the published tables accept.
TEXT_LIMITS = {"REGRA_ORIGEM": 16, "MOTIVO_PENDENCIA": 32}

# Report column -> name used here.
REPORT_COLUMNS = {
    "UC / MD": "instalacao",
    "COD": "irregularidade",
    "DATA_EXECUCAO": "data_exec_rep",
    "DATA BAIXADO": "data_baixa_rep",
    "EQUIPE": "equipe",
}

# Columns that the published tables are looked up by.
INDEXED = [
    "INSTALACAO", "IRREGULARIDADE", "DATA_EXECUCAO", "DATA_BAIXA",
    "CLASSIFICACAO_IRREG", "MATCH_OK", "MOTIVO_PENDENCIA",
]

# Cell texts a spreadsheet reader takes for a missing value.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Whole texts that count as missing in a text column.
MISSING_TEXTS = ["nan", "None", "NaN"]
# --- End of fixed values ----------------------------------------------------

# Time of data_exec_rep, by which reports of one day are ordered.
EXEC_TIME = "hora_exec_rep"

DATE_COLUMNS = ["DATA_EXECUCAO", "DATA_BAIXA"]
INTEGER_COLUMNS = ["INSTALACAO", "CMPT", "IRREGULARIDADE", "INC_TOTAL"]
TEXT_COLUMNS = ["GRUPO", "PROJETO", "NOTA", "CLASSIFICACAO_IRREG"]


def _increment_type(name: str) -> T.DataType:
    if name in DATE_COLUMNS:
        return T.DateType()
    return T.StringType() if name in TEXT_COLUMNS else T.LongType()


INCREMENT_SCHEMA = T.StructType(
    [T.StructField(c, _increment_type(c)) for c in INCREMENT_COLUMNS]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("instalacao", T.LongType()),
        T.StructField("irregularidade", T.LongType()),
        T.StructField("data_exec_rep", T.DateType()),
        T.StructField("data_baixa_rep", T.DateType()),
        T.StructField("equipe", T.StringType()),
    ]
)

_MATCH_TYPES = {"MATCH_OK": T.BooleanType()}

RESULT_SCHEMA = T.StructType(
    [
        T.StructField(
            c,
            _MATCH_TYPES.get(c, T.StringType())
            if c in MATCH_COLUMNS
            else _increment_type(c),
        )
        for c in RESULT_COLUMNS
    ]
)
