"""Schemas, names and other values that must equal the reference's.

Fixed values (must match the reference for identical results):
  - default measure prefixes: qt_stat, kg_net, fob_, freight_, insurance_, cif_
  - standard rename map from the official column names, lower-cased:
      year <- co_ano, month <- co_mes, country_code <- co_pais,
      country_name <- no_pais_ing, block_code <- co_bloco, hs4 <- sh4,
      mun_code <- co_mun, state_abb <- sg_uf_mun, block_name <- no_bloco_ing,
      qt_stat <- qt_estat, kg_net <- kg_liquido, fob_usd <- vl_fob,
      freight_usd <- vl_frete, insurance_usd <- vl_seguro,
      number_of_lines <- numero_linhas, file <- arquivo
  - measures cast to 64-bit integers: qt_stat, kg_net, fob_usd, freight_usd, insurance_usd
  - measures compared by the reconciliation: qt_stat, kg_net, fob_usd, freight_usd,
    insurance_usd, number_of_lines
  - deflator series start: 1997-01-01
  - month labels of the fiscal sheet: JAN FEV MAR ABR MAIO JUN JUL AGO SET OUT NOV DEZ
  - raw CSV format: ';' separator, header line, latin1 encoding, decimal comma
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
DEFAULT_PREFIXES = ("qt_stat", "kg_net", "fob_", "freight_", "insurance_", "cif_")

RENAME = {
    "co_ano": "year", "co_mes": "month", "co_pais": "country_code",
    "no_pais_ing": "country_name", "co_bloco": "block_code", "sh4": "hs4",
    "co_mun": "mun_code", "sg_uf_mun": "state_abb", "no_bloco_ing": "block_name",
    "qt_estat": "qt_stat", "kg_liquido": "kg_net", "vl_fob": "fob_usd",
    "vl_frete": "freight_usd", "vl_seguro": "insurance_usd",
    "numero_linhas": "number_of_lines", "arquivo": "file",
}
LONG_MEASURES = ("qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd")
CHECK_MEASURES = ("qt_stat", "kg_net", "fob_usd", "freight_usd", "insurance_usd", "number_of_lines")
DEFLATOR_START = "1997-01-01"
MONTH_LABELS = ("JAN", "FEV", "MAR", "ABR", "MAIO", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ")
# official fact files: imp_YYYY.csv, exp_YYYY.csv (municipality: _mun), as a file or a folder of part files
OFFICIAL_PATH = r"(?i)/(?:file=)?(imp|exp)_([0-9]+)((?:_mun)?)\.csv(?:/part-[^/]*)?$"
# the same by kind of file: NCM facts, and municipality facts by HS4 heading
OFFICIAL_NAMES = {"ncm": r"(?:file=)?(imp|exp)_([0-9]+)\.csv", "hs4": r"(?:file=)?(imp|exp)_([0-9]+)_mun\.csv"}
# header of the NCM files, in file order (exports end before freight and insurance)
NCM_HEADER = ("CO_ANO", "CO_MES", "CO_NCM", "CO_UNID", "CO_PAIS", "SG_UF_NCM", "CO_VIA", "CO_URF",
              "QT_ESTAT", "KG_LIQUIDO", "VL_FOB", "VL_FRETE", "VL_SEGURO")
# message of the code check
INVALID_CODES = "Not all NCMs valid or NA!"
CSV_OPTIONS = {"sep": ";", "header": "true", "encoding": "ISO-8859-1"}
# -----------------------------------------------------------------------------

_I, _L, _S, _D = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# NCM fact as landed: columns by position, header skipped by name.
NCM_EXP_FIELDS = [
    ("year", _I), ("month", _I), ("ncm", _S), ("unit_code", _I), ("country_code", _I),
    ("state_abb", _S), ("transp_mode_code", _I), ("urf_code", _I),
    ("qt_stat", _L), ("kg_net", _L), ("fob_usd", _L),
]
NCM_IMP_FIELDS = NCM_EXP_FIELDS + [("freight_usd", _L), ("insurance_usd", _L)]
NCM_EXP_SCHEMA = _struct(NCM_EXP_FIELDS)
NCM_IMP_SCHEMA = _struct(NCM_IMP_FIELDS)

# HS4 fact as landed (official header names).
HS4_RAW_SCHEMA = _struct([
    ("CO_ANO", _I), ("CO_MES", _I), ("SH4", _S), ("CO_PAIS", _I), ("SG_UF_MUN", _S),
    ("CO_MUN", _I), ("KG_LIQUIDO", _L), ("VL_FOB", _L),
])

# Control-total files: file name as string, every other column a number,
# read as decimal so that a decimal comma parses and no digit is lost.
_CTRL_IMP = ["ARQUIVO", "CO_ANO", "QT_ESTAT", "KG_LIQUIDO", "VL_FOB", "VL_FRETE", "VL_SEGURO", "NUMERO_LINHAS"]
_CTRL_EXP = ["ARQUIVO", "CO_ANO", "QT_ESTAT", "KG_LIQUIDO", "VL_FOB", "NUMERO_LINHAS"]
_CTRL_MUN = ["ARQUIVO", "CO_ANO", "KG_LIQUIDO", "VL_FOB", "NUMERO_LINHAS"]
CONTROL_COLUMNS = {
    "imp_totais_conferencia": _CTRL_IMP,
    "exp_totais_conferencia": _CTRL_EXP,
    "imp_totais_conferencia_mun": _CTRL_MUN,
    "exp_totais_conferencia_mun": _CTRL_MUN,
}


def control_schema(table: str, decimal: bool = True) -> T.StructType | None:
    cols = CONTROL_COLUMNS.get(table)
    if cols is None:
        return None
    num = T.DecimalType(38, 6) if decimal else _D
    return _struct([(c, _S if c == "ARQUIVO" else num) for c in cols])
