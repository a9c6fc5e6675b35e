"""Region names: cleaning, canonical spelling and the code table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakerisk.functions.text import first_match, strip_space

# Spelling variants after cleaning, canonical names, code table,
# month-name variants. They must equal the published sources for right results.
REGION_VARIANTS = {
    "LIMA METROPOLITANA": "LIMA",
    "LIMA PROVINCIAS": "LIMA",
    "PROVINCIA DE LIMA": "LIMA",
    "PROV. CONST. DEL CALLAO": "CALLAO",
    "PROVINCIA CONSTITUCIONAL DEL CALLAO": "CALLAO",
    "CALLAO - PROV. CONST.": "CALLAO",
}
REGION_MISSING = "NO DISPONIBLE"
REGION_CODES = {
    1: "AMAZONAS",
    2: "ANCASH",
    3: "APURIMAC",
    4: "AREQUIPA",
    5: "AYACUCHO",
    6: "CAJAMARCA",
    8: "CUSCO",
    9: "HUANCAVELICA",
    10: "HUANUCO",
    11: "ICA",
    12: "JUNIN",
    13: "LA LIBERTAD",
    14: "LAMBAYEQUE",
    15: "LIMA",
    16: "LORETO",
    17: "MADRE DE DIOS",
    18: "MOQUEGUA",
    19: "PASCO",
    20: "PIURA",
    21: "PUNO",
    22: "SAN MARTIN",
    23: "TACNA",
    24: "TUMBES",
    25: "UCAYALI",
}
CANONICAL_REGIONS = sorted({*REGION_CODES.values(), "CALLAO"})
ROLLUP_ROWS = ["TOTAL", "LIMA"]
CAPITAL_SEGMENT = ["LIMA", "LIMA METROPOLITANA", "PROVINCIA CONSTITUCIONAL DEL CALLAO", "CALLAO"]
MONTH_NAMES = {
    "ene": "Ene.",
    "feb": "Feb.",
    "mar": "Mar.",
    "abr": "Abr.",
    "may": "May.",
    "jun": "Jun.",
    "jul": "Jul.",
    "ago": "Ago.",
    "sep": "Sep.",
    "set": "Sep.",
    "oct": "Oct.",
    "nov": "Nov.",
    "dic": "Dic.",
}

# Upper-case Latin letters with a mark, and the bare letter each one decomposes to.
_MARKED = "ÁÀÂÄÃÅĀĂĄÉÈÊËĒĔĖĘĚÍÌÎÏĨĪĬĮİÓÒÔÖÕŌŎŐÚÙÛÜŨŪŬŮŰŲÑŃŅŇÇĆĈĊČÝŸŶŚŜŞŠŹŻŽĎĤĴĶĹĻĽŔŖŘŢŤŴ"
_BARE = "AAAAAAAAAEEEEEEEEEIIIIIIIIIOOOOOOOOUUUUUUUUUUNNNNCCCCCYYYSSSSZZZDHJKLLLRRRTTW"
assert len(_MARKED) == len(_BARE)


def strip_marks(text: Column) -> Column:
    """Upper case without accents: composed letters by table, loose marks removed."""
    loose = F.regexp_replace(F.upper(text), r"\p{Mn}+", "")
    return F.translate(loose, _MARKED, _BARE)


def clean_region(text: Column) -> Column:
    return strip_space(strip_marks(text))


def normalise_region(text: Column) -> Column:
    """Canonical region; null for a null or unavailable name, unknown names pass."""
    cleaned = clean_region(text)
    known = first_match(cleaned, REGION_VARIANTS)
    return F.when(cleaned != REGION_MISSING, F.coalesce(known, cleaned))


def region_from_code(code: Column) -> Column:
    return first_match(code.cast("int"), REGION_CODES)


def region_display(first: Column, second: Column) -> Column:
    """Name from the first filled cell; the constitutional province reads 'Callao'."""
    raw = strip_space(
        F.when(F.coalesce(strip_space(first.cast("string")), F.lit("")) != "", first).otherwise(
            second
        ).cast("string")
    )
    callao = F.lower(raw).contains("provincia constitucional del callao")
    return F.when(callao, F.lit("Callao")).otherwise(raw)


def month_label(text: Column) -> Column:
    """Three-letter month, with or without a dot, in any case; null when unknown."""
    bare = F.regexp_replace(F.lower(strip_space(text)), r"^(...)\.$", "$1")
    return first_match(bare, MONTH_NAMES)


def in_capital(region: Column) -> Column:
    """Capital segment, Callao included; a null region counts as outside."""
    return F.coalesce(strip_space(F.upper(region)).isin(CAPITAL_SEGMENT), F.lit(False))
