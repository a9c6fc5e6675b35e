"""Raw file schemas, neutral column names and versioned contracts."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Headers and types of the raw files, and the neutral name of each column.
REGISTRY_COLUMNS = [
    ("RUC", "bigint", "entity_id"),
    ("Estado", "string", "status"),
    ("Condicion", "string", "condition"),
    ("Tipo", "string", "entity_type"),
    ("Actividad_Economica_CIIU_revision3_Principal", "string", "activity_old"),
    ("Actividad_Economica_CIIU_revision3_Secundaria", "string", "activity_secondary"),
    ("Actividad_Economica_CIIU_revision4_Principal", "string", "activity"),
    ("NroTrab", "string", "workers_text"),
    ("TipoFacturacion", "string", "billing_mode"),
    ("TipoContabilidad", "string", "accounting_mode"),
    ("ComercioExterior", "string", "foreign_trade"),
    ("UBIGEO", "int", "place_code"),
    ("Departamento", "string", "region"),
    ("Provincia", "string", "province"),
    ("Distrito", "string", "district"),
    ("PERIODO_PUBLICACION", "int", "period"),
]
ORDER_COLUMNS = [
    ("entidad", "string", "buyer_name"),
    ("ruc_entidad", "bigint", "buyer_id"),
    ("departamento_entidad", "string", "region"),
    ("tipoorden", "string", "order_type"),
    ("nro_de_orden", "bigint", "order_seq"),
    ("orden", "string", "order_no"),
    ("descripcion_orden", "string", "description"),
    ("objetocontractual", "string", "object"),
    ("estadocontratacion", "string", "order_status"),
    ("tipodecontratacion", "string", "contract_type"),
    ("monto_total_orden_original", "double", "amount"),
    ("moneda", "string", "currency"),
    ("ruc_contratista", "string", "contractor_id"),
    ("nombre_razon_contratista", "string", "contractor_name"),
    ("fecha_registro", "date", "entry_date"),
    ("fecha_de_emision", "date", "issue_date"),
    ("fecha_compromiso_presupuestal", "date", "commitment_date"),
    ("fecha_de_notificacion", "date", "notice_date"),
]
REGISTRY_CRITICAL = ["entity_id", "status", "condition", "region", "place_code"]
ORDER_CRITICAL = ["order_no", "buyer_id", "region", "amount", "issue_date"]
ORDER_DATES = ["entry_date", "issue_date", "commitment_date", "notice_date"]
PARTITION_COLUMNS = ("anio", "mes")
PARTITION_NAMES = {"anio": "year", "mes": "month"}
SURVEY_COLUMNS = {"CCDD": "code", "OCUP300": "employed", "Informal_P": "informal", "FAC300_ANUAL": "weight"}
AFFILIATION_COLUMNS = {"RUC": "entity_id", "tipo_SEE": "voucher_type", "fecha_inicio": "start_date"}
REVENUE_COLUMNS = {
    "Departamento": "region",
    "Periodo": "period",
    "Anio": "year",
    "Mes": "month",
    "Monto_Recaudado": "amount",
}
REGISTER_HEADERS = {
    "fecha de emisión": "issue_date",
    "quedó firme": "firm_date",
    "fecha de publicación": "publication_date",
    "documento de identidad del representante": "representative",
}


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def _struct(columns, required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], name not in required) for name, kind, _ in columns])


REGISTRY_SCHEMA = _struct(REGISTRY_COLUMNS, required=("RUC",))
ORDERS_SCHEMA = _struct(ORDER_COLUMNS)

RUN_RECORD_DDL = """
    run_id string, fecha string, git_commit string, dataset_version string, variant string,
    model_name string, usa_pesos boolean, hiperparametros_ganadores map<string,string>,
    grilla_probada map<string,string>, n_train bigint, n_test bigint,
    n_positivos_train bigint, n_positivos_test bigint, ruta_modelo string, ruta_predicciones string,
    semilla bigint, n_features_transformadas bigint, segundos_entrenamiento double,
    metricas_cv struct<cv_pr_auc_mean: double, cv_pr_auc_std: double, cv_pr_auc_folds: array<double>,
    train_pr_auc: double, cv_recall_1pct_mean: double, cv_recall_1pct_std: double>"""

# name -> (version, raw schema). A schema change needs a new version.
CONTRACTS: dict[str, tuple[str, T.StructType]] = {
    "registry": ("1.0.0", REGISTRY_SCHEMA),
    "orders": ("1.0.0", ORDERS_SCHEMA),
}


class ContractError(ValueError):
    """The schema read does not fulfil the dataset's contract."""


def contract_json(name: str) -> dict:
    version, schema = CONTRACTS[name]
    fields = [
        {"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schema
    ]
    return {"name": name, "version": version, "fields": fields}


def export_contracts(folder: Path) -> list[Path]:
    """Write one ``<name>.v<major>.json`` per contract."""
    folder.mkdir(parents=True, exist_ok=True)
    written = []
    for name, (version, _) in CONTRACTS.items():
        target = folder / f"{name}.v{version.split('.')[0]}.json"
        target.write_text(json.dumps(contract_json(name), indent=2) + "\n", encoding="utf-8")
        written.append(target)
    return written


def check_contract(found: T.StructType, name: str, allowed: tuple[str, ...] = PARTITION_COLUMNS) -> None:
    """Raise when columns are missing, unexpected or of another type; nullability is ignored."""
    version, wanted = CONTRACTS[name]
    want = {f.name: f.dataType.simpleString() for f in wanted}
    have = {f.name: f.dataType.simpleString() for f in found}
    problems = [f"missing column {c}" for c in sorted(want.keys() - have.keys())]
    problems += [f"unexpected column {c}" for c in sorted(have.keys() - want.keys() - set(allowed))]
    problems += [
        f"column {c} is {have[c]}, expected {want[c]}"
        for c in sorted(want.keys() & have.keys())
        if want[c] != have[c]
    ]
    if problems:
        raise ContractError(f"{name} breaks contract v{version}: " + "; ".join(problems))


def neutral_names(df: DataFrame, columns) -> DataFrame:
    """Rename raw headers (and the partition columns) to the names used by the operators."""
    names = {raw: neutral for raw, _, neutral in columns} | PARTITION_NAMES
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})
