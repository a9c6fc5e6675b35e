"""The same questions in plain SQL, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from lakerisk.operators import preparation
from lakerisk.plans import lake_queries
from lakerisk.plans.bindings import binding_sql

MONTH, ORDER_CUTOFF, AFFILIATION_CUTOFF, LABEL_CUTOFF = "200106", "2001-06-30", "2001-03-20", "2000-12-31"
CUTOFFS = [("200103", "2001-03-31"), ("200106", "2001-06-30")]
# Every column of a labelled row that is no key, split or label.
FEATURES = (
    "region ref_month main_activity activity status condition entity_type workers workers_known no_workers n_activities billing_mode "
    "accounting_mode id_prefix id_sequence months_seen billing_changed status_changed new_in_period months_gap total_amount n_orders max_amount "
    "n_buyers annulled_share median_amount top_buyer_share total_contracted contract_count contract_age_days has_contracts amount_per_worker "
    "aff_age_days aff_n_types aff_invoice_portal aff_receipt_portal aff_own_system aff_fees_only affiliated regional_informal_pct"
).split()
NULL_COLUMNS = ["id", "entity_id", "label", "split", "fold", "issue_date", "firm_date", "representative", *FEATURES]
REVENUE_MONTHS = ["Ene.", "Feb.", "Mar.", "Abr.", "May.", "Jun.", "Jul.", "Ago.", "Sep.", "Oct.", "Nov.", "Dic."]
MODELS = ["LR", "DT", "RF", "GBT", "HGB"]
ELIGIBLE = (
    "'EMPRESA INDIVIDUAL DE RESPONSABILIDAD LIMITADA', 'PERSONA NATURAL CON NEGOCIO', 'SOCIEDAD ANONIMA CERRADA', "
    "'SOCIEDAD COMERCIAL DE RESPONSABILIDAD LIMITADA', 'CONTRATOS COLABORACION EMPRESARIAL', "
    "'SOCIEDAD POR ACCIONES CERRADA SIMPLIFICADA', 'SOCIEDAD IRREGULAR', 'SOCIEDAD ANONIMA'"
)
_DEPARTMENTS = [
    "AMAZONAS", "ANCASH", "APURIMAC", "AREQUIPA", "AYACUCHO", "CAJAMARCA", None, "CUSCO", "HUANCAVELICA", "HUANUCO",
    "ICA", "JUNIN", "LA LIBERTAD", "LAMBAYEQUE", "LIMA", "LORETO", "MADRE DE DIOS", "MOQUEGUA", "PASCO", "PIURA",
    "PUNO", "SAN MARTIN", "TACNA", "TUMBES", "UCAYALI",
]


def _from(**names: str) -> str:
    """WITH clause naming the bindings used."""
    return "WITH " + ", ".join(f"{alias} AS ({binding_sql(name)})" for alias, name in names.items())


def _norm(x: str) -> str:
    clean = f"strip_accents(upper(trim({x})))"
    return (
        f"CASE {clean} WHEN 'NO DISPONIBLE' THEN NULL WHEN 'LIMA METROPOLITANA' THEN 'LIMA' WHEN 'LIMA PROVINCIAS' THEN 'LIMA' "
        f"WHEN 'PROVINCIA DE LIMA' THEN 'LIMA' WHEN 'PROV. CONST. DEL CALLAO' THEN 'CALLAO' "
        f"WHEN 'PROVINCIA CONSTITUCIONAL DEL CALLAO' THEN 'CALLAO' WHEN 'CALLAO - PROV. CONST.' THEN 'CALLAO' ELSE {clean} END"
    )


def _by_code(code: str) -> str:
    cases = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(_DEPARTMENTS) if n)
    return f"CASE {code} {cases} END"


def _valid(x: str) -> str:
    return f"coalesce(regexp_full_match(trim(CAST({x} AS STRING)), '[0-9]{{11}}'), FALSE)"


def _profile(cutoff: str) -> str:
    return f"""(WITH f AS (
        SELECT TRY_CAST(contractor_id AS BIGINT) AS entity_id,
          coalesce(CAST(buyer_id AS STRING), buyer_name, 'ENTIDAD_DESCONOCIDA') AS buyer,
          CASE WHEN lower(coalesce(order_status, '')) <> 'anulada' AND lower(coalesce(currency, 'nuevos soles')) = 'nuevos soles'
            THEN CAST(coalesce(amount, 0) AS DECIMAL(18,2)) END AS amt,
          CASE WHEN lower(coalesce(order_status, '')) = 'anulada' THEN 1 ELSE 0 END AS ann, issue_date
        FROM ({binding_sql('feed')}) WHERE issue_date <= DATE '{cutoff}'),
      g AS (SELECT * FROM f WHERE entity_id IS NOT NULL),
      b AS (SELECT entity_id, max(s) AS top FROM (SELECT entity_id, buyer, sum(amt) AS s FROM g GROUP BY 1, 2) GROUP BY 1),
      a AS (SELECT entity_id, CAST(coalesce(sum(amt), 0) AS DOUBLE) AS total_amount, count(*) AS n_orders,
          CAST(max(amt) AS DOUBLE) AS max_amount, count(DISTINCT buyer) AS n_buyers,
          CAST(sum(ann) AS DOUBLE) / count(*) AS annulled_share, min(issue_date) AS first_order_date,
          CAST(quantile_disc(amt, 0.5) AS DOUBLE) AS median_amount
        FROM g GROUP BY 1)
      SELECT a.*, CASE WHEN total_amount <= 0 THEN 0 ELSE CAST(top AS DOUBLE) / total_amount END AS top_buyer_share,
        total_amount AS total_contracted, n_orders AS contract_count
      FROM a JOIN b USING (entity_id))"""


def _history(month: str) -> str:
    return f"""(WITH s AS (SELECT entity_id, year * 12 + month AS mi, trim(status) AS st, trim(billing_mode) AS bm
        FROM ({binding_sql('snapshots')}) WHERE year * 100 + month <= {month})
      SELECT entity_id, count(DISTINCT mi) AS months_seen,
        CASE WHEN count(DISTINCT bm) > 1 THEN 1 ELSE 0 END AS billing_changed,
        CASE WHEN count(DISTINCT st) > 1 THEN 1 ELSE 0 END AS status_changed,
        CASE WHEN min(mi) > (SELECT min(mi) FROM s) THEN 1 ELSE 0 END AS new_in_period,
        CAST(max(mi) - min(mi) + 1 - count(DISTINCT mi) AS BIGINT) AS months_gap
      FROM s GROUP BY 1)"""


def _affiliated(cutoff: str) -> str:
    has = lambda t: f"CASE WHEN contains(voucher_type, '{t}') THEN 1 ELSE 0 END"
    return f"""(SELECT entity_id, CAST(date_diff('day', min(start_date), DATE '{cutoff}') AS INTEGER) AS aff_age_days,
        count(DISTINCT voucher_type) AS aff_n_types, max({has('factura portal')}) AS aff_invoice_portal,
        max({has('boleta portal')}) AS aff_receipt_portal, max({has('sistemas del contribuyente')}) AS aff_own_system,
        min({has('honorarios')}) AS aff_fees_only, 1 AS affiliated
      FROM ({binding_sql('affiliations')}) WHERE start_date <= DATE '{cutoff}' GROUP BY 1)"""


def _registry(month: str) -> str:
    return f"""(SELECT entity_id, activity AS main_activity, activity, status, condition,
        coalesce(trim(entity_type), 'DESCONOCIDO') AS entity_type, coalesce({_norm('region')}, 'DESCONOCIDO') AS region,
        TRY_CAST(workers_text AS DOUBLE) AS workers,
        CASE WHEN TRY_CAST(workers_text AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END AS workers_known,
        CASE WHEN TRY_CAST(workers_text AS DOUBLE) <= 0 THEN 1 ELSE 0 END AS no_workers,
        CASE WHEN trim(activity_secondary) <> '' THEN 2 ELSE 1 END AS n_activities,
        trim(billing_mode) AS billing_mode, trim(accounting_mode) AS accounting_mode,
        CAST(entity_id // 1000000000 AS STRING) AS id_prefix, (entity_id // 10) % 100000000 AS id_sequence,
        '{month}' AS ref_month
      FROM ({binding_sql('registry')}) WHERE year * 100 + month = {month})"""


def _informality() -> str:
    return f"""(SELECT {_by_code('code')} AS region,
        sum(CASE WHEN informal = 1 THEN weight ELSE 0 END) / sum(weight) * 100 AS informal_pct
      FROM ({binding_sql('survey')}) WHERE employed = 1 GROUP BY 1)"""


def _summary() -> str:
    return f"""(WITH snap AS (SELECT entity_id, status, {_norm('region')} AS region FROM ({binding_sql('registry')})
          WHERE year = 2001 AND month = 6),
        a AS (SELECT region, count(*) AS active_entities FROM snap WHERE upper(trim(status)) = 'ACTIVO' GROUP BY 1),
        i AS {_informality()},
        r AS (SELECT {_norm('region')} AS region, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue
          FROM ({binding_sql('revenue')}) WHERE upper(trim(region)) NOT IN ('TOTAL', 'LIMA') AND year = 2001 GROUP BY 1),
        e AS (SELECT region, count(*) AS excluded_entities FROM ({binding_sql('exclusions')})
          JOIN (SELECT DISTINCT entity_id, region FROM snap) USING (entity_id) GROUP BY 1)
      SELECT region, coalesce(active_entities, 0) AS active_entities, informal_pct, coalesce(revenue, 0) AS revenue,
        coalesce(excluded_entities, 0) AS excluded_entities
      FROM a FULL JOIN i USING (region) FULL JOIN r USING (region) FULL JOIN e USING (region))"""


def _features(month: str, cutoff: str) -> str:
    zero = lambda c: f"coalesce(af.{c}, 0) AS {c}"
    return f"""SELECT g.*, h.* EXCLUDE (entity_id), coalesce(c.total_amount, 0) AS total_amount,
        coalesce(c.n_orders, 0) AS n_orders, c.max_amount, coalesce(c.n_buyers, 0) AS n_buyers, c.median_amount,
        c.top_buyer_share, coalesce(c.annulled_share, 0) AS annulled_share, coalesce(c.total_amount, 0) AS total_contracted,
        coalesce(c.n_orders, 0) AS contract_count, x.entity_id IS NOT NULL AS excluded,
        CASE WHEN date_diff('day', first_order_date, last_day(strptime('{month}01', '%Y%m%d')::DATE)) >= 0 THEN
          CAST(date_diff('day', first_order_date, last_day(strptime('{month}01', '%Y%m%d')::DATE)) AS INTEGER) END AS contract_age_days,
        CASE WHEN c.n_orders > 0 THEN 1 ELSE 0 END AS has_contracts,
        CASE WHEN workers > 0 THEN coalesce(c.total_amount, 0) / workers END AS amount_per_worker,
        af.aff_age_days, {', '.join(zero(c) for c in ('aff_n_types', 'aff_invoice_portal', 'aff_receipt_portal', 'aff_own_system', 'aff_fees_only', 'affiliated'))},
        i.informal_pct AS regional_informal_pct
      FROM {_registry(month)} g LEFT JOIN {_history(month)} h USING (entity_id)
      LEFT JOIN {_profile(cutoff)} c USING (entity_id)
      LEFT JOIN (SELECT DISTINCT entity_id FROM ({binding_sql('exclusions')})) x USING (entity_id)
      LEFT JOIN {_affiliated(cutoff)} af USING (entity_id)
      LEFT JOIN {_summary()} i ON i.region = g.region"""


def _labelled() -> str:
    """CTE chain up to the labelled, windowed rows of the curated table."""
    return f"""WITH reg AS ({binding_sql('register')}), fe AS ({_features(MONTH, ORDER_CUTOFF)}),
      l0 AS (SELECT fe.*, lpad(CAST(entity_id AS STRING), 11, '0') AS id, r.issue_date, r.firm_date, r.representative,
          CASE WHEN r.entity_id IS NOT NULL THEN 1 ELSE 0 END AS label
        FROM fe LEFT JOIN reg r USING (entity_id)
        WHERE entity_id NOT IN (SELECT entity_id FROM ({binding_sql('exclusions')}))),
      lab AS (SELECT *, CASE WHEN label = 1 THEN coalesce(representative, id) ELSE id END AS grp FROM l0
        WHERE issue_date IS NULL OR (issue_date > DATE '{LABEL_CUTOFF}' AND issue_date <=
          (SELECT last_day((max(publication_date) - INTERVAL 1 MONTH)::DATE) FROM reg)))"""


def _curated() -> str:
    """CTE chain up to `cur`: split and folds."""
    return f"""{_labelled()},
      s1 AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY firm_date DESC NULLS LAST,
          md5(id || '_salt_42_split'), id) <= count(*) OVER (PARTITION BY label) * 0.3::DOUBLE AS hit FROM lab),
      s2 AS (SELECT *, CASE WHEN max(hit::INT) OVER (PARTITION BY label, grp) = 1 THEN 'test' ELSE 'train' END AS split FROM s1),
      f0 AS (SELECT *, min(issue_date) OVER (PARTITION BY label, grp) AS since FROM s2 WHERE split = 'train'),
      f1 AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY CASE WHEN label = 1 THEN since END NULLS LAST,
          CASE WHEN label = 1 THEN grp END NULLS LAST, md5(id || '_salt_43_fold'), id) AS rn,
          count(*) OVER (PARTITION BY label) AS n FROM f0),
      f2 AS (SELECT *, CASE WHEN label = 1 THEN CAST(floor((rn - 1) * 5 / n) AS INTEGER) ELSE CAST((rn - 1) % 5 AS INTEGER) END AS f FROM f1),
      cur AS (SELECT * EXCLUDE (hit, since, rn, n, f), min(f) OVER (PARTITION BY label, grp) AS fold FROM f2
        UNION ALL BY NAME SELECT * EXCLUDE (hit), -1 AS fold FROM s2 WHERE split = 'test')"""


def _encoding(name: str, key: str, m: float = 100, weight: str = "1", digits: str = "") -> str:
    """CTEs k_<name>: encoding per id from `cur`."""
    return f"""t_{name} AS (SELECT sum({weight} * label)::DOUBLE / sum({weight}) AS prev FROM cur WHERE split = 'train'),
      a_{name} AS (SELECT {key} AS k, fold AS kf, sum({weight})::DOUBLE AS n, sum({weight} * label)::DOUBLE AS p FROM cur
        WHERE split = 'train' GROUP BY 1, 2),
      w_{name} AS (SELECT k, sum(n) AS n, sum(p) AS p FROM a_{name} GROUP BY 1),
      k_{name} AS (SELECT id, (coalesce(w.p, 0) - coalesce(a.p, 0) + {m}::DOUBLE * prev) / (coalesce(w.n, 0) - coalesce(a.n, 0) + {m}::DOUBLE) AS {name}
        FROM cur CROSS JOIN t_{name} LEFT JOIN w_{name} w ON w.k = {key} LEFT JOIN a_{name} a ON a.k = {key} AND a.kf = cur.fold)"""


_TE = ", ".join(
    [
        _encoding("te_activity", "activity"),
        _encoding("te_activity_region", "activity || '|' || region"),
        _encoding("te_cohort", "substr(id, 1, 2) || '|' || CAST(id_sequence // 100000 AS STRING)"),
    ]
)
_LADDER = """st AS (SELECT run_id, split, score, count(*) AS n, sum(label) AS p FROM p GROUP BY 1, 2, 3),
  la AS (SELECT *, sum(n) OVER w AS nu, sum(p) OVER w AS pu, sum(n) OVER (PARTITION BY run_id, split) AS na,
    sum(p) OVER (PARTITION BY run_id, split) AS pa FROM st
    WINDOW w AS (PARTITION BY run_id, split ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
_RANKED = """rk AS (SELECT *, row_number() OVER (PARTITION BY run_id, split ORDER BY score DESC, id) AS r,
    count(*) OVER (PARTITION BY run_id, split) AS m, sum(label) OVER (PARTITION BY run_id, split) AS pos,
    sum(label) OVER (PARTITION BY run_id, split ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS hits FROM p)"""
_LATEST = """ru AS (SELECT *, nullif(regexp_extract(run_id, '^risk-run-([^-]+)-', 1), '') AS experiment FROM runs0),
  runs1 AS (SELECT run_id, model_name, variant, dataset_version, experiment, CASE WHEN row_number() OVER (
    PARTITION BY coalesce(experiment, run_id), dataset_version ORDER BY run_date DESC, run_id DESC) = 1 THEN 1 ELSE 0 END AS is_latest FROM ru)"""
_AP = "coalesce(sum(p::DOUBLE / nullif(pa, 0) * pu / nu), 0)"
_ROC = "sum((n - p) * (pu - p + p / 2.0::DOUBLE) / nullif(pa * (na - pa), 0)::DOUBLE)"


def _at_k(keys: str, source: str, ks=(100, 500), label_digits: int = 9) -> str:
    """SELECT of the metrics at K from ranked rows (r, m, pos, label, score)."""
    cuts = {str(k): f"CASE WHEN m >= {k} THEN {k} END" for k in ks} | {
        "0_1pct": "greatest(1, CAST(ceil(0.001::DOUBLE * m) AS BIGINT))",
        "1pct": "greatest(1, CAST(ceil(0.01::DOUBLE * m) AS BIGINT))",
        "5pct": "greatest(1, CAST(ceil(0.05::DOUBLE * m) AS BIGINT))",
    }
    cols = []
    for c, k in cuts.items():
        tp = f"count(CASE WHEN r <= {k} AND label = 1 THEN 1 END)"
        kk = f"any_value({k})"
        cols += [
            f"{tp}::DOUBLE / {kk} AS precision_{c}",
            f"CASE WHEN {kk} IS NOT NULL THEN coalesce({tp}::DOUBLE / nullif(any_value(pos), 0), 0) END AS recall_{c}",
            f"CASE WHEN {kk} IS NOT NULL THEN coalesce(({tp}::DOUBLE / {kk}) / (nullif(any_value(pos), 0)::DOUBLE / any_value(m)), 1) END AS lift_{c}",
        ]
        if c.endswith("pct"):
            cols += [
                f"{tp} AS tp_{c}", f"CAST({kk} - {tp} AS BIGINT) AS fp_{c}", f"CAST(any_value(pos) - {tp} AS BIGINT) AS fn_{c}",
                f"CAST(any_value(m) - {kk} - any_value(pos) + {tp} AS BIGINT) AS tn_{c}",
            ]
    return f"SELECT {keys}, " + ", ".join(cols) + f" FROM {source} GROUP BY {keys}"


def _metrics() -> str:
    """CTE chain with `met`: the ranking metrics per run and split."""
    return f"""{_from(p='preds')}, {_LADDER}, {_RANKED}, atk AS ({_at_k('run_id, split', 'rk')}),
      ar AS (SELECT run_id, split, CAST(max(na) AS BIGINT) AS n, CAST(max(pa) AS BIGINT) AS n_positives,
        max(pa)::DOUBLE / max(na) AS prevalence, round({_AP}, 9) AS pr_auc, round({_ROC}, 9) AS roc_auc FROM la GROUP BY 1, 2),
      br AS (SELECT run_id, split, round(avg((score - label) * (score - label)), 9) AS brier FROM p GROUP BY 1, 2),
      met AS (SELECT * FROM ar JOIN br USING (run_id, split) JOIN atk USING (run_id, split))"""


def _segments() -> str:
    """CTE chain with `seg`: metrics per run, split and segment."""
    return f"""{_from(p0='preds')},
      z AS (SELECT *, CASE WHEN coalesce(upper(trim(region)) IN ('LIMA', 'LIMA METROPOLITANA', 'PROVINCIA CONSTITUCIONAL DEL CALLAO', 'CALLAO'), FALSE)
        THEN 'LIMA' ELSE 'RESTO' END AS area FROM p0),
      p AS (SELECT *, area AS segment FROM z
        UNION ALL SELECT *, upper(trim(region)) FROM z WHERE upper(trim(region)) NOT IN ('LIMA', 'RESTO')
        UNION ALL SELECT *, CASE WHEN coalesce(has_contracts, 0) = 1 THEN 'CONTRATISTAS' ELSE 'NO_CONTRATISTAS' END FROM z),
      st AS (SELECT run_id, split, segment, score, count(*) AS n, sum(label) AS p FROM p GROUP BY ALL),
      la AS (SELECT *, sum(n) OVER w AS nu, sum(p) OVER w AS pu, sum(p) OVER (PARTITION BY run_id, split, segment) AS pa FROM st
        WINDOW w AS (PARTITION BY run_id, split, segment ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
      ap AS (SELECT run_id, split, segment, CAST(sum(n) AS BIGINT) AS n, CAST(max(pa) AS BIGINT) AS n_positives, {_AP} AS ap FROM la GROUP BY 1, 2, 3),
      rk AS (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY run_id, split, segment) AS m,
        sum(label) OVER (PARTITION BY run_id, split, segment) AS pos FROM p
        WINDOW w AS (PARTITION BY run_id, split, segment ORDER BY score DESC, id)),
      atk AS ({_at_k('run_id, split, segment', 'rk', ks=())}),
      seg AS (SELECT run_id, split, segment, n, n_positives,
        CASE WHEN n_positives > 0 THEN n_positives::DOUBLE / n END AS prevalence,
        CASE WHEN n_positives > 0 THEN round(ap, 9) END AS pr_auc,
        CASE WHEN n_positives > 0 THEN recall_5pct END AS recall_5pct,
        CASE WHEN n_positives > 0 AND segment LIKE '%CONTRATISTAS' THEN recall_1pct END AS recall_1pct,
        CASE WHEN n_positives > 0 AND segment LIKE '%CONTRATISTAS' THEN lift_1pct END AS lift_1pct,
        CASE WHEN n_positives > 0 AND segment LIKE '%CONTRATISTAS' THEN n_positives < 30 END AS few_positives
        FROM ap JOIN atk USING (run_id, split, segment))"""


def _preparation() -> str:
    """Medians, caps, imputed and pooled rows of every model column over the feature table."""
    capped = lambda c: f"least({c}, CASE WHEN (SELECT cap_{c} FROM q) > 0 THEN (SELECT cap_{c} FROM q) ELSE 'infinity'::DOUBLE END)"
    shaped = lambda c: f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest(0, {capped(c)})) END" if c in preparation.LOGGED else f"{c}::DOUBLE"
    caps = ", ".join(f"quantile_cont({c}::DOUBLE, {preparation.TOP_QUANTILE}) AS cap_{c}" for c in preparation.LOGGED)
    numbers = [
        f"""SELECT '{c}' AS "column", round(m, 6) AS median, {f'(SELECT CASE WHEN cap_{c} > 0 THEN round(cap_{c}, 6) END FROM q)' if c in preparation.LOGGED else 'NULL::DOUBLE'} AS cap,
        count(*) - count(x) AS changed, round(avg(coalesce(x, m)), 6) AS mean, round(min(coalesce(x, m)), 6) AS least, round(max(coalesce(x, m)), 6) AS greatest, NULL::BIGINT AS kept
        FROM (SELECT *, median(x) OVER () AS m FROM (SELECT {shaped(c)} AS x FROM fe)) GROUP BY m HAVING count(x) > 0"""
        for c in preparation.NUMERIC
    ]
    names = []
    for c in preparation.CATEGORICAL + preparation.LEAKY_CATEGORICAL:
        most = preparation.CATEGORY_LIMITS.get(c, preparation.DEFAULT_CATEGORY_LIMIT)
        stays = f"(d <= {most} OR place < {most})"
        names.append(
            f"""SELECT '{c}', NULL, NULL, CAST(coalesce(sum(n) FILTER (WHERE NOT {stays}), 0) AS BIGINT), NULL, NULL, NULL, count(*) FILTER (WHERE {stays})
            FROM (SELECT *, row_number() OVER (ORDER BY n DESC, v) AS place, count(*) OVER () AS d FROM (
              SELECT coalesce(CAST({c} AS STRING), 'DESCONOCIDO') AS v, count(*) AS n, count({c}) AS f FROM fe GROUP BY 1)) HAVING sum(f) > 0"""
        )
    return f"WITH fe AS MATERIALIZED ({_features(MONTH, ORDER_CUTOFF)}), q AS MATERIALIZED (SELECT {caps} FROM fe) " + " UNION ALL ".join(numbers + names)


def _feed_input() -> str:
    """CTEs: bronze feed, input after keep-latest on a full order, and the row verdicts."""
    return f"""{_from(feed='feed')},
      latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY year DESC, month DESC, issue_date DESC,
        part_key, line_no, buyer_id NULLS LAST, amount NULLS LAST, currency NULLS LAST, order_status NULLS LAST) AS rn
        FROM feed WHERE order_no IS NOT NULL) WHERE rn = 1
        UNION ALL SELECT * FROM feed WHERE order_no IS NULL),
      judged AS (SELECT *, {_valid('buyer_id')} AS b_ok, contractor_id IS NULL OR {_valid('contractor_id')} AS c_ok FROM latest),
      verdict AS (SELECT *, b_ok AND c_ok AND coalesce(amount >= 0, FALSE) AS ok, concat_ws(';',
        CASE WHEN NOT b_ok THEN 'ruc_entidad_invalido' END, CASE WHEN NOT c_ok THEN 'ruc_contratista_invalido' END,
        CASE WHEN amount IS NULL THEN 'monto_nulo' END, CASE WHEN amount < 0 THEN 'monto_negativo' END) AS reject_reason FROM judged)"""


_BALANCE = "count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives, round(1e2 * sum(label) / count(*), 4) AS prevalence_pct"


def oracle_sql() -> dict[str, str]:
    p = _from(p="preds")
    runs = f"{_from(p='preds', runs0='runs')}, {_LATEST}"
    reg_features = f"SELECT * FROM ({_features(MONTH, ORDER_CUTOFF)})"
    return {
        "contract_profile": f"SELECT * FROM {_profile('2001-03-31')}",
        "buyer_concentration": f"SELECT entity_id, top_buyer_share FROM {_profile('2001-03-31')}",
        "registry_history": f"SELECT * FROM {_history(MONTH)}",
        "affiliation_features": f"SELECT * FROM {_affiliated(AFFILIATION_CUTOFF)}",
        "registry_features": f"SELECT * FROM {_registry(MONTH)}",
        "feature_table": reg_features,
        "feature_table_multi_cutoff": " UNION ALL ".join(f"({_features(m, c)})" for m, c in CUTOFFS),
        "eligible_population": f"SELECT entity_id, entity_type, status, affiliated FROM ({_features(MONTH, ORDER_CUTOFF)}) "
        f"WHERE entity_type IN ({ELIGIBLE}) AND status = 'ACTIVO' AND affiliated = 1",
        "weighted_rate": f"SELECT * FROM {_informality()}",
        "active_by_region": f"SELECT region, count(*) AS active_entities FROM (SELECT {_norm('region')} AS region, status FROM "
        f"({binding_sql('registry')}) WHERE year = 2001 AND month = 6) WHERE upper(trim(status)) = 'ACTIVO' GROUP BY 1",
        "revenue_by_region": f"SELECT {_norm('region')} AS region, year, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue "
        f"FROM ({binding_sql('revenue')}) WHERE upper(trim(region)) NOT IN ('TOTAL', 'LIMA') GROUP BY 1, 2",
        "exclusions_by_region": f"SELECT region, count(*) AS excluded_entities FROM ({binding_sql('exclusions')}) JOIN (SELECT DISTINCT entity_id, "
        f"{_norm('region')} AS region FROM ({binding_sql('registry')}) WHERE year = 2001 AND month = 6) USING (entity_id) GROUP BY 1",
        "regional_summary": f"SELECT * FROM {_summary()}",
        "latest_snapshot": f"SELECT 2001 AS year, 6 AS month, count(*) AS rows FROM ({binding_sql('registry')}) "
        f"WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM ({binding_sql('registry')}))",
        # ingest and clean
        "ingest_split": """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
            CASE WHEN o_orderkey % 50 = 0 THEN 'schema' WHEN year(o_orderdate) NOT BETWEEN 1996 AND 2000 THEN 'year' ELSE 'clean' END AS side FROM orders""",
        "date_range_quarantine": f"SELECT year(issue_date) NOT BETWEEN 1996 AND 2000 AS rejected, count(*) AS rows FROM ({binding_sql('feed')}) GROUP BY 1",
        "id_validity": f"""SELECT {_valid('buyer_id')} AS buyer_ok, {_valid('contractor_id')} AS contractor_ok, count(*) AS rows
            FROM ({binding_sql('feed')}) GROUP BY 1, 2""",
        "registry_quarantine": f"""SELECT entity_id, {_norm('region')} AS region, ref_month FROM (SELECT *, CAST(year * 100 + month AS STRING) AS ref_month
            FROM ({binding_sql('registry')}) WHERE {_valid('entity_id')})""",
        "keep_latest": f"{_feed_input()} SELECT * FROM latest",
        "orders_quarantine": f"{_feed_input()} SELECT ok, reject_reason, count(*) AS rows, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM verdict GROUP BY 1, 2",
        "quality_report": f"""{_feed_input()}, c AS (SELECT year, month, count(*) AS n_bronze, 0 AS n_input, 0 AS n_rejected, 0 AS n_silver FROM feed GROUP BY 1, 2
            UNION ALL SELECT year, month, 0, count(*), count(*) - count(*) FILTER (WHERE ok), count(*) FILTER (WHERE ok) FROM verdict GROUP BY 1, 2),
            s AS (SELECT year, month, CAST(sum(n_bronze) AS BIGINT) AS n_bronze, CAST(0 AS BIGINT) AS n_bronze_rejected, CAST(sum(n_input) AS BIGINT) AS n_input,
              CAST(sum(n_rejected) AS BIGINT) AS n_rejected, CAST(sum(n_silver) AS BIGINT) AS n_silver FROM c GROUP BY 1, 2)
            SELECT 'orders' AS source, *, 0::DOUBLE AS bronze_reject_rate, CASE WHEN n_input > 0 THEN n_rejected::DOUBLE / n_input ELSE 0 END AS reject_rate FROM s""",
        "layer_losses": f"""{_feed_input()}, n AS (SELECT count(*) FILTER (WHERE year(issue_date) BETWEEN 1996 AND 2000) AS b, count(*) FILTER (WHERE year(issue_date) NOT BETWEEN 1996 AND 2000) AS q FROM feed)
            SELECT b + q AS n_raw, q AS n_bronze_rejected, q::DOUBLE / (b + q) * 100 AS bronze_rejected_pct,
              b - (SELECT count(*) FROM feed WHERE year(issue_date) BETWEEN 1996 AND 2000 AND {_valid('buyer_id')} AND (contractor_id IS NULL OR {_valid('contractor_id')}) AND amount >= 0) AS n_lost_to_silver,
              (SELECT count(*) FROM feed WHERE year(issue_date) BETWEEN 1996 AND 2000 AND {_valid('buyer_id')} AND (contractor_id IS NULL OR {_valid('contractor_id')}) AND amount >= 0) AS n_silver FROM n""",
        "completeness": f"""SELECT round(1e2 * count(order_no) / count(*), 2) AS filled_pct_order_no, round(1e2 * count(buyer_id) / count(*), 2) AS filled_pct_buyer_id,
            round(1e2 * count(region) / count(*), 2) AS filled_pct_region, round(1e2 * count(amount) / count(*), 2) AS filled_pct_amount,
            round(1e2 * count(issue_date) / count(*), 2) AS filled_pct_issue_date FROM (SELECT *, CASE WHEN part_key % 3 > 0 THEN 'LIMA' END AS region FROM ({binding_sql('feed')}))""",
        "id_column_guard": f"SELECT CAST(contractor_id AS BIGINT) AS entity_id, count(*) AS rows FROM ({binding_sql('feed')}) WHERE {_valid('contractor_id')} GROUP BY 1",
        # small sources and scalar functions
        "normalise_region": f"SELECT entity_id, {_norm('region')} AS region, upper(strip_accents(trim(region))) AS cleaned FROM ({binding_sql('registry')}) WHERE TRUE",
        "code_map": f"SELECT s_suppkey, {_by_code('s_nationkey + 1')} AS region FROM supplier",
        "serial_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS from_serial, CAST(o_orderdate AS DATE) AS from_text FROM orders""",
        "revenue_unpivot": f"""WITH s AS (SELECT CASE WHEN n_nationkey = 6 THEN 'Callao' ELSE n_name END AS region, year(o_orderdate) AS y, month(o_orderdate) AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS cents
              FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
            span AS (SELECT min(y) AS first, max(y) AS last FROM s), places AS (SELECT DISTINCT region FROM s),
            months AS (SELECT unnest(range(1, 13)) AS m, unnest({REVENUE_MONTHS}) AS month), g AS (SELECT region, y, m, sum(cents) AS cents FROM s GROUP BY ALL),
            grid AS (SELECT * FROM places, months, (SELECT unnest(range(first, last + 1)) AS y FROM span))
            SELECT region, y || '_' || month AS period, CAST(y AS BIGINT) AS year, month, CAST(CAST(cents AS STRING) AS DOUBLE) AS amount FROM grid LEFT JOIN g USING (region, y, m)
            UNION ALL SELECT region, (last + 1) || '_Dic.', CAST(last + 1 AS BIGINT), 'Dic.', NULL FROM places, span""",
        "oldest_resolution": """SELECT 10000000000 * (1 + o_custkey % 2) + o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS issue_date, o_orderkey AS source_row
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
        "clean_affiliations": f"SELECT DISTINCT entity_id, voucher_type, start_date FROM ({binding_sql('affiliations')})",
        "clean_survey": f"SELECT CAST(code AS BIGINT) AS code, employed, informal, sum(weight) AS weight, count(*) AS rows FROM ({binding_sql('survey')}) WHERE code IS NOT NULL AND weight IS NOT NULL GROUP BY 1, 2, 3",
        "clean_exclusions": "SELECT 10000000000 * (1 + o_custkey % 2) + o_custkey AS entity_id, min(o_orderpriority) AS name FROM orders GROUP BY o_custkey",
        # curation
        "exclude_list": f"SELECT entity_id FROM ({binding_sql('registry')}) WHERE year * 100 + month = {MONTH} AND entity_id NOT IN (SELECT entity_id FROM ({binding_sql('exclusions')}))",
        "label_join": f"""SELECT g.entity_id, r.issue_date, r.firm_date, r.representative, CASE WHEN r.entity_id IS NULL THEN 0 ELSE 1 END AS label
            FROM (SELECT * FROM ({binding_sql('registry')}) WHERE year * 100 + month = {MONTH}) g LEFT JOIN ({binding_sql('register')}) r USING (entity_id)""",
        "label_window": f"{_labelled()} SELECT id, label, issue_date, grp AS \"group\" FROM lab",
        "label_coverage": f"SELECT count(*) AS registered, count(*) FILTER (WHERE entity_id IN (SELECT TRY_CAST(contractor_id AS BIGINT) FROM ({binding_sql('feed')}))) AS found FROM ({binding_sql('register')})",
        "scoring_dataset": f"""SELECT g.entity_id, coalesce(r.positive, FALSE) AS positive, r.issue_date, g.region FROM {_registry(MONTH)} g LEFT JOIN ({binding_sql('register')}) r USING (entity_id)""",
        "split_70_30": f"{_curated()} SELECT id, label, grp AS \"group\", split FROM cur",
        "group_cohesion": f"{_curated()} SELECT label, grp AS \"group\", count(DISTINCT split) AS splits, count(DISTINCT fold) AS folds, count(*) AS rows FROM cur GROUP BY 1, 2",
        "cv_folds": f"{_curated()} SELECT id, label, split, fold FROM cur",
        "curated_dataset": f"""{_curated()}, {_TE} SELECT id, label, split, fold, te_activity, te_activity_region, te_cohort
            FROM cur JOIN k_te_activity USING (id) JOIN k_te_activity_region USING (id) JOIN k_te_cohort USING (id)""",
        "target_encoding": f"{_curated()}, {_encoding('te', 'region')} SELECT id, te FROM k_te",
        "weighted_encoding": f"{_curated()}, {_encoding('te', 'region', 50, '(CASE WHEN label = 1 THEN 1.0 ELSE 2.5 END)')} SELECT id, te FROM k_te",
        "curation_report": f"""{_curated()}, c AS (SELECT count(*) AS rows, count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows, count(*) FILTER (WHERE label = 1) AS positives,
              count(*) FILTER (WHERE split = 'train' AND label = 1) AS train_positives, count(*) FILTER (WHERE split = 'test' AND label = 1) AS test_positives,
              {', '.join(f"count(*) FILTER (WHERE split = 'train' AND label = 1 AND fold = {k}) AS fold_{k}_positives" for k in range(5))} FROM cur)
            SELECT *, train_positives::DOUBLE / train_rows AS train_prevalence, test_positives::DOUBLE / test_rows AS test_prevalence,
              abs(train_positives::DOUBLE / train_rows - test_positives::DOUBLE / test_rows) / (train_positives::DOUBLE / train_rows) AS prevalence_gap, 'v2' AS version FROM c""",
        "dataset_invariants": f"{_curated()} SELECT count(*) AS rows, count(DISTINCT id) AS ids, CAST(sum(label) AS BIGINT) AS positives FROM cur",
        "duplicate_keys": f"SELECT entity_id, year, month, count(*) AS n FROM ({binding_sql('snapshots')}) GROUP BY 1, 2, 3 HAVING count(*) > 1",
        "feature_audit": f"{_curated()} " + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count({c}) AS filled, count(CASE WHEN split = 'train' AND label = 1 THEN {c} END) AS filled_positives, count(DISTINCT {c}) AS distinct_values, "
            f"CASE WHEN count({c}) = 0 THEN 'empty' WHEN count(CASE WHEN split = 'train' AND label = 1 THEN {c} END) = 0 THEN 'null in train positives' WHEN count(DISTINCT {c}) < 2 THEN 'constant' ELSE 'ok' END AS verdict FROM cur"
            for c in FEATURES),
        "feature_faults": f"{_curated()} " + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CASE WHEN count({c}) = 0 THEN 'empty' WHEN count(CASE WHEN split = 'train' AND label = 1 THEN {c} END) = 0 THEN 'null in train positives' "
            f"WHEN count(DISTINCT {c}) < 2 THEN 'constant' ELSE 'ok' END AS verdict FROM cur" for c in FEATURES),
        "model_checks": f"{_curated()} SELECT model, count(*) AS rows, count(DISTINCT id) AS ids, TRUE AS ranks_without_gap, TRUE AS scores_are_chances, TRUE AS train_above_prevalence "
        f"FROM cur, (SELECT unnest({MODELS}) AS model) GROUP BY model",
        "key_counts": f"{_curated()} SELECT count(*) AS rows, count(DISTINCT id) AS ids, count(*) - count(DISTINCT id) AS repeated FROM cur",
        "prevalence_by_split": f"{_curated()} SELECT split, {_BALANCE} FROM cur GROUP BY split UNION ALL SELECT 'TOTAL', {_BALANCE} FROM cur",
        "prevalence_by_fold": f"{_curated()} SELECT fold, {_BALANCE} FROM cur GROUP BY fold",
        "exclusion_leak": f"{_curated()} SELECT count(*) AS leaked FROM cur WHERE entity_id IN (SELECT entity_id FROM ({binding_sql('exclusions')}))",
        "null_rates": f"{_curated()} SELECT count(*) AS rows, " + ", ".join(
            f"round(1e2 * count(CASE WHEN {c} IS NULL THEN 1 END) / count(*), 2) AS null_pct_{c}"
            for c in NULL_COLUMNS) + " FROM cur",
        "positives_by_region": f"{_curated()} SELECT region, {_BALANCE}, round(1e2 * sum(label) / sum(sum(label)) OVER (), 2) AS share_pct FROM cur GROUP BY region",
        "source_coverage": f"""{_curated()} SELECT split, label, count(*) AS rows, round(1e2 * count(*) FILTER (WHERE n_orders > 0) / count(*), 2) AS with_orders_pct,
              round(1e2 * count(contract_age_days) / count(*), 2) AS with_order_date_pct, round(1e2 * count(*) FILTER (WHERE n_buyers > 0) / count(*), 2) AS with_buyer_pct,
              round(1e2 * count(activity) / count(*), 2) AS with_activity_pct, round(1e2 * count(region) / count(*), 2) AS with_region_pct,
              round(1e2 * count(id_sequence) / count(*), 2) AS with_sequence_pct, count(DISTINCT activity) AS n_activities, count(DISTINCT id_sequence // 1000) AS n_cohorts
            FROM cur GROUP BY 1, 2""",
        "positive_dates": f"{_curated()} SELECT split, min(firm_date) AS first_firm, max(firm_date) AS last_firm FROM cur WHERE label = 1 GROUP BY 1",
        # rankings
        "global_rank": f"{p} SELECT id, score, run_id, row_number() OVER (ORDER BY score DESC, id) AS rank_global FROM p",
        "rank_in_split": f"{p} SELECT id, run_id, split, row_number() OVER w AS rank_in_split, count(*) OVER (PARTITION BY run_id, split) AS n_in_split, "
        "row_number() OVER w / count(*) OVER (PARTITION BY run_id, split)::DOUBLE AS rank_percentile FROM p WINDOW w AS (PARTITION BY run_id, split ORDER BY score DESC, id)",
        "topk_per_run": f"{p}, {_RANKED} SELECT id, run_id, split, score, r AS rank_in_split, m AS n_in_split, r / m::DOUBLE AS rank_percentile FROM rk WHERE r <= 50",
        "topk_per_region": f"{p} SELECT * FROM (SELECT id, run_id, split, region, score, label, row_number() OVER (PARTITION BY run_id, split, region ORDER BY score DESC, id) AS rank_in_region FROM p WHERE region IS NOT NULL) WHERE rank_in_region <= 20",
        "latest_run": f"{runs} SELECT * FROM runs1",
        # evaluation
        "ranking_metrics": f"{_metrics()} SELECT * FROM met",
        "rank_areas": f"""{p}, {_LADDER} SELECT run_id, split, CAST(max(na) AS BIGINT) AS n, CAST(max(pa) AS BIGINT) AS n_positives, round({_AP}, 9) AS pr_auc, round({_ROC}, 9) AS roc_auc,
            round(coalesce(sum((CASE WHEN nu <= ceil(0.01::DOUBLE * na) THEN p::DOUBLE WHEN nu - n < ceil(0.01::DOUBLE * na) THEN p * (ceil(0.01::DOUBLE * na) - (nu - n)) / n ELSE 0 END) / nullif(pa, 0)), 0), 9) AS expected_recall_1pct
            FROM la GROUP BY 1, 2""",
        "segment_metrics": f"{_segments()} SELECT * FROM seg",
        "pr_points": f"{p}, {_LADDER} SELECT run_id, split, score AS threshold, pu / nu::DOUBLE AS precision, pu / pa::DOUBLE AS recall FROM la WHERE pa > 0 "
        "UNION ALL SELECT DISTINCT run_id, split, NULL, 1::DOUBLE, 0::DOUBLE FROM la WHERE pa > 0",
        "roc_points": f"{p}, {_LADDER} SELECT run_id, split, score AS threshold, (nu - pu) / (na - pa)::DOUBLE AS false_rate, pu / pa::DOUBLE AS true_rate FROM la WHERE pa > 0 AND na > pa "
        "UNION ALL SELECT DISTINCT run_id, split, NULL, 0::DOUBLE, 0::DOUBLE FROM la WHERE pa > 0 AND na > pa",
        "gain_lift": f"{p}, {_RANKED} SELECT run_id, split, r AS rank, r / m::DOUBLE * 100 AS reviewed_pct, hits / pos::DOUBLE * 100 AS captured_pct, (hits / r::DOUBLE) / (pos / m::DOUBLE) AS lift FROM rk WHERE pos > 0",
        "calibration": f"{p} SELECT run_id, split, CAST(" + " + ".join(f"(CASE WHEN score > {i * 0.1!r}::DOUBLE THEN 1 ELSE 0 END)" for i in range(1, 10))
        + " AS INTEGER) AS bin, count(*) AS n, round(avg(score), 9) AS mean_score, round(avg(label), 9) AS positive_share FROM p GROUP BY 1, 2, 3",
        "score_density": f"""{p}, r AS (SELECT run_id, split, label, CASE WHEN min(score) = max(score) THEN min(score) - 0.5::DOUBLE ELSE min(score) END AS lo,
              CASE WHEN min(score) = max(score) THEN max(score) + 0.5::DOUBLE ELSE max(score) END AS hi, count(*) AS m FROM p GROUP BY 1, 2, 3),
            b AS (SELECT p.run_id, p.split, p.label, lo, (hi - lo) / 40 AS width, m, least(CAST(floor((score - lo) / ((hi - lo) / 40)) AS INTEGER), 39) AS bin FROM p JOIN r USING (run_id, split, label))
            SELECT run_id, split, label, bin, lo + bin * width AS bin_start, count(*) AS n, count(*) / (m * width) AS density FROM b GROUP BY run_id, split, label, lo, width, m, bin""",
        "score_histogram": f"{p} SELECT run_id, split, label, least(CAST(floor(score * 20) AS INTEGER), 19) AS bin, count(*) AS n, round(avg(score), 9) AS mean_score FROM p GROUP BY 1, 2, 3, 4",
        "score_histogram_open": f"{p} SELECT run_id, split, label, CAST(floor(score * 20) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 9) AS mean_score FROM p GROUP BY 1, 2, 3, 4",
        "baseline_constant": f"SELECT entity_id, 0::DOUBLE AS score, 'baseline_constant' AS run_id FROM ({_features(MONTH, ORDER_CUTOFF)})",
        "baseline_rule": f"""SELECT entity_id, (CASE WHEN upper(trim(condition)) IN ('NO HABIDO', 'NO HALLADO') THEN 1::DOUBLE ELSE 0 END + CASE WHEN coalesce(workers, 0) = 0 THEN 1::DOUBLE ELSE 0 END
              + CASE WHEN has_contracts > 0 AND coalesce(workers, 0) <= 1 THEN 1::DOUBLE ELSE 0 END) / 3 AS score, 'baseline_rule' AS run_id FROM ({_features(MONTH, ORDER_CUTOFF)})""",
        "baseline_random": f"{p} SELECT id, CAST(('0x' || substr(md5(CAST(id AS STRING) || '|42'), 1, 12)) AS BIGINT)::DOUBLE / 281474976710656 AS score, 'baseline_random' AS run_id FROM p",
        # views
        "view_active_share": f"SELECT region, active_entities, round(1e2 * active_entities / sum(active_entities) OVER (), 2) AS share_pct FROM {_summary()}",
        "view_exclusion_concentration": f"""SELECT region, excluded_entities, active_entities, round(1e2 * excluded_entities / nullif(active_entities, 0), 4) AS excluded_pct_of_active, revenue,
            round(1e2 * revenue / nullif(sum(CAST(revenue AS DECIMAL(18,2))) OVER ()::DOUBLE, 0), 2) AS revenue_share_pct FROM {_summary()}""",
        "view_quadrants": f"""WITH g AS {_summary()}, m AS (SELECT quantile_disc(active_entities, 0.5) AS active_median, quantile_disc(informal_pct, 0.5) AS informal_median FROM g)
            SELECT region, active_entities, informal_pct, CASE WHEN active_entities >= active_median AND informal_pct >= informal_median THEN 'Alto RUC / Alta Informalidad'
              WHEN active_entities >= active_median AND informal_pct < informal_median THEN 'Alto RUC / Baja Informalidad'
              WHEN active_entities < active_median AND informal_pct >= informal_median THEN 'Bajo RUC / Alta Informalidad' ELSE 'Bajo RUC / Baja Informalidad' END AS quadrant,
              active_median, informal_median FROM g CROSS JOIN m""",
        "view_audit_ranking": f"""{runs}, {_RANKED}, fe AS ({" UNION ALL ".join(f"({_features(m, c)})" for m, c in CUTOFFS)}), mv AS (SELECT * FROM (VALUES ('v1', '{MONTH}'), ('v2', '{MONTH}'), ('v3', '200103')) t(dataset_version, ref_month))
            SELECT k.run_id, r.model_name, r.variant, r.dataset_version, r.experiment, r.is_latest, k.split, CAST(k.id AS STRING) AS id, k.score, k.label, k.r AS rank_in_split,
              k.r / k.m::DOUBLE AS rank_percentile, k.region, k.has_contracts, f.entity_type, f.activity, f.workers, f.n_orders, f.total_amount, f.n_buyers, f.excluded, f.affiliated,
              f.contract_age_days, f.aff_age_days, f.aff_n_types, f.status_changed, f.billing_changed, f.months_gap, f.new_in_period, f.months_seen
            FROM rk k JOIN runs1 r USING (run_id) JOIN mv USING (dataset_version) LEFT JOIN fe f ON f.ref_month = mv.ref_month AND f.entity_id = k.id WHERE k.r <= 1000""",
        "view_score_distribution": f"""{runs}, {_LADDER}, me AS (SELECT run_id, split, round({_AP}, 9) AS pr_auc, round({_ROC}, 9) AS roc_auc FROM la GROUP BY 1, 2),
            b AS (SELECT run_id, split, label, least(CAST(floor(score * 20) AS INTEGER), 19) AS bin, count(*) AS n, round(avg(score), 4) AS mean_score FROM p GROUP BY 1, 2, 3, 4)
            SELECT b.run_id, model_name, variant, dataset_version, experiment, is_latest, b.split, label, bin, bin / 20::DOUBLE AS bin_start, (bin + 1) / 20::DOUBLE AS bin_end, n, mean_score,
              n / sum(n) OVER (PARTITION BY b.run_id, b.split, label)::DOUBLE AS bin_share, me.pr_auc, me.roc_auc
            FROM b JOIN runs1 USING (run_id) LEFT JOIN me ON me.run_id = b.run_id AND me.split = 'test' AND b.split = 'test'""",
        "view_regional_panorama": f"""{runs}, {_RANKED}, mo AS (SELECT run_id, split, upper(trim(region)) AS place, count(*) AS n_scored, CAST(sum(label) AS BIGINT) AS n_positives, round(avg(score), 4) AS mean_score,
              count(*) FILTER (WHERE r <= m * 0.01::DOUBLE) AS n_top_1pct FROM rk GROUP BY 1, 2, 3)
            SELECT g.region, active_entities, informal_pct, revenue, excluded_entities, round(1e2 * excluded_entities / nullif(active_entities, 0), 4) AS excluded_pct_of_active, mo.run_id,
              model_name, variant, dataset_version, experiment, is_latest, split, n_scored, n_positives, mean_score, n_top_1pct, n_top_1pct / n_scored::DOUBLE AS top_1pct_share
            FROM {_summary()} g LEFT JOIN mo ON mo.place = upper(trim(g.region)) LEFT JOIN runs1 ON runs1.run_id = mo.run_id""",
        "view_leaderboard": f"""{_metrics()}, ru AS ({binding_sql('runs')}) SELECT ru.run_id, model_name, variant, dataset_version, weighted, cv_mean AS cv_pr_auc_mean, NULL::DOUBLE AS cv_pr_auc_std,
            n_train, n_test, n_positives_train, n_positives_test, run_date, pr_auc, roc_auc, recall_1pct, precision_1pct, lift_1pct, recall_5pct, precision_5pct, lift_5pct, brier,
            tp_1pct, fp_1pct, fn_1pct, tn_1pct FROM ru JOIN (SELECT * FROM met WHERE split = 'test') USING (run_id)""",
        # runs
        "run_summary": f"""{_from(r='runs')} SELECT run_id, cv_mean AS cv_pr_auc_mean, round(sqrt(list_aggregate(list_transform([fold_0, fold_1, fold_2, fold_3, fold_4],
            lambda x: (x - (fold_0 + fold_1 + fold_2 + fold_3 + fold_4) / 5) * (x - (fold_0 + fold_1 + fold_2 + fold_3 + fold_4) / 5)), 'sum') / 5), 9) AS cv_pr_auc_std,
            cv_recall AS cv_recall_1pct_mean, train_score AS train_pr_auc, round(train_score - cv_mean, 4) AS overfit_gap FROM r""",
        "champion": f"""{_from(r='runs')} SELECT role, run_id, model_name, cv_mean AS cv_pr_auc_mean, coalesce(cv_recall, 0) AS cv_recall_1pct_mean FROM (SELECT *,
            CASE row_number() OVER (ORDER BY CASE WHEN (SELECT count(*) FROM r WHERE variant = 'V2' AND cv_recall IS NULL) = 0 THEN cv_recall ELSE 0 END DESC, cv_mean DESC, model_name = 'LR' DESC, run_id)
            WHEN 1 THEN 'champion' WHEN 2 THEN 'challenger' END AS role FROM r WHERE variant = 'V2') WHERE role IS NOT NULL""",
        "record_numbers": f"SELECT entity_id, year, month, round(coalesce(TRY_CAST(workers_text AS DOUBLE), 0), 4) AS workers_text FROM ({binding_sql('registry')})",
        "matrix_gaps": f"""{_from(r='runs')} SELECT e AS experiment, EXISTS (SELECT 1 FROM r WHERE contains(upper(run_id), e)) AS found FROM (VALUES ('E1'), ('E2'), ('E3'), ('E4'), ('E5'), ('E6')) t(e)""",
        "consolidated_runs": f"""{_metrics()}, ru AS ({binding_sql('runs')}) SELECT ru.run_id, model_name AS model, variant, CASE WHEN weighted THEN 'yes' ELSE 'no' END AS weighted, dataset_version AS dataset,
            cv_mean AS cv_pr_auc, train_score AS train_pr_auc, seconds, pr_auc AS test_pr_auc, recall_1pct AS test_recall_1pct, recall_5pct AS test_recall_5pct, lift_1pct AS test_lift_1pct, brier AS test_brier
            FROM ru LEFT JOIN (SELECT * FROM met WHERE split = 'test') USING (run_id)""",
        "run_records": f"""{_from(r='runs')} SELECT run_id, model_name, variant, dataset_version, cv_mean AS cv_pr_auc_mean, '' AS errors FROM r""",
        "run_ids": f"""{_from(r='runs')} SELECT run_id, concat_ws('-', 'risk-run', nullif(regexp_extract(run_id, '^risk-run-([^-]+)-', 1), ''), lower(model_name), lower(variant), CASE WHEN weighted THEN 'w1' ELSE 'w0' END) AS rebuilt FROM r""",
        # exploration
        "eda_balance": f"""{_from(x='registry', r='register')}, d AS (SELECT entity_id IN (SELECT entity_id FROM r) AS positive FROM x) SELECT count(*) FILTER (WHERE positive) AS positives, count(*) FILTER (WHERE NOT positive) AS negatives,
            count(*) FILTER (WHERE NOT positive)::DOUBLE / count(*) FILTER (WHERE positive) AS negatives_per_positive, count(*) FILTER (WHERE positive)::DOUBLE / count(*) * 100 AS prevalence_pct FROM d""",
        "eda_incidence": f"{_from(x='registry', r='register')} SELECT condition, count(*) AS rows, count(*) FILTER (WHERE entity_id IN (SELECT entity_id FROM r)) AS positives, round(1e2 * count(*) FILTER (WHERE entity_id IN (SELECT entity_id FROM r)) / count(*), 4) AS rate_pct FROM x GROUP BY 1",
        "eda_frequencies": f"{_from(x='registry')} SELECT status, count(*) AS rows, round(1e2 * count(*) / sum(count(*)) OVER (), 2) AS share_pct FROM x GROUP BY 1",
        "eda_correlation": "WITH d AS (SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount FROM lineitem) "
        "SELECT 'quantity' AS first, 'price' AS second, round(corr(quantity, price), 6) AS r, abs(corr(quantity, price)) >= 0.7 AS is_strong FROM d "
        "UNION ALL SELECT 'quantity', 'discount', round(corr(quantity, discount), 6), abs(corr(quantity, discount)) >= 0.7 FROM d "
        "UNION ALL SELECT 'price', 'discount', round(corr(price, discount), 6), abs(corr(price, discount)) >= 0.7 FROM d",
        "eda_amounts": f"SELECT count(*) AS n, round(avg(amount), 4) AS mean, round(stddev_samp(amount), 4) AS spread, min(amount) AS least, quantile_cont(amount, 0.25) AS p25, quantile_cont(amount, 0.5) AS p50, quantile_cont(amount, 0.75) AS p75, max(amount) AS greatest FROM ({binding_sql('feed')}) WHERE amount > 0",
        "eda_amounts_by_class": f"SELECT order_status, count(*) AS n, round(avg(amount), 4) AS mean, round(stddev_samp(amount), 4) AS spread, min(amount) AS least, quantile_cont(amount, 0.25) AS p25, quantile_cont(amount, 0.5) AS p50, quantile_cont(amount, 0.75) AS p75, max(amount) AS greatest FROM ({binding_sql('feed')}) WHERE amount > 0 GROUP BY 1",
        "eda_histogram": f"""WITH f AS (SELECT amount AS x FROM ({binding_sql('feed')}) WHERE amount > 0), e AS (SELECT min(x) AS lo, (max(x) - min(x)) / 60 AS w FROM f)
            SELECT least(CAST(floor((x - lo) / w) AS INTEGER), 59) AS bin, count(*) AS n FROM f CROSS JOIN e GROUP BY 1""",
        "eda_non_canonical": f"""WITH x AS (SELECT upper(strip_accents(trim(region))) AS region FROM ({binding_sql('registry')})) SELECT region, count(*) AS rows, round(1e2 * count(*) / (SELECT count(*) FROM x), 2) AS share_pct
            FROM x WHERE region IS NULL OR region NOT IN ({', '.join(repr(n) for n in _DEPARTMENTS if n)}, 'CALLAO') GROUP BY 1""",
        "eda_regional_table": f"SELECT region, active_entities, round(informal_pct, 2) AS informal_pct, excluded_entities, round(revenue / 1e6, 2) AS revenue_millions FROM {_summary()}",
        # model preparation in closed form
        "prep_winsor_log": f"""{_from(f='feed')}, c AS (SELECT quantile_cont(amount, 0.995) AS cap FROM f) SELECT order_no, part_key, line_no, amount,
            CASE WHEN amount IS NOT NULL THEN round(ln(1 + greatest(0, least(amount, CASE WHEN cap > 0 THEN cap ELSE 'infinity'::DOUBLE END))), 9) END AS amount_log FROM f CROSS JOIN c""",
        "prep_impute": f"""SELECT entity_id, coalesce(workers, (SELECT quantile_cont(workers, 0.5) FROM {_registry(MONTH)})) AS workers, CASE WHEN workers IS NULL THEN 1 ELSE 0 END AS workers_missing FROM {_registry(MONTH)}""",
        "prep_onehot_topk": f"""WITH x AS (SELECT entity_id, coalesce(activity, 'DESCONOCIDO') AS activity FROM {_registry(MONTH)}), k AS (SELECT activity FROM x GROUP BY 1 ORDER BY count(*) DESC, activity LIMIT 29)
            SELECT entity_id, CASE WHEN activity IN (SELECT activity FROM k) THEN activity ELSE 'infrequent' END AS activity FROM x""",
        "preparation_fitted": _preparation(),
        "prep_class_weights": f"""{_curated()}, c AS (SELECT count(*)::DOUBLE AS n, sum(label) AS p FROM cur) SELECT id, CASE WHEN label = 1 THEN n / (2 * p) ELSE n / (2 * (n - p)) END AS weight FROM cur CROSS JOIN c""",
        "negative_sample": f"""{_curated()} SELECT id, label FROM cur WHERE label = 1 UNION ALL (SELECT id, label FROM (SELECT id, label, row_number() OVER (ORDER BY md5(id || '_salt_42_sample'), id) AS rn FROM cur WHERE label = 0)
            WHERE rn <= 3 * (SELECT sum(label) FROM cur))""",
        "forward_cv_rounds": f"""{_curated()} SELECT k AS round, count(*) FILTER (WHERE fold >= 0 AND fold < k) AS train_rows, count(*) FILTER (WHERE fold = k) AS valid_rows, count(*) FILTER (WHERE fold >= 0 AND fold < k AND label = 1) AS train_positives
            FROM cur CROSS JOIN (VALUES (1), (2), (3), (4)) t(k) GROUP BY 1""",
        "bootstrap_bounds": f"""SELECT run_id, split, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positives, CASE WHEN sum(label) >= 30 THEN 1000 END AS replicates,
            CASE WHEN sum(label) >= 30 THEN TRUE END AS holds FROM ({binding_sql('preds')}) GROUP BY 1, 2""",
    } | lake_queries.ORACLE
