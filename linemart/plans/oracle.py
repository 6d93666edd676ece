"""The same layers as common table expressions for DuckDB."""

from __future__ import annotations

from linemart.functions.columns import BAND_NAMES, BANDS, MONTHS
from linemart.operators.facts import MEASURES, split_measures
from linemart.plans.adapters import ATTRIBUTES, DETAIL, LICENCE, NAME, NATURAL_KEY, PERMIT, REPORTED, SERIES, STATUS, TAX


def commas(names, form: str = "{}") -> str:
    return ", ".join(form.format(n, n=n) for n in names)


def _bands() -> str:
    out = []
    for d in ("dl", "ul"):
        out.append(f"sum(CASE WHEN {d} IS NULL OR {d} = 0 THEN 1 ELSE 0 END)::BIGINT AS {d}_no_data")
        for name, low, high in BANDS:
            top = "" if high is None else f" AND {d} < {high}"
            out.append(f"sum(CASE WHEN {d} > 0 AND {d} >= {low}{top} THEN 1 ELSE 0 END)::BIGINT AS {d}_{name}")
    return ", ".join(out)


def same(a: str, b: str, names) -> str:
    return " AND ".join(f"{a}.{n} IS NOT DISTINCT FROM {b}.{n}" for n in names)


def permit_date(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr({c}, 1, 10) AS DATE) "
        f"WHEN regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN CAST(try_strptime(substr({c}, 1, 10), '%d/%m/%Y') AS DATE) END"
    )


BASE = [c for c in MEASURES if c != "users"]
PID = "(year({0}) * 100 + month({0}))::INT"
DIGITS = "nullif(regexp_replace(coalesce({0}, ''), '[^0-9]', '', 'g'), '')"

CTES = {
    "detail": f"SELECT {', '.join(f'{e} AS {n}' for n, e in DETAIL.items())} FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE {REPORTED}",
    "summary": f"SELECT {commas([*NATURAL_KEY, *ATTRIBUTES])}, count(*) AS lines, sum(users)::BIGINT AS users, {_bands()} FROM detail GROUP BY {commas([*NATURAL_KEY, *ATTRIBUTES])}",
    "spans": f"SELECT {commas(SERIES)}, min(month) AS a, max(month) AS b FROM summary GROUP BY {commas(SERIES)}",
    "spine": f"SELECT {commas(SERIES)}, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month FROM spans",
    "carried": f"SELECT {commas(SERIES, 'p.{}')}, p.month, s.lines IS NOT NULL AS is_reported, max(s.month) OVER (PARTITION BY {commas(SERIES, 'p.{}')} ORDER BY p.month) AS source_month FROM spine p LEFT JOIN summary s ON {same('p', 's', NATURAL_KEY)}",
    "consolidated": f"SELECT {commas(SERIES, 'c.{}')}, c.month, {commas([*ATTRIBUTES, *MEASURES], 's.{}')}, is_reported, NOT is_reported AS is_imputed FROM carried c JOIN summary s ON {same('c', 's', SERIES)} AND c.source_month = s.month",
    "test_rows": "SELECT * FROM consolidated WHERE provider_name ILIKE '%prueba%'",
    "real_rows": f"SELECT * FROM consolidated c WHERE NOT EXISTS (SELECT 1 FROM test_rows t WHERE {DIGITS.format('t.tax_id_raw')} = {DIGITS.format('c.tax_id_raw')}) AND NOT EXISTS (SELECT 1 FROM test_rows t WHERE trim(t.licence) = trim(c.licence))",
    "tax_ids": f"SELECT licence, arg_max(t, (month, t)) AS latest FROM (SELECT licence, month, {DIGITS.format('tax_id_raw')} AS t FROM real_rows) WHERE t IS NOT NULL GROUP BY licence",
    "taxed": f"SELECT r.*, coalesce({DIGITS.format('tax_id_raw')}, latest) AS tax_id FROM real_rows r LEFT JOIN tax_ids USING (licence)",
    "normalised": f"SELECT *, CASE WHEN tax_id IS NOT NULL THEN 'RUC|' || tax_id ELSE 'PEVA|' || licence END AS provider_id, 'GEO|' || coalesce(province_code, 'SIN_PROVINCIA') || '|' || coalesce(canton_code, 'SIN_CANTON') || '|' || coalesce(parish_code, 'SIN_PARROQUIA') AS geography_id, {PID.format('month')} AS period_id FROM taxed",
    "licence_geo": f"SELECT period_id, month, provider_id, licence, geography_id, {', '.join(f'sum({c})::BIGINT AS {c}' for c in MEASURES)}, {', '.join(f'sum({c}) FILTER (is_reported)::BIGINT AS {c}_reported' for c in BASE)}, {', '.join(f'sum({c}) FILTER (is_imputed)::BIGINT AS {c}_imputed' for c in BASE)}, bool_or(is_reported) AS has_reported, bool_or(is_imputed) AS has_imputed, bool_and(is_reported) AS all_reported, count(*) AS source_rows FROM normalised GROUP BY period_id, month, provider_id, licence, geography_id",
    "grouped": f"SELECT period_id, month, provider_id, geography_id, count(*) AS n_licences, CASE WHEN count(*) = 1 THEN 'UN_SOLO_PEVA' WHEN count(lines) = 0 THEN 'TODOS_SIN_DATO' WHEN count(DISTINCT lines) <= 1 THEN 'PEVA_DUPLICADOS_MISMO_VALOR_O_UNICO' ELSE 'PEVA_VALORES_DIFERENTES_SUMADOS' END AS state, {', '.join(f'max({c}) AS x_{c}, sum({c})::BIGINT AS s_{c}' for c in split_measures())}, bool_or(has_reported) AS has_reported, bool_or(has_imputed) AS has_imputed FROM licence_geo GROUP BY period_id, month, provider_id, geography_id",
    "fact": f"SELECT period_id, month, provider_id, geography_id, n_licences, state, {', '.join(f'''CASE WHEN state = 'PEVA_VALORES_DIFERENTES_SUMADOS' THEN s_{c} ELSE x_{c} END AS {c}''' for c in split_measures())}, has_reported, has_imputed FROM grouped",
    "geographies": "SELECT geography_id, unnest(arg_max({'province_code': province_code, 'province_name': province_name, 'canton_code': canton_code, 'canton_name': canton_name, 'parish_code': parish_code, 'parish_name': parish_name}, month)) FROM normalised GROUP BY geography_id",
    "bridge": "SELECT geography_id, unnest(list_filter(['NACIONAL|ECUADOR', 'PROVINCIA|' || province_code, 'CANTON|' || canton_code, 'PARROQUIA|' || parish_code], lambda x: x IS NOT NULL)) AS territory_id FROM geographies",
    "territories": "SELECT territory_id, level, level_order, code, min(name) AS name FROM (SELECT 'NACIONAL|ECUADOR' AS territory_id, 'NACIONAL' AS level, 0 AS level_order, NULL::VARCHAR AS code, 'Ecuador' AS name FROM geographies UNION ALL SELECT 'PROVINCIA|' || province_code, 'PROVINCIA', 1, province_code, province_name FROM geographies WHERE province_code IS NOT NULL UNION ALL SELECT 'CANTON|' || canton_code, 'CANTON', 2, canton_code, canton_name FROM geographies WHERE canton_code IS NOT NULL UNION ALL SELECT 'PARROQUIA|' || parish_code, 'PARROQUIA', 3, parish_code, parish_name FROM geographies WHERE parish_code IS NOT NULL) GROUP BY territory_id, level, level_order, code",
    "periods": f"SELECT {PID.format('month')} AS period_id, month, year(month)::INT AS year, month(month)::INT AS month_number, list_extract([{commas(MONTHS, chr(39) + '{}' + chr(39))}], month(month)::INT) AS month_name, quarter(month)::INT AS quarter, strftime(month, '%Y-%m') AS year_month, year(month) || '-T' || quarter(month) AS year_quarter, CAST(date_trunc('quarter', month) AS DATE) AS quarter_start, last_day(month) AS month_end FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM detail)",
    "providers": f"SELECT provider_id, l.provider_name AS provider_name, l.tax_id AS tax_id, l.permit_text AS permit_text, {permit_date('l.permit_text')} AS permit_date, first_month, last_month, first_reported, last_reported, is_cancelled, statuses, n_licences, licences FROM (SELECT provider_id, arg_max({{'provider_name': provider_name, 'tax_id': tax_id, 'permit_text': permit_text}}, (month, licence)) AS l, min(month) AS first_month, max(month) AS last_month, min(month) FILTER (is_reported) AS first_reported, max(month) FILTER (is_reported) AS last_reported, bool_and(status ILIKE '%cancelac%') AS is_cancelled, string_agg(DISTINCT status, ', ' ORDER BY status) AS statuses, count(DISTINCT licence) AS n_licences, string_agg(DISTINCT licence, ', ' ORDER BY licence) AS licences FROM normalised GROUP BY provider_id)",
    "ptm": "SELECT period_id, month, territory_id, provider_id, sum(coalesce(lines, 0))::BIGINT AS lines, count(lines) AS with_data, sum(users)::BIGINT AS users, sum(coalesce(lines_reported, 0))::BIGINT AS lines_reported, sum(coalesce(lines_imputed, 0))::BIGINT AS lines_imputed, bool_or(has_reported) AS has_reported, bool_or(has_imputed) AS has_imputed FROM fact JOIN bridge USING (geography_id) GROUP BY period_id, month, territory_id, provider_id",
    "market": "SELECT *, round(100.0 * lines_imputed::DOUBLE / nullif(lines, 0), 4) AS pct_imputed FROM (SELECT period_id, month, territory_id, sum(lines)::BIGINT AS lines, sum(users)::BIGINT AS users, sum(lines_reported)::BIGINT AS lines_reported, sum(lines_imputed)::BIGINT AS lines_imputed, count(*) AS n_providers, count(*) FILTER (with_data > 0 AND lines > 0) AS n_positive, count(*) FILTER (with_data > 0 AND lines = 0) AS n_zero, count(*) FILTER (with_data = 0) AS n_no_data, count(*) FILTER (has_reported) AS n_reported FROM ptm GROUP BY period_id, month, territory_id)",
    "speed_wide": "SELECT period_id, month, territory_id, d.direction, d.band_order, d.band, sum(d.l)::BIGINT AS lines, sum(d.r)::BIGINT AS lines_reported, sum(d.i)::BIGINT AS lines_imputed FROM (SELECT period_id, month, geography_id, unnest([" + ", ".join(f"{{'direction': '{d}', 'band_order': {k}, 'band': '{b}', 'l': coalesce({d}_{b}, 0), 'r': coalesce({d}_{b}_reported, 0), 'i': coalesce({d}_{b}_imputed, 0)}}" for d in ("dl", "ul") for k, b in enumerate(BAND_NAMES)) + "]) AS d FROM fact) JOIN bridge USING (geography_id) GROUP BY ALL",
    "speeds": "SELECT *, (sum(lines) OVER w)::BIGINT AS direction_lines, round(100.0 * lines::DOUBLE / nullif(sum(lines) OVER w, 0), 4) AS share_pct FROM speed_wide WINDOW w AS (PARTITION BY period_id, territory_id, direction)",
    "reported_market": "SELECT period_id, month, territory_id, sum(CASE WHEN has_reported THEN lines_reported ELSE 0 END)::BIGINT AS market_reported, count(*) FILTER (has_reported) AS n_reported, count(*) AS n_providers FROM ptm GROUP BY period_id, month, territory_id",
    "share": "SELECT *, rank = 1 AS is_leader FROM (SELECT p.period_id, p.month, p.territory_id, provider_id, lines, lines_reported, lines_imputed, has_reported, has_imputed, market_reported, n_reported, n_providers, CASE WHEN has_reported AND market_reported > 0 THEN round(100.0::DOUBLE * lines_reported / market_reported, 6) END AS share_pct, CASE WHEN has_reported AND lines_reported > 0 AND market_reported > 0 THEN round((100.0::DOUBLE * lines_reported / market_reported) * (100.0::DOUBLE * lines_reported / market_reported), 4) END AS hhi_term, CASE WHEN has_reported AND lines_reported > 0 AND market_reported > 0 THEN (row_number() OVER (PARTITION BY p.period_id, p.territory_id ORDER BY CASE WHEN has_reported AND lines_reported > 0 AND market_reported > 0 THEN lines_reported END DESC NULLS LAST, provider_id))::INT END AS rank, CASE WHEN NOT has_reported THEN 'SIN_REPORTE_ESTE_MES' WHEN lines_reported > 0 THEN 'POSITIVO' WHEN lines_reported = 0 THEN 'CERO' ELSE 'SIN_DATO' END AS line_state, round(100.0 * n_reported::DOUBLE / nullif(n_providers, 0), 4) AS coverage_pct FROM ptm p JOIN reported_market USING (period_id, month, territory_id))",
    "hhi": "SELECT *, round(100.0 * lines_imputed::DOUBLE / nullif(market_reported, 0), 4) AS imputed_pct_of_market FROM (SELECT period_id, month, territory_id, round(sum(hhi_term), 2) AS hhi, max(provider_id) FILTER (rank = 1) AS leader, round(max(share_pct) FILTER (rank = 1), 4) AS leader_share, round(sum(share_pct) FILTER (rank <= 2), 4) AS cr2, round(sum(share_pct) FILTER (rank <= 4), 4) AS cr4, max(market_reported) AS market_reported, sum(lines_imputed)::BIGINT AS lines_imputed, max(n_reported) AS n_reported, max(n_providers) AS n_providers, max(coverage_pct) AS coverage_pct FROM share GROUP BY period_id, month, territory_id)",
    "dominant": "SELECT DISTINCT provider_id FROM share WHERE territory_id = 'NACIONAL|ECUADOR' AND share_pct >= 3",
    "licences": f"SELECT {LICENCE} AS licence, {TAX} AS tax_id, {NAME} AS provider_name, {STATUS} AS status, {PERMIT} AS permit_text FROM supplier UNION ALL SELECT '9' || {LICENCE}, {TAX}, {NAME}, {STATUS}, {PERMIT} FROM supplier WHERE s_suppkey % 10 = 3",
    "last_month": "SELECT licence, month AS last_month, sum(lines)::BIGINT AS lines, sum(users)::BIGINT AS users FROM summary GROUP BY licence, month QUALIFY row_number() OVER (PARTITION BY licence ORDER BY month DESC) = 1",
    "last_detail": f"SELECT l.licence, tax_id, provider_name, status, permit_text, {permit_date('permit_text')} AS permit_date, last_month, lines, users, last_month IS NOT NULL AS has_reports FROM licences l LEFT JOIN last_month USING (licence)",
    "never": "SELECT licence, provider_name, status, permit_date, CASE WHEN permit_date IS NOT NULL THEN DATE '2001-06-15' >= permit_date + INTERVAL 1 YEAR END AS past_grace, CASE WHEN status IN ('Nuevo', 'Opera Normalmente', 'SI') THEN 'activo_sin_reportar' WHEN status IN ('Cancelación', 'NO', 'Opera Irregularmente') THEN 'no_operativo' ELSE 'zona_gris' END AS compliance_class FROM last_detail WHERE NOT has_reports",
    "stopped": "SELECT p.provider_id, provider_name, tax_id, statuses, is_cancelled, first_reported, last_reported, coalesce(sum(f.lines_reported) FILTER (f.month = last_reported), 0)::BIGINT AS lines_last_report, coalesce(sum(f.lines_reported), 0)::BIGINT AS lines_ever, ((year(r.ref) - year(last_reported)) * 12 + month(r.ref) - month(last_reported))::INT AS months_since FROM providers p LEFT JOIN fact f ON f.provider_id = p.provider_id CROSS JOIN (SELECT CAST(max(month) - INTERVAL 3 MONTH AS DATE) AS ref FROM fact) r WHERE first_reported IS NOT NULL GROUP BY ALL",
    "pairs": "SELECT a.tax_id, a.licence AS licence_a, a.provider_name AS provider_name_a, a.status AS status_a, b.licence AS licence_b, b.provider_name AS provider_name_b, b.status AS status_b FROM licences a JOIN licences b ON a.tax_id = b.tax_id AND a.licence < b.licence",
    "coexisting": "SELECT p.*, EXISTS (SELECT 1 FROM detail x JOIN detail y ON x.month = y.month WHERE x.licence = p.licence_a AND y.licence = p.licence_b) AS coexist FROM pairs p",
    "conflicts": "SELECT *, CASE WHEN exact AND old_a <> old_b THEN 'A_DUPLICADO_MIGRACION_CODIFICACION' WHEN holder THEN 'B_SECUENCIA_MISMO_TITULAR' ELSE 'C_NOMBRES_DISTINTOS_MISMO_RUC' END AS category, CASE WHEN exact AND old_a <> old_b THEN CASE WHEN old_a THEN licence_a ELSE licence_b END END AS discarded_licence, CASE WHEN exact AND old_a <> old_b THEN 'DESCARTAR_LEGADO' WHEN holder AND NOT coexist THEN 'SIN_CONFLICTO_NO_COEXISTEN' ELSE 'REVISION_MANUAL' END AS action, CASE WHEN (exact AND old_a <> old_b) OR (holder AND NOT coexist) THEN 'CONFIRMADO_AUTOMATICO' ELSE 'PENDIENTE' END AS review_state FROM (SELECT *, lower(trim(provider_name_a)) = lower(trim(provider_name_b)) AS exact, lower(trim(provider_name_a)) = lower(trim(provider_name_b)) OR lower(provider_name_a) LIKE '%cancelad%' OR lower(provider_name_b) LIKE '%cancelad%' AS holder, upper(trim(status_a)) IN ('SI', 'NO', '-') AS old_a, upper(trim(status_b)) IN ('SI', 'NO', '-') AS old_b FROM coexisting)",
}


def sql(final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in CTES.items()) + "\n" + final

