"""Column expressions: cleaning, identifiers, dates, speed bands, ratios and coordinates. All built-in, no Python rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half-open bands in Kbps, by name.
BANDS = [
    ("lt_1m", 0, 1024), ("1_10m", 1024, 10240), ("10_30m", 10240, 30720), ("30_100m", 30720, 102400),
    ("100m_1g", 102400, 1048576), ("ge_1g", 1048576, None),
]
BAND_NAMES = ["no_data", *(name for name, *_ in BANDS)]
BAND_COLUMNS = [f"{d}_{b}" for d in ("dl", "ul") for b in BAND_NAMES]
BROADBAND, ULTRA = BAND_NAMES[2:], BAND_NAMES[4:]
#: Month names, status codes and classes, and the coordinate box.
MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
ACTIVE_STATES = ["Nuevo", "Opera Normalmente", "SI"]
CLOSED_STATES = ["Cancelación", "NO", "Opera Irregularmente"]
LEGACY_STATES = ["SI", "NO", "-"]
LATITUDES, LONGITUDES = (-5.0, 1.5), (-92.0, -75.0)
NATIONAL = "NACIONAL|ECUADOR"


def clean_tax_id(c: Column) -> Column:
    """Digits only; null if none is left."""
    return F.nullif(F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", ""), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def is_test_provider(name: Column, trade_name: Column | None = None) -> Column:
    names = name if trade_name is None else F.concat_ws(" ", name, trade_name)
    return F.coalesce(names.ilike("%prueba%"), F.lit(False))


def assign_provider_id(tax_id: Column, licence: Column) -> Column:
    return F.when(tax_id.isNotNull(), F.concat(F.lit("RUC|"), tax_id)).otherwise(F.concat(F.lit("PEVA|"), licence))


def assign_geography_id(province: Column, canton: Column, parish: Column, source_parish: Column) -> Column:
    fill = lambda c, name: F.coalesce(blank_to_null(c), F.lit(name))
    return F.concat_ws("|", F.lit("GEO"), fill(province, "SIN_PROVINCIA"), fill(canton, "SIN_CANTON"), F.coalesce(blank_to_null(parish), blank_to_null(source_parish), F.lit("SIN_PARROQUIA")))


def assign_period_id(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def period_id_to_date(period: Column) -> Column:
    return F.make_date(F.floor(period / 100).cast("int"), (period % 100).cast("int"), F.lit(1))


def parse_permit_date(text: Column) -> Column:
    """An ISO date or DD/MM/YYYY at the start; anything else, and days that do not exist, are null."""
    iso, dmy = F.substring(text, 1, 10), F.substring(text, 1, 10)
    parsed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))).when(
        text.rlike(r"^\d{2}/\d{2}/\d{4}"), F.try_to_timestamp(dmy, F.lit("dd/MM/yyyy"))
    )
    return parsed.cast("date")


def speed_bands(kbps: Column, prefix: str) -> list[Column]:
    """A 0/1 column for each band; null and 0 are no data, a negative speed is in no band."""
    out = [F.when(kbps.isNull() | (kbps == 0), 1).otherwise(0).alias(f"{prefix}_no_data")]
    for name, low, high in BANDS:
        hit = (kbps >= low) & (kbps > 0) if high is None else (kbps >= low) & (kbps > 0) & (kbps < high)
        out.append(F.when(hit, 1).otherwise(0).alias(f"{prefix}_{name}"))
    return out


def broadband_totals(prefix: str = "dl") -> tuple[Column, Column]:
    """Lines of at least 1 Mbps, and of at least 30 Mbps."""
    total = lambda names: sum((F.col(f"{prefix}_{n}") for n in names[1:]), F.col(f"{prefix}_{names[0]}"))
    return total(BROADBAND), total(ULTRA)


def rounded(c: Column, scale: int) -> Column:
    """A double rounded as SQL engines round doubles, by its product with the power of ten, halves away from zero.

    F.round goes by the decimal text, which ends apart where that product is under a half and the text is not (1.005).
    Doubles too large for digits behind the point stay, as do those that are not finite.
    """
    power = F.lit(10.0**scale)
    scaled = F.abs(c) * power
    whole = F.floor(scaled)
    up = F.when(scaled - whole >= 0.5, 1).otherwise(0)
    return F.when(scaled < 2.0**52, F.signum(c) * (whole + up) / power).otherwise(c)


def pct(a: Column, b: Column, scale: int) -> Column:
    return rounded(F.try_divide(F.lit(100.0) * a, F.nullif(b, F.lit(0))), scale)


def months_between_int(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def obligation_start(permit: Column) -> Column:
    return assign_period_id(F.add_months(permit, 12))


def is_cancelled(status: Column) -> Column:
    return F.coalesce(status.ilike("%cancelac%"), F.lit(False))


def line_state(reported: Column, lines: Column) -> Column:
    return F.when(~reported, "SIN_REPORTE_ESTE_MES").when(lines > 0, "POSITIVO").when(lines == 0, "CERO").otherwise("SIN_DATO")


def has_any_status(statuses: Column, wanted: list[str]) -> Column:
    """Whether any wanted status is part of a comma list, in any case."""
    out = F.lit(False)
    for w in wanted:
        out = out | F.coalesce(statuses.ilike(f"%{w}%"), F.lit(False))
    return out


def compliance_class(status: Column) -> Column:
    return F.when(status.isin(ACTIVE_STATES), "activo_sin_reportar").when(status.isin(CLOSED_STATES), "no_operativo").otherwise("zona_gris")


def provider_label(name: Column, trade_name: Column, provider_id: Column) -> Column:
    return F.coalesce(blank_to_null(name), blank_to_null(trade_name), provider_id)


def normalise_label(c: Column) -> Column:
    return F.upper(F.trim(c))


def signed_log(v: Column) -> Column:
    return F.signum(v) * F.log10(F.lit(1.0) + F.abs(v))


def row_hash(columns: list[str]) -> Column:
    """MD5 of the values as text in fixed order, joined by |, null as NULL."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]))


def row_snapshot(columns: list[str]) -> Column:
    """The row as JSON, columns in the order given, null as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def dms_numbers(text: Column) -> Column:
    return F.regexp_extract_all(F.replace(_stripped(text), F.lit(","), F.lit(".")), F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1))


def dms_reason(text: Column, numbers: Column | None = None) -> Column:
    """Why a free-text coordinate cannot be converted; null if it can. Its numbers may be given if a column has them."""
    clean, n = _stripped(text), dms_numbers(text) if numbers is None else numbers
    part = lambda k: F.coalesce(F.try_element_at(n, F.lit(k)).try_cast("double"), F.lit(0.0))
    return (
        F.when(text.isNull(), "valor_nulo")
        .when(F.lower(clean).isin("", "nan", "null", "none", "0", "-"), "valor_vacio_o_cero")
        .when(F.size(n) == 0, "sin_componentes_numericos")
        .when((part(2) >= 60) | (part(3) >= 60), "minutos_o_segundos_fuera_de_rango_0_60")
    )


def dms_to_decimal(text: Column, numbers: Column | None = None, reason: Column | None = None) -> Column:
    """Degrees, minutes and seconds to degrees; S, O or W anywhere makes it negative, a minus sign does not."""
    n = dms_numbers(text) if numbers is None else numbers
    part = lambda k: F.coalesce(F.try_element_at(n, F.lit(k)).try_cast("double"), F.lit(0.0))
    value = part(1) + part(2) / 60 + part(3) / 3600
    return F.when((dms_reason(text, n) if reason is None else reason).isNull(), F.when(F.upper(text).rlike("[SOW]"), -value).otherwise(value))


def west_inferred(text: Column, longitude: Column) -> Column:
    return F.coalesce((longitude > 0) & ~F.upper(F.coalesce(text, F.lit(""))).rlike("[NSOEW]"), F.lit(False))


def infer_west_longitude(text: Column, longitude: Column) -> Column:
    return F.when(west_inferred(text, longitude), -longitude).otherwise(longitude)


def range_reason(latitude: Column, longitude: Column) -> Column:
    out = lambda c, name: F.format_string(f"{name}_fuera_de_rango_ecuador(%.4f)", c)
    return (
        F.when(latitude.isNull() | longitude.isNull(), "coordenada_no_convertible")
        .when(~latitude.between(*LATITUDES), out(latitude, "latitud"))
        .when(~longitude.between(*LONGITUDES), out(longitude, "longitud"))
    )


def all_reasons(*reasons: Column) -> Column:
    """Distinct reasons in order, joined by '; '; null if none."""
    return F.nullif(F.array_join(F.array_distinct(F.array_compact(F.array(*reasons))), "; "), F.lit(""))
