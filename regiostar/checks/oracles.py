"""The same results in DuckDB SQL, written independently of the Spark code.

Ratios are rounded half away from zero in integer arithmetic, so that ties cannot differ between engines.
"""

from __future__ import annotations

from regiostar import fixtures as fx
from regiostar import schema

_NAMES = ", ".join(f"({code}, '{canonical}', '{dirty}')" for code, canonical, dirty in fx.REGION_NAMES)


def _half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator rounded to ``digits``, as a double; null for a null or zero denominator."""
    n, d = f"(CAST({numerator} AS HUGEINT) * {10**digits})", f"CAST({denominator} AS HUGEINT)"
    rounded = f"((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    return f"(CASE WHEN {d} <> 0 THEN CAST({sign} * {rounded} AS DOUBLE) / {10**digits} END)"


def _lcs(pairs: str, name: str) -> str:
    """Table rows of the longest common subsequence of each (a, b), one step per character of a."""
    return f"""
        SELECT a, b, 0 AS i, [0 FOR x IN range(length(b) + 1)] AS r FROM (SELECT DISTINCT a, b FROM {pairs})
        UNION ALL
        SELECT a, b, i + 1,
               list_reduce(list_prepend([0], [[CAST(j AS INTEGER)] FOR j IN range(1, length(b) + 1)]),
                           lambda done, x: list_append(done,
                             CASE WHEN b[x[1]] = a[i + 1] THEN r[x[1]] + 1 ELSE greatest(r[x[1] + 1], done[x[1]]) END))
        FROM {name} WHERE i < length(a)"""


_CTES = {
    "region_names": f"SELECT * FROM (VALUES {_NAMES}) AS t(code, canonical, dirty)",
    "cohort": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS vigencia,
               CASE WHEN month(o_orderdate) <= 6 THEN 'S1' ELSE 'S2' END AS periodo_otorgamiento,
               c_nationkey AS codigo_departamento, canonical AS departamento, r_name AS categoria_municipio,
               CASE l_returnflag WHEN 'A' THEN 'OFICIAL' WHEN 'N' THEN 'PRIVADO' END AS sector_ies,
               o_orderpriority AS nivel_formacion, l_linestatus AS modalidad_linea,
               o_orderstatus AS modalidad_credito, c_mktsegment AS sexo_al_nacer,
               l_linenumber AS estrato_socioeconomico,
               CASE WHEN l_extendedprice < 20000 THEN 'BAJO' WHEN l_extendedprice < 60000 THEN 'MEDIO' ELSE 'ALTO' END
                 AS rango_valor_desembolsado,
               CAST(l_quantity AS INTEGER) AS total_nuevos_beneficiarios
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
             JOIN region_names ON c_nationkey = code""",
    "clean": """
        SELECT * REPLACE (coalesce(sector_ies, 'NO CLASIFICADO') AS sector_ies) FROM cohort""",
    "macro_raw": """
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS a_o, dirty AS departamento, o_orderpriority AS actividad,
               CAST(code AS VARCHAR) AS c_digo_departamento_divipola,
               CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS valor
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN region_names ON c_nationkey = code""",
    "macro": f"""
        SELECT CAST(a_o AS INTEGER) AS a_o, departamento, CAST(c_digo_departamento_divipola AS DOUBLE) AS code,
               CAST(CAST(CAST(valor AS DOUBLE) AS FLOAT) AS DOUBLE) AS v
        FROM macro_raw WHERE a_o >= '{fx.MACRO_MIN_YEAR}'""",
    # Names compared: (raw, a) and (canonical, b) with sorted, unaccented tokens.
    "sources": """
        SELECT DISTINCT departamento AS raw,
               array_to_string(list_sort(string_split(strip_accents(upper(trim(departamento))), ' ')), ' ') AS a
        FROM macro""",
    "targets": """
        SELECT DISTINCT departamento AS canonical,
               array_to_string(list_sort(string_split(strip_accents(departamento), ' ')), ' ') AS b
        FROM cohort""",
    "lcs": _lcs(
        """(SELECT DISTINCT a, b FROM sources, targets
           WHERE 200 * least(length(a), length(b)) >= 85 * (length(a) + length(b)))""",
        "lcs",
    ),
    "scored": """
        SELECT raw, canonical, CAST(200 AS DOUBLE) * r[-1] / (length(a) + length(b)) AS score
        FROM lcs JOIN sources USING (a) JOIN targets USING (b) WHERE i = length(a)""",
    "mapping": """
        SELECT raw, canonical, score
        FROM (SELECT DISTINCT raw FROM sources) LEFT JOIN (
            SELECT * FROM scored WHERE score >= 85
            QUALIFY row_number() OVER (PARTITION BY raw ORDER BY score DESC, canonical) = 1) USING (raw)""",
    "annual": """
        SELECT a_o AS year, canonical AS region, CAST(avg(v) AS FLOAT) AS v, CAST(avg(code) AS FLOAT) AS code
        FROM macro JOIN mapping ON departamento = raw WHERE canonical IS NOT NULL GROUP BY ALL""",
    "joined": """
        SELECT clean.*, CAST(v AS DOUBLE) AS v
        FROM clean LEFT JOIN annual ON vigencia = year AND departamento = region""",
    "medians": "SELECT vigencia, median(v) AS m FROM joined GROUP BY vigencia",
    # gdp4: the stored value times 10,000 as a whole number.
    "merged": """
        SELECT joined.*, v IS NOT NULL AS matched,
               CAST(floor(CAST(CAST(coalesce(v, m) AS FLOAT) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS gdp4,
               CAST(CAST(coalesce(v, m) AS FLOAT) AS DOUBLE) AS gdp
        FROM joined JOIN medians USING (vigencia)""",
}
for _d in schema.DIMENSIONS:
    _keys = ", ".join(_d.names)
    _order = ", ".join(f"{n} ASC NULLS FIRST" for n in _d.names)
    for _table, _from in (("", "clean"), ("null_", "cohort")):
        _CTES[f"{_table}{_d.table}"] = (
            f"SELECT CAST(row_number() OVER (ORDER BY {_order}) AS INTEGER) AS {_d.key}, {_keys} "
            f"FROM (SELECT DISTINCT {_keys} FROM {_from})"
        )
_CTES["fact"] = "SELECT * FROM merged " + " ".join(
    f"JOIN {d.table} USING ({', '.join(d.names)})" for d in schema.DIMENSIONS
)


def _mart_ctes(rows: str, gdp4: str) -> dict[str, str]:
    """Totals and mart over ``rows``; ``gdp4`` is a whole number or null."""
    lag = "lag({}) OVER s"
    t, w = "total_beneficiarios", "total_depto_anio"
    tp, wp = lag.format(t), lag.format(w)
    share = _half_up(f"{t} * 100", w, 2)
    return {
        "base": f"""
            SELECT vigencia, departamento, codigo_departamento, sector_ies,
                   CAST(sum(total_nuevos_beneficiarios) AS BIGINT) AS total_beneficiarios,
                   count(*) AS num_registros_fact, sum({gdp4}) AS g, count({gdp4}) AS gn
            FROM {rows}
            WHERE estrato_socioeconomico IN (1, 2, 3) AND sector_ies IN ('OFICIAL', 'PRIVADO', 'PRIVADA')
            GROUP BY ALL""",
        "totals": f"SELECT vigencia, departamento, sum({t}) AS {w} FROM base GROUP BY ALL",
        "enriched": f"""
            SELECT base.*, {w}, CASE WHEN gn > 0 THEN CAST(g AS HUGEINT) // gn END AS p,
                   {share} AS participacion_sector_pct
            FROM base JOIN totals USING (vigencia, departamento)""",
        "mart": f"""
            SELECT vigencia, departamento, codigo_departamento, sector_ies, {t}, num_registros_fact,
                   CAST(p AS DOUBLE) / 10000 AS pib_miles_millones_promedio, participacion_sector_pct,
                   {tp} AS beneficiarios_anio_anterior,
                   {_half_up(f"({t} - {tp}) * 100", tp, 2)} AS variacion_yoy_pct,
                   {_half_up(f"(p - {lag.format('p')}) * 100", lag.format('p'), 2)} AS variacion_yoy_pib_pct,
                   {_half_up(f"{t} * 10000", "p", 4)} AS densidad_credito_pib,
                   {lag.format('participacion_sector_pct')} AS participacion_anterior_pct,
                   {_half_up(f"({t} * {wp} - {tp} * {w}) * 100", f"({w} * {wp})", 2)} AS variacion_cuota_pp,
                   CAST(rank() OVER (PARTITION BY vigencia, sector_ies ORDER BY {t} DESC) AS INTEGER)
                     AS rank_depto_por_sector
            FROM enriched WINDOW s AS (PARTITION BY departamento, sector_ies ORDER BY vigencia)""",
    }


_BEFORE_MART = dict(_CTES)


def _sql(main: str, rows: str = "merged", gdp4: str = "gdp4", **extra: str) -> str:
    """``main`` after the shared definitions it may refer to; ``extra`` replaces or adds definitions."""
    ctes = {**_BEFORE_MART, **extra, **_mart_ctes(rows, gdp4)}
    ctes = {**ctes, **{k: v for k, v in extra.items() if k in ctes}}
    body = ",\n".join(f"{name} AS ({text})" for name, text in ctes.items())
    return f"WITH RECURSIVE {body}\n{main}"


def _listing(prefix: str = "") -> str:
    """Dimension, key and natural key as text."""
    parts = []
    for d in schema.DIMENSIONS:
        natural = ", ".join(f"CAST({n} AS VARCHAR)" for n in d.names)
        parts.append(f"SELECT '{d.table}' AS dimension, {d.key} AS sk, concat_ws('|', {natural}) AS natural_key FROM {prefix}{d.table}")
    return " UNION ALL ".join(parts)


def _upsert_ctes() -> dict[str, str]:
    ctes = {}
    for d in schema.DIMENSIONS:
        keys = ", ".join(d.names)
        ctes[f"first_{d.table}"] = (
            f"SELECT row_number() OVER (ORDER BY {keys}) AS {d.key}, {keys} "
            f"FROM (SELECT DISTINCT {keys} FROM clean WHERE vigencia < 1998)"
        )
        ctes[f"grown_{d.table}"] = (
            f"SELECT CAST({d.key} AS INTEGER) AS {d.key}, {keys} FROM first_{d.table} UNION ALL "
            f"SELECT CAST((SELECT max({d.key}) FROM first_{d.table}) + row_number() OVER (ORDER BY {keys}) AS INTEGER), {keys} "
            f"FROM (SELECT DISTINCT {keys} FROM clean EXCEPT SELECT {keys} FROM first_{d.table})"
        )
    return ctes


_CODE_GDP4 = "(codigo_departamento * 10000 + 2500)"
_BENEFICIARIES = "CAST(sum(total_nuevos_beneficiarios) AS BIGINT) AS beneficiaries"
_MART = "vigencia, departamento, codigo_departamento, sector_ies, total_beneficiarios"
_S = "WINDOW s AS (PARTITION BY departamento, sector_ies ORDER BY vigencia)"
_LAG = "lag(total_beneficiarios) OVER s"
_COHORT_NAMES = [f.name for f in schema.COHORT_FIELDS]



def _per_column(template: str, names=tuple(_COHORT_NAMES)) -> str:
    return " UNION ALL ".join(template.format(c=n) for n in names)


def _evidence(column: str, expression: str, dated: bool) -> str:
    number = r"regexp_matches(trim(x), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')"
    dates = "count(TRY_CAST(x AS TIMESTAMP))" if dated else "CAST(0 AS BIGINT)"
    return f"""
        SELECT '{column}' AS "column", count(*) AS n_rows, count(x) AS n_values,
               count(*) FILTER (WHERE {number}) AS n_numbers, {dates} AS n_dates, count(DISTINCT x) AS n_distinct
        FROM (SELECT {expression} AS x FROM events)"""


_EVENT_COLUMNS = (
    ("event_id", "CAST(event_id AS VARCHAR)", False),
    ("fecha", "strftime(ts, '%Y-%m-%d %H:%M:%S')", True),
    ("user_id", "CAST(user_id AS VARCHAR)", False),
    ("event_type", "event_type", False),
    ("value", "CASE WHEN event_id % 20 = 0 THEN 'n/d' ELSE CAST(value AS VARCHAR) END", False),
    ("props", "props", False),
)


def _rule_results(rules: list[tuple], rows: str) -> str:
    """(rule, column, condition of a bad value, whether nulls count, tolerance) as result rows."""
    parts = []
    for i, (rule, column, bad, nulls, mostly) in enumerate(rules):
        base = "count(*)" if nulls else f"count({column})"
        count_bad = f"count(*) FILTER (WHERE {bad})"
        parts.append(f"""
            SELECT {i} AS rule_number, '{rule}' AS rule, '{column}' AS "column", count(*) AS element_count,
                   count(*) - count({column}) AS missing_count, {count_bad} AS unexpected_count,
                   {_half_up(f"{count_bad} * 100", base, 4)} AS unexpected_percent,
                   coalesce(CAST({base} - {count_bad} AS DOUBLE) / nullif({base}, 0) >= {mostly}, true) AS success
            FROM {rows}""")
    return " UNION ALL ".join(parts)


def _constraint_rules() -> list[tuple]:
    rules = []
    for f in schema.COHORT_FIELDS:
        if f.required:
            rules.append(("not_null", f.name, f"{f.name} IS NULL", True, 1.0))
        if f.max_length:
            rules.append(("max_length", f.name, f"length({f.name}) > {f.max_length}", False, 1.0))
    value = schema.MACRO_VALUE
    rules.append(("fits_decimal", value, f"abs({value}) >= 1e11", False, 1.0))
    return rules


_STANDARD_RULES = [
    ("not_null", "vigencia", "vigencia IS NULL", True, 1.0),
    ("not_null", "codigo_departamento", "codigo_departamento IS NULL", True, 1.0),
    ("in_set", "sector_ies", "sector_ies NOT IN ('OFICIAL', 'PRIVADA', 'PRIVADO', 'NO CLASIFICADO')", False, 1.0),
    ("in_set", "estrato_socioeconomico", "estrato_socioeconomico NOT IN (1, 2, 3, 4, 5, 6)", False, 0.95),
    ("between", "total_nuevos_beneficiarios", "total_nuevos_beneficiarios < 0", False, 1.0),
]
_VALUES_CTE = """
    SELECT l_orderkey, l_linenumber,
           CAST(l_quantity AS BIGINT) * CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT) AS value
    FROM lineitem"""
_BOUND = "(quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)))"
_FACT_BY_YEAR = """
    SELECT vigencia, count(*) AS n_rows, CAST(sum({factor} * total_nuevos_beneficiarios) AS BIGINT) AS beneficiaries,
           CAST(sum(codigo_departamento * 4 + 1) AS DOUBLE) / 4 AS gdp
    FROM clean {where} GROUP BY vigencia"""

_EXTRACTED = """
    SELECT format('{:,}', vigencia) AS vigencia_text,
           coalesce(CASE estrato_socioeconomico % 3 WHEN 0 THEN sector_ies WHEN 1 THEN lower(sector_ies)
                    ELSE chr(160) || ' ' || sector_ies || chr(9) END, '-') AS sector_text,
           count(*) AS n_rows, CAST(sum(total_nuevos_beneficiarios) AS BIGINT) AS beneficiaries,
           CAST(sum(codigo_departamento) AS BIGINT) AS codes, count(estrato_socioeconomico) AS strata
    FROM cohort GROUP BY ALL"""

ORACLES: dict[str, str] = {
    # Sources and sinks
    "csv_extract": _sql(_EXTRACTED),
    "csv_sniffed": _sql(_EXTRACTED),
    "required_columns": """
        SELECT 'l_orderkey' AS "column", true AS present, count(l_orderkey) AS n_values FROM lineitem
        UNION ALL SELECT 'l_quantity', true, count(l_quantity) FROM lineitem
        UNION ALL SELECT 'l_discount', false, CAST(0 AS BIGINT)
        UNION ALL SELECT 'l_tax', false, CAST(0 AS BIGINT)
        UNION ALL SELECT 'l_rebate', true, count(l_discount) FROM lineitem""",
    "macro_extract": _sql(f"""
        SELECT a_o, departamento, count(*) AS n_rows, count(DISTINCT actividad) AS activities,
               CAST(sum(CAST(valor AS DECIMAL(15,2))) AS DOUBLE) AS total
        FROM macro_raw WHERE a_o >= '{fx.MACRO_MIN_YEAR}' GROUP BY ALL"""),
    "macro_pages": _sql("SELECT 'records' AS what, count(*) AS records, true AS named FROM macro_raw"),
    "page_completeness": """
        WITH pages AS (
            SELECT CAST(o_orderkey // 100 AS BIGINT) AS page_number, count(*) AS records
            FROM orders WHERE (o_orderkey // 100) % 11 <> 3 AND ((o_orderkey // 100) % 7 <> 2 OR o_orderkey % 100 < 60)
            GROUP BY ALL)
        SELECT page_number, records,
               CAST(coalesce(page_number - lag(page_number) OVER (ORDER BY page_number) - 1, greatest(page_number - 1, 0)) AS BIGINT)
                 AS missing_before,
               CASE WHEN records > 100 THEN 'too many' WHEN page_number = (SELECT max(page_number) FROM pages) THEN 'last'
                    WHEN records < 100 THEN 'cut short' ELSE 'whole' END AS outcome
        FROM pages""",
    "malformed_rows": """
        SELECT 'csv' AS format, CASE WHEN o_orderkey % 7 = 0 THEN 'open quote' WHEN o_orderkey % 5 = 0 THEN 'too many fields'
                 WHEN o_orderkey % 3 = 0 THEN 'short' ELSE 'kept' END AS outcome, count(*) AS n_rows,
               CAST(sum(o_orderkey) FILTER (o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0) AS BIGINT) AS keys
        FROM orders GROUP BY ALL
        UNION ALL
        SELECT 'json', CASE WHEN o_orderkey % 4 = 0 THEN 'rejected' ELSE 'kept' END, count(*),
               CAST(sum(o_orderkey) FILTER (o_orderkey % 4 <> 0) AS BIGINT)
        FROM orders GROUP BY ALL""",
    "parquet_staging": _sql(f"SELECT vigencia, departamento, count(*) AS n_rows, {_BENEFICIARIES} FROM clean GROUP BY ALL"),
    # Cleaning
    "cleaned_cohort": _sql("""
        SELECT vigencia, sector_ies AS sector, departamento AS region, upper(nivel_formacion) AS level,
               upper(sexo_al_nacer) AS sex, count(*) AS n_rows FROM clean GROUP BY ALL"""),
    "join_keys": _sql("SELECT vigencia, departamento AS region, count(*) AS n_rows FROM cohort GROUP BY ALL"),
    "accent_removal": "SELECT doc_id, md5(strip_accents(text)) AS plain_md5 FROM documents",
    "typed_columns": _sql(f"""
        SELECT vigencia, departamento, count(*) AS n_rows,
               count(*) FILTER (WHERE estrato_socioeconomico <> 7) AS known_strata,
               CAST(sum(estrato_socioeconomico) FILTER (WHERE estrato_socioeconomico <> 7) AS BIGINT) AS strata_sum,
               {_BENEFICIARIES}
        FROM cohort GROUP BY ALL"""),
    "macro_aliases": _sql(f"""
        SELECT a_o, count(valor) AS pib_values, CAST(0 AS BIGINT) AS ipc_values,
               CAST(max(CAST(CAST(valor AS DOUBLE) AS FLOAT)) AS DOUBLE) AS largest
        FROM macro_raw WHERE a_o >= '{fx.MACRO_MIN_YEAR}' GROUP BY a_o"""),
    "inferred_types": f"""
        SELECT *, CASE WHEN n_values > 0 AND n_numbers >= 0.9 * n_values THEN 'float'
                       WHEN "column" = 'fecha' AND n_dates = n_values THEN 'timestamp'
                       WHEN n_distinct < 0.5 * n_rows THEN 'category' ELSE 'string' END AS inferred
        FROM ({" UNION ALL ".join(_evidence(*c) for c in _EVENT_COLUMNS)})""",
    "complete_rows": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS a_o, count(*) AS n_rows
        FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY ALL""",
    "target_rows": _sql(f"""
        SELECT sector_ies, estrato_socioeconomico, count(*) AS n_rows, {_BENEFICIARIES} FROM cohort
        WHERE estrato_socioeconomico IN (1, 2, 3) AND sector_ies IN ('OFICIAL', 'PRIVADO', 'PRIVADA') GROUP BY ALL"""),
    "comma_audit": _sql("""
        SELECT 'vigencia' AS source, count(*) AS total_rows, count(*) FILTER (WHERE vigencia >= 1000) AS with_comma FROM cohort
        UNION ALL SELECT 'documents', count(*), count(*) FILTER (WHERE contains(text, ',')) FROM documents"""),
    # Names and macro values
    "fuzzy_mapping": _sql("SELECT * FROM mapping"),
    "mapped_names": _sql("""
        SELECT coalesce(canonical, '-') AS canonical, count(*) AS n_rows
        FROM macro JOIN mapping ON departamento = raw GROUP BY ALL"""),
    "name_scores": _sql(
        """SELECT "left", "right", CAST(200 AS DOUBLE) * r[-1] / (length(a) + length(b)) AS score
           FROM pairs JOIN pair_lcs USING (a, b) WHERE i = length(a)""",
        pairs="""
            SELECT DISTINCT p_name AS "left", concat_ws(' ', p_type, p_name, p_brand) AS "right",
                   array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS a,
                   array_to_string(list_sort(string_split(concat_ws(' ', p_type, p_name, p_brand), ' ')), ' ') AS b
            FROM part""",
        pair_lcs=_lcs("pairs", "pair_lcs"),
    ),
    "part_name_mapping": _sql(
        "SELECT * FROM mapping",
        sources="""
            SELECT DISTINCT raw, array_to_string(list_sort(string_split(upper(raw), ' ')), ' ') AS a
            FROM (SELECT concat_ws(' ', p_name[1:2] || p_name[4:], lower(p_type)) AS raw FROM part)""",
        targets="""
            SELECT DISTINCT canonical, array_to_string(list_sort(string_split(canonical, ' ')), ' ') AS b
            FROM (SELECT concat_ws(' ', p_type, upper(p_name)) AS canonical FROM part)""",
    ),
    "macro_annual": _sql("""
        SELECT year, region, CAST(code AS DOUBLE) AS code_mean, CAST(v AS DOUBLE) AS value_mean FROM annual"""),
    "merged_macro": _sql(f"""
        SELECT vigencia, departamento, gdp AS pib_miles_millones, count(*) AS n_rows, {_BENEFICIARIES}
        FROM merged GROUP BY ALL"""),
    "unmatched_audit": _sql(f"""
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT matched) AS unmatched_rows,
               {_half_up("count(*) FILTER (WHERE NOT matched) * 100", "count(*)", 2)} AS unmatched_percent FROM merged"""),
    "unmatched_regions": _sql("""
        SELECT departamento AS region, count(*) AS unmatched_rows FROM merged WHERE NOT matched
        GROUP BY ALL ORDER BY unmatched_rows DESC, region LIMIT 10"""),
    "residual_nulls": _sql("""
        SELECT 'valor_miles_de_millones_de' AS "column", count(*) FILTER (WHERE gdp IS NULL) AS residual_nulls FROM merged"""),
    "macro_coverage": _sql(f"""
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE matched) AS rows_with_value,
               {_half_up("count(*) FILTER (WHERE matched) * 100", "count(*)", 1)} AS percent FROM merged"""),
    "year_medians": _sql("SELECT a_o, median(CAST(valor AS DOUBLE)) AS median FROM macro_raw GROUP BY a_o"),
    # Star schema
    "surrogate_keys": _sql(_listing()),
    "null_safe_fact": _sql(
        "SELECT sk_period, sk_geography, sk_program, sk_student_profile, count(*) AS n_rows, "
        + _BENEFICIARIES
        + " FROM cohort "
        + " ".join(
            f"JOIN null_{d.table} ON " + " AND ".join(f"cohort.{n} IS NOT DISTINCT FROM null_{d.table}.{n}" for n in d.names)
            for d in schema.DIMENSIONS
        )
        + " GROUP BY ALL"
    ),
    "resolved_fact": _sql(f"""
        SELECT sk_period, sk_geography, sk_program, sk_student_profile, rango_valor_desembolsado,
               count(*) AS n_rows, {_BENEFICIARIES}, CAST(max(gdp4) AS DOUBLE) / 10000 AS gdp
        FROM fact GROUP BY ALL"""),
    "rejected_rows": _sql("""
        SELECT vigencia, count(*) AS n_rows, count(*) AS known_places FROM clean WHERE vigencia >= 2000 GROUP BY vigencia"""),
    "star_join": _sql(f"""
        SELECT vigencia, departamento, sector_ies, estrato_socioeconomico, count(*) AS n_rows, {_BENEFICIARIES}
        FROM clean GROUP BY ALL"""),
    "orphan_keys": _sql("""
        SELECT 'dim_period' AS dimension, count(DISTINCT (vigencia, periodo_otorgamiento)) AS orphan_keys,
               count(*) AS orphan_rows FROM clean WHERE vigencia >= 2000
        UNION ALL SELECT * FROM (VALUES ('dim_geography', 0, 0), ('dim_program', 0, 0), ('dim_student_profile', 0, 0))"""),
    # Loads
    "member_upsert": _sql(_listing("grown_"), **_upsert_ctes()),
    "year_replacement": _sql(
        _FACT_BY_YEAR.format(factor="(CASE vigencia WHEN 1999 THEN 2 ELSE 1 END)", where="WHERE vigencia <> 2001")
    ),
    "full_refresh": _sql(f"""
        SELECT vigencia, departamento, sector_ies, count(*) AS n_rows, {_BENEFICIARIES}, CAST(0 AS BIGINT) AS gdp_values
        FROM clean GROUP BY ALL"""),
    "incremental_run": _sql("SELECT * FROM mart"),
    "mart_refresh": _sql(
        "SELECT * FROM mart",
        rows="doubled",
        gdp4=_CODE_GDP4,
        doubled="""
            SELECT * REPLACE (CASE WHEN vigencia = 1999 THEN 2 ELSE 1 END * total_nuevos_beneficiarios
                              AS total_nuevos_beneficiarios) FROM clean""",
    ),
    "monthly_batches": _sql(
        _FACT_BY_YEAR.format(factor="(CASE vigencia WHEN 1997 THEN 2 WHEN 1998 THEN 3 ELSE 1 END)", where="")
    ),
    "failed_load": _sql(f"""
        SELECT *, (SELECT count(DISTINCT (vigencia, periodo_otorgamiento)) FROM clean WHERE vigencia < 2000) AS periods
        FROM ({_FACT_BY_YEAR.format(factor="1", where="WHERE vigencia < 2000")})"""),
    "run_rejects": _sql(f"""
        SELECT 'with gaps' AS run_id, 'dim_student_profile' AS unresolved, vigencia, count(*) AS n_rows, {_BENEFICIARIES}
        FROM cohort WHERE estrato_socioeconomico = 7 GROUP BY vigencia"""),
    "monthly_run": _sql("""
        SELECT vigencia, count(*) AS n_rows,
               CAST(sum(CASE vigencia WHEN 1997 THEN 2 WHEN 1998 THEN 3 ELSE 1 END * total_nuevos_beneficiarios) AS BIGINT) AS beneficiaries,
               CAST(sum(gdp4) AS DOUBLE) / 10000 AS gdp
        FROM merged GROUP BY vigencia"""),
    "gated_batch": _sql("""
        SELECT 'fact' AS what, CAST(vigencia AS VARCHAR) AS name, count(*) AS n_rows,
               CAST(sum(CASE vigencia WHEN 1998 THEN 3 ELSE 1 END * total_nuevos_beneficiarios) AS BIGINT) AS beneficiaries
        FROM clean GROUP BY vigencia
        UNION ALL SELECT 'loaded', '2024-01', count(*), 0 FROM cohort
        UNION ALL SELECT 'quarantined', '2024-02', count(*), count(*) FROM cohort WHERE vigencia IN (1997, 1998)
        UNION ALL SELECT 'loaded', '2024-03', count(*), 0 FROM cohort WHERE vigencia = 1998"""),
    # Mart and its windows
    "credit_mart": _sql("SELECT * FROM mart"),
    "mart_totals": _sql(f"""
        SELECT {_MART}, num_registros_fact, CAST(CAST(g AS HUGEINT) // gn AS DOUBLE) / 10000 AS pib_miles_millones_promedio
        FROM base"""),
    "region_totals": _sql(f"SELECT {_MART}, CAST(total_depto_anio AS BIGINT) AS total_depto_anio FROM enriched"),
    "sector_share": _sql(f"""
        SELECT {_MART}, CAST(total_depto_anio AS BIGINT) AS total_depto_anio, participacion_sector_pct FROM enriched"""),
    "yearly_change": _sql(f"""
        SELECT {_MART}, CAST(m AS DOUBLE) AS pib_miles_millones_promedio, {_LAG} AS beneficiarios_anio_anterior,
               {_half_up(f"(total_beneficiarios - {_LAG}) * 100", _LAG, 2)} AS variacion_yoy_pct,
               {_half_up("(m - lag(m) OVER s) * 100", "lag(m) OVER s", 2)} AS variacion_yoy_pib_pct,
               {_half_up("total_beneficiarios", "m", 4)} AS densidad_credito_pib
        FROM (SELECT *, total_beneficiarios % 977 - 1 AS m FROM base) {_S}"""),
    "large_totals": _sql(f"""
        SELECT vigencia, departamento, codigo_departamento, sector_ies, total_beneficiarios,
               CAST(m AS DOUBLE) AS pib_miles_millones_promedio,
               CAST(sum(total_beneficiarios) OVER r AS BIGINT) AS total_depto_anio,
               {_half_up("total_beneficiarios * 100::HUGEINT", "sum(total_beneficiarios) OVER r", 2)} AS participacion_sector_pct,
               {_LAG} AS beneficiarios_anio_anterior,
               {_half_up(f"(total_beneficiarios - {_LAG}) * 100::HUGEINT", _LAG, 2)} AS variacion_yoy_pct,
               {_half_up("(m - lag(m) OVER s) * 100", "lag(m) OVER s", 2)} AS variacion_yoy_pib_pct,
               {_half_up("total_beneficiarios", "m", 4)} AS densidad_credito_pib,
               CASE WHEN vigencia IS NOT NULL AND departamento IS NOT NULL THEN
                   {_half_up("total_beneficiarios * 100::HUGEINT", "sum(total_beneficiarios) OVER r", 2)} END AS cuota_pct
        FROM (SELECT * EXCLUDE (total_beneficiarios), (total_beneficiarios % 977 - 1) * 100000000 AS m,
                     CAST((total_beneficiarios % 89 + 1) * 5000000000000000 + total_beneficiarios AS BIGINT) AS total_beneficiarios FROM base)
        WINDOW s AS (PARTITION BY departamento, sector_ies ORDER BY vigencia), r AS (PARTITION BY vigencia, departamento)"""),
    "share_change": _sql(f"""
        SELECT {_MART}, CAST(total_depto_anio AS BIGINT) AS total_depto_anio, participacion_sector_pct,
               participacion_anterior_pct, variacion_cuota_pp
        FROM mart JOIN totals USING (vigencia, departamento)"""),
    "region_rank": _sql(f"SELECT {_MART}, rank_depto_por_sector FROM mart"),
    # Profiling
    "distinct_regions": _sql("SELECT DISTINCT departamento FROM cohort"),
    "distinct_counts": _sql(
        _per_column("SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM cohort")
    ),
    "value_frequencies": _sql("""
        SELECT departamento, count(*) AS "rows" FROM cohort GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 10"""),
    "null_report": _sql(
        _per_column(
            "SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
            + _half_up("(count(*) - count({c})) * 100", "count(*)", 2)
            + " AS percent, (count(*) - count({c})) * 100.0 / count(*) > 5 AS warning FROM cohort"
        )
    ),
    "column_info": _sql(
        " UNION ALL ".join(
            f"SELECT '{f.name}' AS \"column\", '{f.type}' AS type, count({f.name}) AS non_null FROM cohort"
            for f in schema.COHORT_FIELDS
        )
    ),
    "yearly_trend": _sql(
        "SELECT vigencia, "
        + ", ".join(
            f"CAST(sum(total_nuevos_beneficiarios) FILTER (WHERE sector_ies = '{s}') AS BIGINT) AS \"{s.replace(' ', '_')}\""
            for s in ("OFICIAL", "PRIVADO", "NO CLASIFICADO")
        )
        + " FROM clean GROUP BY vigencia"
    ),
    "outlier_report": f"""
        WITH v AS ({_VALUES_CTE}), b AS (SELECT {_BOUND} AS bound FROM v)
        SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, any_value(bound) AS upper_bound,
               count(*) FILTER (WHERE value > bound) AS outliers, count(*) AS total_rows,
               {_half_up("count(*) FILTER (WHERE value > bound) * 100", "count(*)", 2)} AS percent
        FROM v, b""",
    "outlier_rows": f"""
        WITH v AS ({_VALUES_CTE}), b AS (SELECT {_BOUND} AS bound FROM v)
        SELECT l_orderkey, l_linenumber, value FROM v, b WHERE value > bound""",
    "description": _sql(
        _per_column(
            "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            "CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, "
            "quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM cohort",
            [f.name for f in schema.COHORT_FIELDS if f.type == "int"],
        )
    ),
    "price_description": _per_column(
        "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        "round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, "
        "round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem",
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"],
    ),
    "duplicate_rows": _sql("""
        SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates
        FROM (SELECT count(*) AS n FROM cohort GROUP BY ALL)""".replace(
            "GROUP BY ALL", f"GROUP BY {', '.join(_COHORT_NAMES)}"
        )),
    "measure_histogram": _sql("""
        SELECT CAST(least((x - lo) * 50 // (hi - lo), 49) AS INTEGER) AS bin,
               round(lo + CAST(least((x - lo) * 50 // (hi - lo), 49) AS INTEGER) * ((hi - lo) / 50::DOUBLE), 6) AS from_value,
               round(lo + (CAST(least((x - lo) * 50 // (hi - lo), 49) AS INTEGER) + 1) * ((hi - lo) / 50::DOUBLE), 6) AS to_value,
               count(*) AS "rows"
        FROM (SELECT total_nuevos_beneficiarios AS x FROM cohort WHERE total_nuevos_beneficiarios <= 50),
             (SELECT min(total_nuevos_beneficiarios) AS lo, max(total_nuevos_beneficiarios) AS hi FROM cohort
              WHERE total_nuevos_beneficiarios <= 50)
        GROUP BY ALL"""),
    "key_range": _sql(f"""
        SELECT min(vigencia) AS first_year, max(vigencia) AS last_year, count(*) AS total_rows,
               count(*) - count(sector_ies) AS null_rows,
               {_half_up("(count(*) - count(sector_ies)) * 100", "count(*)", 2)} AS null_percent FROM cohort"""),
    "geo_key_audit": _sql("SELECT DISTINCT 'departamento' AS \"column\", departamento AS value FROM macro_raw"),
    "preview": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5",
    # Quality
    "quality_rules": _sql(
        _rule_results(_STANDARD_RULES, "clean")
        + f"""
        UNION ALL SELECT 5, 'row_count_between', 'TABLE', count(*), 0, 0, CAST(0 AS DOUBLE),
               count(*) BETWEEN {schema.MIN_ROWS} AND {schema.MAX_ROWS} FROM clean"""
    ),
    "quality_failures": _sql("""
        SELECT 'in_set' AS rule, 'estrato_socioeconomico' AS "column", CAST(estrato_socioeconomico AS VARCHAR) AS value,
               count(*) AS "rows" FROM cohort WHERE estrato_socioeconomico NOT IN (1, 2, 3, 4, 5, 6) GROUP BY ALL
        UNION ALL SELECT 'not_null', 'sector_ies', '-', count(*) FROM cohort WHERE sector_ies IS NULL"""),
    "quality_history": _sql(f"""
        SELECT 'strict' AS run_id, rule_number, rule, "column", element_count, unexpected_count, success
        FROM ({_rule_results(_STANDARD_RULES, "clean")})
        UNION ALL SELECT 'strict', 5, 'row_count_between', 'TABLE', count(*), 0, true FROM clean
        UNION ALL SELECT 'short', 0, 'not_null', 'vigencia', count(*), 0, true FROM clean"""),
    "table_constraints": _sql(
        _rule_results(_constraint_rules(), "(SELECT *, codigo_departamento * 1e10 AS pib_miles_millones FROM cohort)")
    ),
    "key_uniqueness": _sql("""
        SELECT 'mart' AS what, count(*) AS keys FROM (
            SELECT 1 FROM base GROUP BY vigencia, departamento, sector_ies HAVING count(*) > 1)
        UNION ALL SELECT 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)"""),
    # Dashboard
    "yearly_evolution": _sql(f"""
        SELECT vigencia, CAST(sum(total_beneficiarios) AS BIGINT) AS total_beneficiarios,
               {_half_up("sum(p)", "count(p) * 10000", 4)} AS pib_promedio FROM enriched GROUP BY vigencia"""),
    "yearly_sector_shares": _sql(f"""
        SELECT vigencia, sector_ies, CAST(t AS BIGINT) AS total_beneficiarios,
               {_half_up("t * 100", "sum(t) OVER (PARTITION BY vigencia)", 2)} AS cuota_pct
        FROM (SELECT vigencia, sector_ies, sum(total_beneficiarios) AS t FROM base GROUP BY ALL)"""),
    "regional_sector_shares": _sql(f"""
        SELECT vigencia, departamento, sector_ies, CAST(t AS BIGINT) AS total_beneficiarios,
               {_half_up("t * 100", "sum(t) OVER (PARTITION BY vigencia, departamento)", 2)} AS cuota_pct
        FROM (SELECT vigencia, departamento, sector_ies, sum(total_beneficiarios) AS t FROM base GROUP BY ALL)"""),
    "density_points": _sql("""
        SELECT vigencia, departamento, sector_ies, pib_miles_millones_promedio, total_beneficiarios, densidad_credito_pib
        FROM mart WHERE pib_miles_millones_promedio IS NOT NULL"""),
    "mart_slice": _sql("""
        SELECT * FROM mart WHERE vigencia IN (1999, 2000) AND sector_ies = 'PRIVADO' AND variacion_yoy_pct >= 0"""),
    "written_mart_slice": _sql("""
        SELECT * FROM mart WHERE vigencia IN (1999, 2000) AND sector_ies = 'PRIVADO' AND variacion_yoy_pct >= 0"""),
}
