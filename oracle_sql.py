"""DuckDB oracle SQL for every registered query.

Each query starts from the same fixture definition as ``voltframe.fixtures``,
written independently in SQL, then states the operator or view in plain SQL.
Output typing follows the shared rule: decimal measures as DOUBLE, counts as
BIGINT, years as INTEGER, ratios divided in DOUBLE.
"""

from __future__ import annotations

BIOMASS = "('AB','MSW','OBS','WDS','OBL','SLW','BLQ','WDL','LFG','OBG')"
RENEWABLE = "('SUN','WND','WAT','GEO','BIO','WAS','MSW')"
FOSSIL = "('COL','BIT','SUB','LIG','NG','DFO','RFO','OIL','PC','NGO','BFG','OG','KER','JF','PG','SGC')"

FIXTURE = """
li_grain AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS file_year,
         l_partkey AS plant_code,
         l_linenumber AS line_no,
         max(l_shipdate) AS file_date,
         min(l_suppkey) AS utility_id,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price_sum,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS is_ret,
         max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS is_prop
  FROM lineitem
  GROUP BY 1, 2, 3
),
gen_rows AS (
  SELECT file_year, file_date, utility_id,
         'U' || CAST(utility_id AS VARCHAR)
             || CASE WHEN utility_id % 10 = 0 AND file_year >= 1999 THEN ' new' ELSE '' END
           AS utility_name,
         plant_code,
         'P' || CAST(plant_code AS VARCHAR) AS plant_name,
         'G' || CAST(line_no AS VARCHAR) AS generator_id,
         CASE WHEN plant_code % 101 = 0 THEN NULL
              ELSE 'S' || CAST((utility_id + CASE WHEN plant_code % 97 = 0 THEN 1 ELSE 0 END) % 25 AS VARCHAR)
         END AS state,
         'C' || CAST(plant_code % 7 AS VARCHAR) AS county,
         CASE (plant_code + line_no) % 9
              WHEN 0 THEN 'NG' WHEN 1 THEN 'SUN' WHEN 2 THEN 'WND' WHEN 3 THEN 'WDS'
              WHEN 4 THEN 'LFG' WHEN 5 THEN 'BIT' WHEN 6 THEN 'MWH' WHEN 7 THEN 'WAT'
         END AS energy_source_1,
         CASE WHEN (plant_code + file_year) % 11 = 0 THEN 'MSW' END AS energy_source_2,
         CAST(NULL AS VARCHAR) AS energy_source_3,
         CAST(NULL AS VARCHAR) AS energy_source_4,
         CAST(NULL AS VARCHAR) AS energy_source_5,
         CAST(NULL AS VARCHAR) AS energy_source_6,
         CASE WHEN plant_code % 53 = 0 THEN NULL ELSE CAST(price_sum AS DECIMAL(18,6)) END
           AS nameplate_capacity_mw,
         CAST(1950 + plant_code % 55 AS BIGINT) AS operating_year,
         CASE WHEN plant_code % 13 = 0 THEN 'n/a'
              WHEN plant_code % 17 = 0 THEN NULL
              WHEN plant_code % 19 = 0 THEN CAST(1990 + plant_code % 12 AS VARCHAR) || ' '
              ELSE CAST(1990 + plant_code % 12 AS VARCHAR)
         END AS retirement_year,
         CAST(1996 + plant_code % 8 AS BIGINT) AS current_year,
         'C' || CAST(plant_code % 9 AS VARCHAR) AS proposed_county,
         is_ret, is_prop
  FROM li_grain
),
generator_operable AS (SELECT *, energy_source_1 AS technology FROM gen_rows),
solar_operable AS (SELECT * FROM gen_rows WHERE energy_source_1 = 'SUN'),
wind_operable AS (SELECT * FROM gen_rows WHERE energy_source_1 = 'WND'),
energystorage_operable AS (SELECT * FROM gen_rows WHERE energy_source_1 = 'MWH'),
generator_retired AS (SELECT * FROM gen_rows WHERE is_ret = 1),
solar_retired AS (SELECT * FROM gen_rows WHERE is_ret = 1 AND energy_source_1 = 'SUN'),
wind_retired AS (SELECT * FROM gen_rows WHERE is_ret = 1 AND energy_source_1 = 'WND'),
energystorage_retired AS (SELECT * FROM gen_rows WHERE is_ret = 1 AND energy_source_1 = 'MWH'),
generator_proposed AS (
  SELECT * REPLACE (proposed_county AS county) FROM gen_rows WHERE is_prop = 1),
energystorage_proposed AS (
  SELECT * REPLACE (proposed_county AS county) FROM gen_rows
  WHERE is_prop = 1 AND energy_source_1 = 'MWH'
    AND file_year >= (SELECT max(file_year) FROM gen_rows) - 1)
"""


def with_fixture(body: str) -> str:
    """``body`` is either ``name AS (...), ... SELECT ...`` or a bare SELECT."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return "WITH " + FIXTURE.strip() + "\n" + body
    return "WITH " + FIXTURE.strip() + ",\n" + body


def pct(num: str, den: str) -> str:
    """ROUND(100 * num / den, 2), half away from zero, in whole numbers; NULL for a zero denominator."""
    n, d = (f"CAST(CAST({x} AS DECIMAL(28,6)) * 1000000 AS HUGEINT)" for x in (num, den))
    return (f"sign({n}) * sign({d}) * CAST((abs({n}) * 20000 + abs({d})) // (2 * NULLIF(abs({d}), 0)) AS DOUBLE)"
            f" / 100.0")


MAX_YEAR = "(SELECT max(file_year) FROM generator_operable)"
ANY_BIOMASS = " OR ".join(f"energy_source_{i} IN {BIOMASS}" for i in range(1, 7))

VIEW_SQL: dict[str, str] = {}

VIEW_SQL["view_a"] = with_fixture(f"""
newest AS (
  SELECT * FROM generator_operable
  QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id
                             ORDER BY file_year DESC, file_date DESC) = 1)
SELECT count(*) AS biomass_operable_generators FROM newest WHERE {ANY_BIOMASS}
""")

VIEW_SQL["view_b"] = with_fixture(f"""
bio AS (
  SELECT utility_id, utility_name, sum(nameplate_capacity_mw) AS biomass_mw
  FROM (SELECT * FROM generator_operable WHERE {ANY_BIOMASS}
        QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id
                                   ORDER BY file_year DESC, file_date DESC) = 1)
  GROUP BY utility_id, utility_name),
ren AS (
  SELECT utility_id, utility_name, sum(nameplate_capacity_mw) AS renew_mw FROM (
    SELECT utility_id, utility_name, nameplate_capacity_mw FROM solar_operable
    QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id ORDER BY file_year DESC, file_date DESC) = 1
    UNION ALL
    SELECT utility_id, utility_name, nameplate_capacity_mw FROM wind_operable
    QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id ORDER BY file_year DESC, file_date DESC) = 1
    UNION ALL
    SELECT utility_id, utility_name, nameplate_capacity_mw FROM energystorage_operable
    QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id ORDER BY file_year DESC, file_date DESC) = 1)
  GROUP BY utility_id, utility_name)
SELECT bio.utility_id, bio.utility_name,
       CAST(bio.biomass_mw AS DOUBLE) AS biomass_mw,
       CAST(coalesce(ren.renew_mw, 0) AS DOUBLE) AS renew_mw,
       CAST(coalesce(ren.renew_mw, 0) - bio.biomass_mw AS DOUBLE) AS surplus_mw
FROM bio LEFT JOIN ren ON ren.utility_id = bio.utility_id
WHERE coalesce(ren.renew_mw, 0) >= bio.biomass_mw
""")

VIEW_SQL["view_c"] = with_fixture("""
per_plant AS (
  SELECT * FROM generator_operable
  QUALIFY row_number() OVER (PARTITION BY plant_code
                             ORDER BY file_year DESC, file_date DESC, generator_id ASC) = 1)
SELECT state, technology, count(DISTINCT plant_code) AS facilities
FROM per_plant GROUP BY state, technology
""")

VIEW_SQL["view_d"] = with_fixture(f"""
per_utility AS (
  SELECT utility_id, utility_name, count(DISTINCT state) AS state_count
  FROM solar_operable GROUP BY utility_id, utility_name),
summary AS (
  SELECT count(*) AS total_utilities,
         count(*) FILTER (WHERE state_count > 1) AS multistate_utilities
  FROM per_utility)
SELECT multistate_utilities, total_utilities,
       {pct('multistate_utilities', 'total_utilities')} AS percent_multistate
FROM summary
""")

VIEW_SQL["view_e"] = with_fixture("""
newest AS (
  SELECT * FROM energystorage_operable WHERE nameplate_capacity_mw IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id, file_year
                             ORDER BY file_date DESC) = 1)
SELECT file_year, quantile_cont(CAST(nameplate_capacity_mw AS DOUBLE), 0.5) AS median_battery_mw
FROM newest GROUP BY file_year
""")

VIEW_SQL["view_f"] = with_fixture("""
per_year AS (
  SELECT utility_id, utility_name, file_year, sum(nameplate_capacity_mw) AS cap FROM (
    SELECT utility_id, utility_name, file_year, nameplate_capacity_mw FROM wind_operable
    WHERE nameplate_capacity_mw IS NOT NULL
    UNION ALL
    SELECT utility_id, utility_name, file_year, nameplate_capacity_mw FROM solar_operable
    WHERE nameplate_capacity_mw IS NOT NULL)
  GROUP BY utility_id, utility_name, file_year)
SELECT utility_id, utility_name, file_year,
       CAST(cap AS DOUBLE) AS wind_solar_capacity_mw,
       CAST(cap - lag(cap) OVER (PARTITION BY utility_id ORDER BY file_year, utility_name) AS DOUBLE)
         AS yoy_increase_mw
FROM per_year
""")

CAPACITY_BY_FUEL = """
cap AS (
  SELECT file_year, state, energy_source_1 AS fuel_type, nameplate_capacity_mw FROM generator_operable
  WHERE nameplate_capacity_mw IS NOT NULL AND {cond}
  UNION ALL
  SELECT file_year, state, 'Solar', nameplate_capacity_mw FROM solar_operable
  WHERE nameplate_capacity_mw IS NOT NULL AND {cond}
  UNION ALL
  SELECT file_year, state, 'Wind', nameplate_capacity_mw FROM wind_operable
  WHERE nameplate_capacity_mw IS NOT NULL AND {cond})"""

VIEW_SQL["view_g"] = with_fixture(CAPACITY_BY_FUEL.format(cond=f"file_year = {MAX_YEAR}") + f""",
per_fuel AS (SELECT state, fuel_type, sum(nameplate_capacity_mw) AS cap FROM cap GROUP BY state, fuel_type)
SELECT state, fuel_type, CAST(cap AS DOUBLE) AS capacity_mw,
       {pct('cap', 'sum(cap) OVER (PARTITION BY state)')} AS pct_of_state_capacity
FROM per_fuel
""")

VIEW_SQL["view_g_evolution"] = with_fixture(
    CAPACITY_BY_FUEL.format(cond=f"file_year > {MAX_YEAR} - 5") + f""",
per_fuel AS (
  SELECT file_year, state, fuel_type, sum(nameplate_capacity_mw) AS cap
  FROM cap GROUP BY file_year, state, fuel_type),
shared AS (
  SELECT file_year, state, fuel_type, cap,
         {pct('cap', 'sum(cap) OVER (PARTITION BY file_year, state)')} AS share
  FROM per_fuel)
SELECT file_year, state, fuel_type, CAST(cap AS DOUBLE) AS capacity_mw,
       share AS pct_of_state_capacity,
       share - lag(share) OVER (PARTITION BY state, fuel_type ORDER BY file_year) AS pct_change
FROM shared
""")

AGED = f"""
aged AS (
  SELECT *, {MAX_YEAR} - operating_year AS age_years FROM generator_operable
  WHERE operating_year IS NOT NULL AND {MAX_YEAR} - operating_year >= 40)"""

VIEW_SQL["view_h"] = with_fixture(AGED + """
SELECT utility_id, utility_name, plant_code, plant_name, generator_id, state, technology,
       energy_source_1, operating_year, age_years,
       CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw
FROM aged
""")

VIEW_SQL["view_h_gap"] = with_fixture(AGED + f"""
SELECT state, technology, CAST(sum(nameplate_capacity_mw) AS DOUBLE) AS capacity_gap_mw,
       count(*) AS aged_generators
FROM aged WHERE file_year = {MAX_YEAR}
GROUP BY state, technology
""")

GEO = """
tot AS (SELECT file_year, state, county, sum(nameplate_capacity_mw) AS total_mw
        FROM generator_operable GROUP BY ALL),
sol AS (SELECT file_year, state, county, sum(nameplate_capacity_mw) AS solar_mw
        FROM solar_operable GROUP BY ALL),
win AS (SELECT file_year, state, county, sum(nameplate_capacity_mw) AS wind_mw
        FROM wind_operable GROUP BY ALL),
sto AS (SELECT file_year, state, county, sum(nameplate_capacity_mw) AS storage_mw
        FROM energystorage_operable GROUP BY ALL),
geo AS (
  SELECT tot.file_year, tot.state, tot.county, tot.total_mw,
         coalesce(sol.solar_mw, 0) AS solar_mw,
         coalesce(win.wind_mw, 0) AS wind_mw,
         coalesce(sto.storage_mw, 0) AS storage_mw
  FROM tot
  LEFT JOIN sol ON sol.file_year = tot.file_year AND sol.state = tot.state AND sol.county = tot.county
  LEFT JOIN win ON win.file_year = tot.file_year AND win.state = tot.state AND win.county = tot.county
  LEFT JOIN sto ON sto.file_year = tot.file_year AND sto.state = tot.state AND sto.county = tot.county)"""

VIEW_SQL["view_i"] = with_fixture(GEO + """
SELECT file_year, state, county, CAST(total_mw AS DOUBLE) AS total_mw,
       CAST(solar_mw AS DOUBLE) AS solar_mw, CAST(wind_mw AS DOUBLE) AS wind_mw,
       CAST(storage_mw AS DOUBLE) AS storage_mw
FROM geo
""")

PENETRATION = GEO + f""",
shares AS (
  SELECT file_year, state, county,
         {pct('solar_mw + wind_mw', 'total_mw')} AS renewable_share,
         {pct('storage_mw', 'total_mw')} AS storage_share
  FROM geo),
pen AS (
  SELECT *,
         renewable_share - lag(renewable_share) OVER w AS renewable_share_change,
         storage_share - lag(storage_share) OVER w AS storage_share_change
  FROM shares
  WINDOW w AS (PARTITION BY state, county ORDER BY file_year))"""

VIEW_SQL["view_i_change"] = with_fixture(PENETRATION + "\nSELECT * FROM pen")

VIEW_SQL["view_i_top"] = with_fixture(PENETRATION + f"""
SELECT * FROM pen
WHERE file_year = {MAX_YEAR} AND renewable_share_change IS NOT NULL
ORDER BY renewable_share_change DESC, state ASC NULLS LAST, county ASC NULLS LAST
LIMIT 10
""")


def _ret(table: str, aggs: str) -> str:
    return f"""
  SELECT state, county, TRY_CAST(retirement_year AS INTEGER) AS year, {aggs}
  FROM {table}
  WHERE retirement_year IS NOT NULL
    AND regexp_matches(retirement_year, '^[0-9]{{4}}$')
    AND TRY_CAST(retirement_year AS INTEGER) BETWEEN {MAX_YEAR} - 3 AND {MAX_YEAR}
  GROUP BY 1, 2, 3"""


def _prop(table: str, name: str) -> str:
    return f"""
  SELECT state, county, sum({name}) AS {name}_recent FROM (
    SELECT state, county, CAST(current_year AS INTEGER) AS year,
           sum(nameplate_capacity_mw) AS {name}
    FROM {table}
    WHERE current_year IS NOT NULL AND current_year BETWEEN {MAX_YEAR} - 3 AND {MAX_YEAR}
    GROUP BY 1, 2, 3)
  GROUP BY 1, 2"""


_UP = "upper(coalesce(energy_source_1, ''))"
def _view_j(dedupe: bool) -> str:
    src = {t: (f"{t}_d" if dedupe else t) for t in ("generator_retired", "solar_retired", "wind_retired",
                                                   "energystorage_retired", "generator_proposed",
                                                   "energystorage_proposed")}
    newest = "".join(
        f"{t}_d AS (SELECT * FROM {t} QUALIFY row_number() OVER "
        f"(PARTITION BY plant_code, generator_id ORDER BY file_year DESC, file_date DESC) = 1),\n"
        for t in src) if dedupe else ""
    return with_fixture(newest + f"""
rg AS ({_ret(src['generator_retired'], f'''sum(nameplate_capacity_mw) AS g,
         sum(CASE WHEN {_UP} IN {RENEWABLE} THEN nameplate_capacity_mw ELSE 0 END) AS r,
         sum(CASE WHEN {_UP} IN {FOSSIL} THEN nameplate_capacity_mw ELSE 0 END) AS f''')}),
rs AS ({_ret(src['solar_retired'], 'sum(nameplate_capacity_mw) AS s')}),
rw AS ({_ret(src['wind_retired'], 'sum(nameplate_capacity_mw) AS w')}),
re AS ({_ret(src['energystorage_retired'], 'sum(nameplate_capacity_mw) AS e')}),
ret_long AS (
  SELECT state, county, coalesce(g, 0) AS g, coalesce(r, 0) AS r, coalesce(f, 0) AS f,
         0 AS s, 0 AS w, 0 AS e FROM rg
  UNION ALL SELECT state, county, 0, 0, 0, coalesce(s, 0), 0, 0 FROM rs
  UNION ALL SELECT state, county, 0, 0, 0, 0, coalesce(w, 0), 0 FROM rw
  UNION ALL SELECT state, county, 0, 0, 0, 0, 0, coalesce(e, 0) FROM re),
ret AS (SELECT state, county, sum(g) AS g, sum(r) AS r, sum(f) AS f, sum(s) AS s,
               sum(w) AS w, sum(e) AS e FROM ret_long GROUP BY 1, 2),
pg AS ({_prop(src['generator_proposed'], 'proposed_gen_mw')}),
ps AS ({_prop(src['energystorage_proposed'], 'proposed_storage_mw')}),
j AS (
  SELECT coalesce(ret.state, pg.state, ps.state) AS state,
         coalesce(ret.county, pg.county, ps.county) AS county,
         coalesce(ret.g, 0) AS g, coalesce(ret.f, 0) AS f, coalesce(ret.r, 0) AS r,
         coalesce(ret.s, 0) AS s, coalesce(ret.w, 0) AS w, coalesce(ret.e, 0) AS e,
         coalesce(pg.proposed_gen_mw_recent, 0) AS p,
         coalesce(ps.proposed_storage_mw_recent, 0) AS q
  FROM ret
  FULL OUTER JOIN pg ON ret.state = pg.state AND ret.county = pg.county
  FULL OUTER JOIN ps ON coalesce(ret.state, pg.state) = ps.state
                    AND coalesce(ret.county, pg.county) = ps.county)
SELECT state, county,
       CAST(g AS DOUBLE) AS retired_gen_mw_recent,
       CAST(f AS DOUBLE) AS retired_fossil_mw_recent,
       CAST(r AS DOUBLE) AS retired_renew_mw_recent,
       CAST(s AS DOUBLE) AS retired_solar_mw_recent,
       CAST(w AS DOUBLE) AS retired_wind_mw_recent,
       CAST(e AS DOUBLE) AS retired_storage_mw_recent,
       CAST(p AS DOUBLE) AS proposed_gen_mw_recent,
       CAST(q AS DOUBLE) AS proposed_storage_mw_recent,
       CAST(p + q AS DOUBLE) AS proposed_total_mw_recent,
       CAST(p + q - g AS DOUBLE) AS net_mw_change_recent,
       CAST(p + q AS DOUBLE) / NULLIF(CAST(g AS DOUBLE), 0) AS replacement_ratio_recent
FROM j
""")


VIEW_SQL["view_j"] = _view_j(False)
VIEW_SQL["view_j_dedupe"] = _view_j(True)





# ---------------------------------------------------------------------------
# Single-operator queries
# ---------------------------------------------------------------------------
OP_SQL: dict[str, str] = {}
_NEWEST = "ORDER BY file_year DESC, file_date DESC"

OP_SQL["latest_per_entity"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, utility_id,
       CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw
FROM generator_operable
QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id {_NEWEST}) = 1
""")

OP_SQL["latest_per_group_tiebreak"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, state, technology
FROM generator_operable
QUALIFY row_number() OVER (PARTITION BY plant_code {_NEWEST}, generator_id) = 1
""")

OP_SQL["latest_per_entity_year"] = with_fixture("""
SELECT plant_code, generator_id, file_year, CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw
FROM energystorage_operable
QUALIFY row_number() OVER (PARTITION BY plant_code, generator_id, file_year ORDER BY file_date DESC) = 1
""")

OP_SQL["change_from_previous"] = with_fixture("""
per_year AS (SELECT state, file_year, sum(nameplate_capacity_mw) AS cap
             FROM generator_operable GROUP BY state, file_year)
SELECT state, file_year, CAST(cap AS DOUBLE) AS capacity_mw,
       CAST(cap - lag(cap) OVER (PARTITION BY state ORDER BY file_year) AS DOUBLE) AS change_mw
FROM per_year
""")

OP_SQL["share_of_group"] = with_fixture(f"""
per_fuel AS (SELECT state, energy_source_1 AS fuel_type, sum(nameplate_capacity_mw) AS cap
             FROM generator_operable GROUP BY 1, 2)
SELECT state, fuel_type, CAST(cap AS DOUBLE) AS capacity_mw,
       {pct('cap', 'sum(cap) OVER (PARTITION BY state)')} AS pct_of_state_capacity
FROM per_fuel
""")

OP_SQL["change_along_state"] = with_fixture("""
SELECT state, plant_code, generator_id, file_year, CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw,
       CAST(nameplate_capacity_mw - lag(nameplate_capacity_mw) OVER (
         PARTITION BY state ORDER BY file_year, plant_code, generator_id) AS DOUBLE) AS change_mw
FROM generator_operable
""")

OP_SQL["share_of_state_year"] = with_fixture(f"""
SELECT state, plant_code, generator_id, file_year, CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw,
       {pct('nameplate_capacity_mw', 'sum(nameplate_capacity_mw) OVER (PARTITION BY state, file_year)')}
         AS pct_of_state_capacity
FROM generator_operable
""")

OP_SQL["project_alias"] = with_fixture("""
SELECT utility_id, plant_code AS plant, plant_name AS name, file_year,
       'Solar' AS fuel_type, CAST(0 AS DOUBLE) AS zero_mw
FROM solar_operable
""")

OP_SQL["in_list"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, energy_source_1
FROM generator_operable WHERE energy_source_1 IN {RENEWABLE}
""")

OP_SQL["any_of_membership"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, energy_source_1, energy_source_2
FROM generator_operable WHERE {ANY_BIOMASS}
""")

OP_SQL["not_null_compare"] = with_fixture("""
SELECT plant_code, generator_id, file_year, operating_year
FROM generator_operable
WHERE nameplate_capacity_mw IS NOT NULL AND operating_year >= 1980
  AND file_year > 1996 AND file_year <= 2000
""")

OP_SQL["regex_guarded_cast"] = with_fixture("""
SELECT plant_code, generator_id, file_year, retirement_year,
       coalesce(regexp_matches(retirement_year, '^[0-9]{4}$'), false) AS is_year,
       CASE WHEN regexp_matches(retirement_year, '^[0-9]{4}$')
            THEN TRY_CAST(retirement_year AS INTEGER) END AS retirement_year_int
FROM generator_retired
""")

OP_SQL["recency_band"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, current_year
FROM generator_proposed
WHERE current_year BETWEEN {MAX_YEAR} - 3 AND {MAX_YEAR}
""")

OP_SQL["derived_predicate"] = with_fixture("""
SELECT plant_code, generator_id, file_year, CAST(coalesce(nameplate_capacity_mw, 0) AS DOUBLE) AS mw_or_zero
FROM generator_operable WHERE coalesce(nameplate_capacity_mw, 0) >= 100000
""")

OP_SQL["coalesce_nullif_round"] = with_fixture("""
per_plant AS (SELECT plant_code, sum(nameplate_capacity_mw) AS mw, count(nameplate_capacity_mw) AS n
              FROM solar_operable GROUP BY plant_code)
SELECT plant_code, CAST(coalesce(mw, 0) AS DOUBLE) AS total_mw,
       CAST(round(mw, 0) AS DOUBLE) AS rounded_mw,
       CAST(mw AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS mw_per_unit
FROM per_plant
""")

OP_SQL["case_upper"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year,
       upper(coalesce(lower(energy_source_1), '')) AS fuel_code,
       CASE WHEN upper(coalesce(lower(energy_source_1), '')) IN {RENEWABLE} THEN 'renewable'
            WHEN upper(coalesce(lower(energy_source_1), '')) IN {FOSSIL} THEN 'fossil'
            ELSE 'other' END AS fuel_class
FROM generator_retired
""")

OP_SQL["arithmetic_casts"] = with_fixture("""
SELECT plant_code, generator_id, file_year,
       operating_year + 1 AS next_year,
       file_year - operating_year AS age,
       CAST(nameplate_capacity_mw * 2 AS DOUBLE) AS double_mw,
       CAST(nameplate_capacity_mw - CAST(0 AS DECIMAL(38,6)) AS DOUBLE) AS same_mw,
       CAST(CAST(nameplate_capacity_mw / 1000 AS DECIMAL(38,6)) AS DOUBLE) AS gw
FROM generator_operable
""")

OP_SQL["global_count"] = with_fixture("SELECT count(*) AS n_rows FROM generator_operable")

OP_SQL["count_distinct_null"] = with_fixture("""
SELECT state, count(DISTINCT technology) AS technologies FROM generator_operable GROUP BY state
""")

OP_SQL["count_filter"] = with_fixture("""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE nameplate_capacity_mw IS NULL) AS n_missing_mw
FROM generator_operable
""")

OP_SQL["grouped_sum"] = with_fixture("""
SELECT file_year, state, technology, CAST(sum(nameplate_capacity_mw) AS DOUBLE) AS capacity_mw
FROM generator_operable GROUP BY 1, 2, 3
""")

OP_SQL["conditional_sum"] = with_fixture(f"""
SELECT state,
  CAST(sum(CASE WHEN {_UP} IN {RENEWABLE} THEN nameplate_capacity_mw ELSE 0 END) AS DOUBLE) AS retired_renew_mw,
  CAST(sum(CASE WHEN {_UP} IN {FOSSIL} THEN nameplate_capacity_mw ELSE 0 END) AS DOUBLE) AS retired_fossil_mw
FROM generator_retired GROUP BY state
""")

OP_SQL["global_max"] = with_fixture("""
SELECT max(file_year) AS max_year,
       max(CASE WHEN state = 'none' THEN file_year END) AS max_year_empty
FROM generator_operable
""")

OP_SQL["median_by_year"] = with_fixture("""
SELECT file_year, quantile_cont(CAST(nameplate_capacity_mw AS DOUBLE), 0.5) AS median_mw
FROM solar_operable GROUP BY file_year
""")

OP_SQL["group_by_expression"] = with_fixture("""
SELECT TRY_CAST(retirement_year AS INTEGER) AS year, count(*) AS n,
       CAST(sum(nameplate_capacity_mw) AS DOUBLE) AS retired_mw
FROM generator_retired WHERE regexp_matches(retirement_year, '^[0-9]{4}$')
GROUP BY 1
""")

OP_SQL["two_stage_rollup"] = with_fixture("""
per_year AS (SELECT state, county, file_year, sum(nameplate_capacity_mw) AS mw
             FROM generator_operable GROUP BY 1, 2, 3)
SELECT state, county, CAST(sum(mw) AS DOUBLE) AS capacity_mw, count(*) AS releases
FROM per_year GROUP BY 1, 2
""")

OP_SQL["multi_property_percent"] = with_fixture(f"""
per_utility AS (SELECT utility_id, count(DISTINCT state) AS states FROM wind_operable GROUP BY 1),
s AS (SELECT count(*) AS total_utilities, count(*) FILTER (WHERE states > 1) AS multistate_utilities
      FROM per_utility)
SELECT total_utilities, multistate_utilities,
       {pct('multistate_utilities', 'total_utilities')} AS percent_multistate
FROM s
""")

OP_SQL["zero_filled_sum"] = with_fixture("""
SELECT plant_code, CAST(coalesce(sum(nameplate_capacity_mw), 0) AS DOUBLE) AS mw
FROM solar_operable GROUP BY plant_code
""")

OP_SQL["left_join_one_key"] = with_fixture("""
s AS (SELECT utility_id, utility_name, sum(nameplate_capacity_mw) AS solar_mw FROM solar_operable GROUP BY 1, 2),
w AS (SELECT utility_id, sum(nameplate_capacity_mw) AS wind_mw FROM wind_operable GROUP BY 1)
SELECT s.utility_id, s.utility_name, CAST(s.solar_mw AS DOUBLE) AS solar_mw, CAST(w.wind_mw AS DOUBLE) AS wind_mw
FROM s LEFT JOIN w ON s.utility_id = w.utility_id
""")

OP_SQL["left_join_chain"] = with_fixture("""
t AS (SELECT file_year, state, sum(nameplate_capacity_mw) AS total_mw FROM generator_operable GROUP BY 1, 2),
s AS (SELECT file_year, state, sum(nameplate_capacity_mw) AS solar_mw FROM solar_operable GROUP BY 1, 2),
w AS (SELECT file_year, state, sum(nameplate_capacity_mw) AS wind_mw FROM wind_operable GROUP BY 1, 2),
e AS (SELECT file_year, state, sum(nameplate_capacity_mw) AS storage_mw FROM energystorage_operable GROUP BY 1, 2)
SELECT t.file_year, t.state, CAST(t.total_mw AS DOUBLE) AS total_mw, CAST(s.solar_mw AS DOUBLE) AS solar_mw,
       CAST(w.wind_mw AS DOUBLE) AS wind_mw, CAST(e.storage_mw AS DOUBLE) AS storage_mw
FROM t
LEFT JOIN s ON s.file_year = t.file_year AND s.state = t.state
LEFT JOIN w ON w.file_year = t.file_year AND w.state = t.state
LEFT JOIN e ON e.file_year = t.file_year AND e.state = t.state
""")

_RET_PROP = """
r AS (SELECT state, county, sum(nameplate_capacity_mw) AS retired_mw FROM generator_retired GROUP BY 1, 2),
p AS (SELECT state, county, sum(nameplate_capacity_mw) AS proposed_mw FROM generator_proposed GROUP BY 1, 2),
q AS (SELECT state, county, sum(nameplate_capacity_mw) AS proposed_storage_mw
      FROM energystorage_proposed GROUP BY 1, 2)"""

OP_SQL["full_outer_two_key"] = with_fixture(_RET_PROP + """
SELECT coalesce(r.state, p.state) AS state, coalesce(r.county, p.county) AS county,
       CAST(r.retired_mw AS DOUBLE) AS retired_mw, CAST(p.proposed_mw AS DOUBLE) AS proposed_mw
FROM r FULL OUTER JOIN p ON r.state = p.state AND r.county = p.county
""")

OP_SQL["full_outer_coalesced_key"] = with_fixture(_RET_PROP + """
SELECT coalesce(r.state, p.state, q.state) AS state, coalesce(r.county, p.county, q.county) AS county,
       CAST(r.retired_mw AS DOUBLE) AS retired_mw, CAST(p.proposed_mw AS DOUBLE) AS proposed_mw,
       CAST(q.proposed_storage_mw AS DOUBLE) AS proposed_storage_mw
FROM r FULL OUTER JOIN p ON r.state = p.state AND r.county = p.county
FULL OUTER JOIN q ON coalesce(r.state, p.state) = q.state AND coalesce(r.county, p.county) = q.county
""")

OP_SQL["latest_year_filter"] = with_fixture(f"""
SELECT state, count(*) AS generators FROM generator_operable
WHERE file_year = {MAX_YEAR} GROUP BY state
""")

OP_SQL["cross_one_row"] = with_fixture("""
params AS (SELECT max(file_year) AS max_year FROM generator_operable)
SELECT g.file_year, p.max_year, count(*) AS generators
FROM generator_operable g JOIN params p ON TRUE
WHERE g.file_year >= p.max_year - 3
GROUP BY 1, 2
""")

OP_SQL["scalar_subquery"] = with_fixture(f"""
SELECT plant_code, generator_id, file_year, {MAX_YEAR} AS max_year,
       {MAX_YEAR} - file_year AS releases_behind
FROM generator_operable
""")

OP_SQL["union_two"] = with_fixture("""
SELECT utility_id, file_year, CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw FROM wind_operable
UNION ALL
SELECT utility_id, file_year, CAST(nameplate_capacity_mw AS DOUBLE) FROM solar_operable
""")

OP_SQL["union_tagged"] = with_fixture("""
SELECT state, 'Generator' AS kind, CAST(nameplate_capacity_mw AS DOUBLE) AS nameplate_capacity_mw
FROM generator_operable
UNION ALL SELECT state, 'Solar', CAST(nameplate_capacity_mw AS DOUBLE) FROM solar_operable
UNION ALL SELECT state, 'Wind', CAST(nameplate_capacity_mw AS DOUBLE) FROM wind_operable
""")


def _ret_year(table: str, m: str) -> str:
    return f"""
  SELECT state, county, TRY_CAST(retirement_year AS INTEGER) AS year,
         coalesce(sum(nameplate_capacity_mw), 0) AS {m}
  FROM {table}
  WHERE retirement_year IS NOT NULL AND regexp_matches(retirement_year, '^[0-9]{{4}}$')
    AND TRY_CAST(retirement_year AS INTEGER) BETWEEN {MAX_YEAR} - 3 AND {MAX_YEAR}
  GROUP BY 1, 2, 3"""


OP_SQL["union_zero_padded"] = with_fixture(f"""
a AS ({_ret_year('generator_retired', 'm')}),
b AS ({_ret_year('solar_retired', 'm')}),
c AS ({_ret_year('wind_retired', 'm')}),
d AS ({_ret_year('energystorage_retired', 'm')})
SELECT state, county, year, CAST(m AS DOUBLE) AS gen_mw, 0.0::DOUBLE AS solar_mw,
       0.0::DOUBLE AS wind_mw, 0.0::DOUBLE AS storage_mw FROM a
UNION ALL SELECT state, county, year, 0, CAST(m AS DOUBLE), 0, 0 FROM b
UNION ALL SELECT state, county, year, 0, 0, CAST(m AS DOUBLE), 0 FROM c
UNION ALL SELECT state, county, year, 0, 0, 0, CAST(m AS DOUBLE) FROM d
""")

OP_SQL["order_nulls"] = with_fixture(f"""
per_plant AS (SELECT state, county, plant_code, sum(nameplate_capacity_mw) AS cap
              FROM generator_operable WHERE file_year = {MAX_YEAR} GROUP BY 1, 2, 3)
SELECT state, county, plant_code, CAST(cap AS DOUBLE) AS capacity_mw,
       row_number() OVER (PARTITION BY state, county
                          ORDER BY cap DESC NULLS FIRST, plant_code ASC NULLS LAST) AS position
FROM per_plant
""")


# ---------------------------------------------------------------------------
# Ingest and profiling operators over the release extracts
# ---------------------------------------------------------------------------
RELEASES = """
ord AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS file_year,
         CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus,
         CASE WHEN year(o_orderdate) <= 1996
              THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS o_totalprice,
         o_orderpriority
  FROM orders),
ord_early AS (SELECT *, 'order ' || o_orderkey AS o_comment FROM ord WHERE file_year <= 1999),
ord_late AS (SELECT * EXCLUDE (o_orderpriority) FROM ord WHERE file_year >= 2000),
li AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS file_year,
         CAST(l_orderkey AS VARCHAR) AS l_orderkey,
         CAST(l_linenumber AS VARCHAR) AS l_linenumber,
         CASE WHEN year(l_shipdate) >= 1999 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS l_quantity,
         l_returnflag, l_linestatus
  FROM lineitem),
late AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS file_year,
         CAST(l_orderkey AS VARCHAR) AS l_orderkey,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate
  FROM lineitem WHERE year(l_shipdate) >= 2000)"""

_GROUPS = (
    ("sales.orders", "ord_early",
     ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_comment")),
    ("sales.orders", "ord_late", ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")),
    ("sales.lineitem", "li", ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")),
    ("sales.late_lines", "late", ("l_orderkey", "l_shipdate")),
)

LONG = RELEASES + ",\nlong AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT '{table}' AS table_name, file_year, {i} AS position, '{col}' AS column_name, "
    f"{col} AS value FROM {cte}"
    for table, cte, cols in _GROUPS for i, col in enumerate(cols)) + ")"

PROFILE = LONG + """,
pv AS (SELECT table_name, file_year, column_name, position, value, count(*) AS n
       FROM long GROUP BY ALL),
stats AS (
  SELECT table_name, file_year, column_name, min(position) AS position,
         CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS distinct_count,
         max(length(value)) AS text_len,
         count(*) FILTER (WHERE value IS NOT NULL
                          AND NOT regexp_matches(value, '^\\s*[+-]?[0-9]+\\s*$')) AS not_int,
         count(*) FILTER (WHERE value IS NOT NULL AND NOT regexp_matches(value, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')) AS not_num
  FROM pv GROUP BY 1, 2, 3),
prof AS (
  SELECT table_name, file_year, column_name, position, n_rows, distinct_count,
         distinct_count = n_rows AS is_unique,
         CASE WHEN not_int > 0 AND not_num > 0 THEN CAST(text_len AS BIGINT) END AS max_len,
         CASE WHEN text_len IS NULL THEN NULL
              WHEN distinct_count = 2 THEN 'Boolean'
              WHEN not_int = 0 THEN 'Int64'
              WHEN not_num = 0 THEN 'Float64'
              ELSE 'String' END AS col_type
  FROM stats),
cons AS (
  SELECT table_name, column_name,
         CASE WHEN count(DISTINCT col_type) = 1 THEN min(col_type) ELSE 'String' END AS col_type,
         min({'y': file_year, 'p': position}) AS first_seen,
         bool_and(is_unique) AS is_unique
  FROM prof GROUP BY 1, 2),
present AS (SELECT table_name, list_sort(list_distinct(list(file_year))) AS years
            FROM long GROUP BY 1)"""


def with_releases(body: str, base: str = PROFILE) -> str:
    return "WITH " + base.strip() + "\n" + body.strip()


INGEST_SQL: dict[str, str] = {}
INGEST_SQL["profile_table"] = with_releases("SELECT * FROM prof")
INGEST_SQL["profile_distinct"] = with_releases(
    "SELECT table_name, file_year, column_name, distinct_count FROM prof")
INGEST_SQL["profile_max_len"] = with_releases(
    "SELECT table_name, file_year, column_name, max_len FROM prof")
INGEST_SQL["profile_unique"] = with_releases(
    "SELECT table_name, file_year, column_name, n_rows, is_unique FROM prof")
INGEST_SQL["classify_type"] = with_releases(
    "SELECT table_name, file_year, column_name, distinct_count, col_type FROM prof")
INGEST_SQL["consolidate_types"] = with_releases("""
SELECT table_name, column_name, col_type, first_seen.y AS first_year,
       first_seen.p AS first_position, is_unique FROM cons""")
INGEST_SQL["years_present"] = with_releases(
    "SELECT table_name, array_to_string(years, ',') AS years FROM present")
INGEST_SQL["missing_years"] = with_releases("""
SELECT table_name,
       array_to_string(list_filter(range(1995, 2002), lambda y: NOT list_contains(years, y)), ',')
         AS missing_years
FROM present
WHERE len(list_filter(range(1995, 2002), lambda y: NOT list_contains(years, y))) > 0""")
INGEST_SQL["render_schema"] = with_releases("""
SELECT table_name, CAST(count(*) AS INTEGER) AS n_columns,
       'CREATE TABLE ' || table_name || '(' || chr(10) || chr(9)
       || string_agg(column_name || ' ' || CASE col_type WHEN 'Int64' THEN 'BIGINT'
                                                        WHEN 'Float64' THEN 'NUMERIC(18, 6)'
                                                        WHEN 'Boolean' THEN 'BOOLEAN'
                                                        ELSE 'VARCHAR' END
                     || CASE WHEN key_place = 1 AND is_key THEN ' PRIMARY KEY' ELSE '' END,
                     ',' || chr(10) || chr(9) ORDER BY first_seen.y, first_seen.p)
       || ',' || chr(10) || chr(9) || 'file_year INT NOT NULL'
       || ',' || chr(10) || chr(9) || 'file_date TIMESTAMP NOT NULL'
       || ',' || chr(10) || chr(9) || 'upload_timestamp TIMESTAMP DEFAULT CURRENT_TIMESTAMP NOT NULL'
       || chr(10) || ');' AS ddl
FROM (SELECT *, row_number() OVER (PARTITION BY table_name, is_key ORDER BY first_seen.y, first_seen.p) AS key_place
      FROM (SELECT *, is_unique AND col_type = 'Int64' AS is_key FROM cons)) GROUP BY table_name""")

CONFORMED = RELEASES + """,
conformed AS (
  SELECT TRY_CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(o_custkey AS BIGINT) AS o_custkey,
         o_orderstatus, TRY_CAST(o_totalprice AS DECIMAL(18,6)) AS o_totalprice,
         o_orderpriority, CAST(NULL AS VARCHAR) AS o_clerk, file_year
  FROM ord_early
  UNION ALL
  SELECT TRY_CAST(o_orderkey AS BIGINT), TRY_CAST(o_custkey AS BIGINT), o_orderstatus,
         TRY_CAST(o_totalprice AS DECIMAL(18,6)), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         file_year
  FROM ord_late)"""

INGEST_SQL["fill_missing_align"] = with_releases("""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
       o_orderpriority, o_clerk, file_year FROM conformed""", CONFORMED)
INGEST_SQL["declared_cast"] = with_releases("""
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, file_year
FROM conformed""", CONFORMED)
INGEST_SQL["declared_cast_rejects"] = with_releases("""
SELECT 'o_orderkey' AS "column", count(*) FILTER (WHERE o_orderkey IS NOT NULL
                                  AND TRY_CAST(o_orderkey AS BIGINT) IS NULL) AS rejected FROM ord
UNION ALL
SELECT 'o_custkey', count(*) FILTER (WHERE o_custkey IS NOT NULL
                                     AND TRY_CAST(o_custkey AS BIGINT) IS NULL) FROM ord
UNION ALL
SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NOT NULL
                                        AND TRY_CAST(o_totalprice AS DECIMAL(18,6)) IS NULL) FROM ord
""", RELEASES)
INGEST_SQL["year_range"] = with_releases(
    "SELECT o_orderkey, file_year FROM conformed WHERE file_year BETWEEN 1996 AND 1999", CONFORMED)
INGEST_SQL["replace_year"] = with_releases("""
SELECT o_orderkey, file_year, CAST(o_totalprice AS DOUBLE) AS o_totalprice
FROM conformed WHERE file_year <= 1997
UNION ALL
SELECT o_orderkey, file_year, CAST(o_totalprice * 2 AS DOUBLE) FROM conformed WHERE file_year >= 1998
""", CONFORMED)

_STD = ("regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace({x}, "
        "'\\p{{Nd}}+__|Y\\p{{Nd}}+\\.xlsx', '', 'g'), '^(\\p{{Nd}}+_\\p{{Nd}}+_+|_+)', '')), '[[:punct:]]', '', 'g'), "
        "'[\\s\\p{{Z}}\\x1c-\\x1f\\x85]+', '_', 'g')")
_HEADER = "CAST(p_size AS VARCHAR) || '__' || p_type || ' ' || p_name || ' (' || p_brand || ')'"
_FILE = ("'3_' || CAST(p_size % 9 AS VARCHAR) || '_' || p_type || '_Y' "
         "|| CAST(1995 + p_partkey % 7 AS VARCHAR) || '.xlsx'")
_UNICODE = "chr(1635) || '__' || p_type || chr(160) || p_brand || chr(8195) || 'ID'"
INGEST_SQL["name_standardize"] = f"""
SELECT p_partkey,
       {_STD.format(x=_UNICODE)} AS unicode_name,
       {_STD.format(x=_HEADER)} AS header_name,
       substr({_STD.format(x="concat_ws(' ', " + _HEADER + ", p_name, p_name, p_name, p_name, p_name)")}, 1, 63)
         AS column_name,
       {_STD.format(x=_FILE)} AS topic
FROM part
"""
_BOOK = ("CASE p_partkey % 5 WHEN 0 THEN '~$3_1_' || p_type || '_Y2001.xlsx' WHEN 1 THEN 'LayoutY2001.xlsx' "
         "WHEN 2 THEN '3_1_' || p_type || '_Y2001.xlsx' WHEN 3 THEN '2___' || p_brand || '_Y1999.xlsx' "
         "ELSE p_name || '.txt' END")
INGEST_SQL["file_filter"] = f"""
SELECT p_partkey, {_BOOK} AS file_name FROM part
WHERE ({_BOOK}) LIKE '%.xlsx' AND ({_BOOK}) NOT LIKE '~%' AND ({_BOOK}) NOT LIKE '%LayoutY%'
  AND ({_BOOK}) NOT LIKE '%EIA-860 Form%'
"""
INGEST_SQL["table_routing"] = f"""
SELECT p_partkey, {_STD.format(x="(" + _BOOK + ")")} || '.' || {_STD.format(x="p_container")} AS table_name
FROM (SELECT *, p_brand || ' & ' || p_name AS p_container FROM part)
"""
INGEST_SQL["lineage_columns"] = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS file_year,
       true AS has_file_date, true AS has_upload_timestamp
FROM orders
"""
INGEST_SQL["yes_no_boolean"] = """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE o_orderstatus END AS raw_flag,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_fulfilled
FROM orders
"""
INGEST_SQL["rename_columns"] = """
SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_totalprice AS total_price_,
       o_orderstatus AS status
FROM orders
"""


def all_sql() -> dict[str, str]:
    out = dict(VIEW_SQL)
    out.update(OP_SQL)
    out.update(INGEST_SQL)
    return out
