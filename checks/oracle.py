"""The same queries in SQL, for DuckDB on the same tables."""

from __future__ import annotations

from checks.queries import (
    LINKS,
    N_HORIZONS,
    PAD_DAYS,
    PART_TYPES,
    PLANT_YEAR,
    REVENUE_LINKS,
    TECHNOLOGIES,
    TEMPLATE_DAYS,
)
from checks.views import (
    FEED_LINK,
    FEED_REGION,
    FIRST_DAY,
    FUELS,
    STATION_TECHNOLOGY,
    STATIONS,
    TECHNOLOGY,
)
from gridtally.operators.hourly import FLOW_FEED_LINKS
from gridtally.operators.network import LINK_RECODE, REGIONS
from gridtally.operators.plants import PLANT_COLUMNS, PLANT_KEYS


def case(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {column} {whens} END"


def cells(names, template: str) -> str:
    """One select item per name; ``{n}`` in the template is the name."""
    return ", ".join(template.format(n=n) for n in names)


REGION_OF = case("CAST(n_regionkey AS VARCHAR)", {str(i): r for i, r in enumerate(REGIONS)})
SIDE = "CASE WHEN l_linestatus = 'O' THEN 'Model' ELSE 'Actual' END"

FEED = f"""feed AS (
  SELECT ts, date_trunc('hour', ts) AS date_time, round(value * 100) AS value,
    {case('event_type', STATIONS)} AS station, {case('event_type', FEED_REGION)} AS REGION,
    {case('event_type', FEED_LINK)} AS link
  FROM events)"""

GENERATION_FEED = f"""{FEED},
stations AS (SELECT date_time, station, avg(value) AS output FROM feed GROUP BY ALL),
totals AS (
  SELECT date_time, coalesce({case('station', STATION_TECHNOLOGY)}, 'UNKNOWN') AS Tech,
    round(sum(output), 3) AS output
  FROM stations GROUP BY ALL),
technologies AS (
  SELECT date_time,
    {cells(TECHNOLOGIES, 'coalesce(max(CASE WHEN Tech = ' "'{n}'" ' THEN output END), 0) AS {n}')}
  FROM totals GROUP BY date_time)"""

# padded year per region of the hours in the feed, and its rolling horizons
ZONAL = f"""{FEED},
demand AS (SELECT date_time, REGION, avg(value) AS Demand FROM feed GROUP BY ALL),
means AS (SELECT date_time, REGION, station, avg(value) AS output FROM feed GROUP BY ALL),
totals AS (
  SELECT date_time, REGION, {case('station', STATION_TECHNOLOGY)} AS Tech,
    round(sum(output), 3) AS output
  FROM means GROUP BY ALL),
technologies AS (
  SELECT date_time, REGION,
    coalesce(max(CASE WHEN Tech = 'Wind' THEN output END), 0) AS Wind,
    coalesce(max(CASE WHEN Tech = 'Solar' THEN output END), 0) AS Solar,
    coalesce(max(CASE WHEN Tech = 'Hydro' THEN output END), 0) AS Hydro
  FROM totals GROUP BY ALL),
hours AS (
  SELECT REGION, year(date_time) AS year,
    datediff('hour', TIMESTAMP '2024-01-01', date_time) + 1 AS h, Demand, Wind, Solar, Hydro,
    Demand - Wind - Solar - Hydro AS Residual_demand,
    CAST(NULL AS DOUBLE) AS OPERATING_RESERVE_UP,
    CAST(NULL AS DOUBLE) AS OPERATING_RESERVE_DOWN
  FROM demand JOIN technologies USING (date_time, REGION)),
entry AS (
  SELECT * EXCLUDE (h), h AS t FROM hours WHERE h <= 24
  UNION ALL SELECT * EXCLUDE (h), h + 24 AS t FROM hours
  UNION ALL SELECT * EXCLUDE (h), h + 48 AS t FROM hours WHERE h > 8784 - 24)"""

PRICE_FEED = f"""{FEED},
hours AS (
  SELECT date_time, {cells(REGIONS, "avg(CASE WHEN REGION = '{n}' THEN value END) AS {n}")}
  FROM feed GROUP BY date_time)"""

YEARS = "years AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders)"

DAYS = f"""days AS (
  SELECT year(l_shipdate) AS year, dayofyear(l_shipdate) AS t, sum(l_quantity) AS quantity,
    CAST(count(*) AS DOUBLE) AS n_items,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned
  FROM lineitem GROUP BY ALL),
sized AS (
  SELECT *, datediff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1)) AS n FROM days),
padded AS (
  SELECT year, t, quantity, n_items, returned FROM sized WHERE t <= {PAD_DAYS}
  UNION ALL SELECT year, t + {PAD_DAYS}, quantity, n_items, returned FROM sized
  UNION ALL SELECT year, t + {TEMPLATE_DAYS} - n, quantity, n_items, returned
  FROM sized WHERE t > n - ({TEMPLATE_DAYS} - n - {PAD_DAYS}))"""

# model time: day number -> hour of 2020 without 28 February, after 744 warm-up hours
MODEL_HOUR = f"datediff('day', DATE '{FIRST_DAY}', CAST({{d}} AS DATE)) - 744 + 1"
MODEL_STAMP = (
    "TIMESTAMP '2020-01-01' + to_hours(CAST(h - 1 + CASE WHEN h >= 1393 THEN 24 ELSE 0 END "
    "AS INTEGER))"
)

NODES = f"""supply AS (
  SELECT s_suppkey, n_regionkey + 1 AS from_node, {REGION_OF} AS REGION
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
delivery AS (
  SELECT orders.*, n_regionkey + 1 AS to_node, {REGION_OF} AS REGION
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)"""

PRICE = f"""price AS (
  SELECT {SIDE} AS side, l_shipdate AS date_time, REGION,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100)
      AS spot_price
  FROM lineitem JOIN supply ON l_suppkey = s_suppkey GROUP BY ALL)"""

PRICE_WIDE = f"""price_wide AS (
  SELECT side, date_time,
    {cells(REGIONS, "max(CASE WHEN REGION = '{n}' THEN spot_price END) AS {n}")}
  FROM price GROUP BY ALL)"""

# a region pair with a virtual node between: two halves, and the link each stands for
FLOWS = f"""pairs AS (
  SELECT {SIDE} AS side, l_shipdate AS date_time, s.REGION AS a, d.REGION AS b,
    sum(l_quantity) AS flow
  FROM lineitem JOIN supply s ON l_suppkey = s_suppkey JOIN delivery d ON l_orderkey = o_orderkey
  GROUP BY ALL),
vias AS (
  SELECT *, CASE WHEN (a, b) IN (('NSW', 'QLD'), ('QLD', 'NSW')) THEN 'QNI'
    WHEN (a, b) IN (('SA', 'VIC'), ('VIC', 'SA')) THEN 'ML'
    WHEN (a, b) IN (('TAS', 'VIC'), ('VIC', 'TAS')) THEN
      CASE WHEN day(date_time) % 2 = 0 THEN 'M2' ELSE 'M1' END END AS v
  FROM pairs),
halves AS (
  SELECT side, date_time, flow, a AS from_virtual, b AS to_virtual FROM vias WHERE v IS NULL
  UNION ALL SELECT side, date_time, flow, a, v FROM vias WHERE v IS NOT NULL
  UNION ALL SELECT side, date_time, flow, v, b FROM vias WHERE v IS NOT NULL),
named AS (
  SELECT *, from_virtual || '_' || to_virtual AS link FROM halves),
recoded AS (
  SELECT *, coalesce({case('link', LINK_RECODE)}, link) AS from_to FROM named),
flows AS (
  SELECT *, split_part(from_to, '_', 1) AS "from", split_part(from_to, '_', 2) AS "to"
  FROM recoded),
arriving AS (SELECT * FROM flows WHERE to_virtual NOT IN ('QNI', 'ML', 'M1', 'M2'))"""

PRICED = """priced AS (
  SELECT f.*, p.spot_price AS price_from, q.spot_price AS price_to
  FROM flows f
  LEFT JOIN price p ON f.side = p.side AND f.date_time = p.date_time AND f."from" = p.REGION
  LEFT JOIN price q ON f.side = q.side AND f.date_time = q.date_time AND f."to" = q.REGION)"""

IN_OUT = """inflow AS (
  SELECT side, date_time, "to" AS REGION, sum(flow) AS i FROM arriving GROUP BY ALL),
outflow AS (
  SELECT side, date_time, "from" AS REGION, sum(flow) AS o FROM arriving GROUP BY ALL),
strict_balance AS (
  SELECT side, date_time, REGION, i AS "In", o AS "Out", i - o AS Net
  FROM inflow FULL JOIN outflow USING (side, date_time, REGION)),
balance AS (
  SELECT side, date_time, REGION, coalesce("In", 0) AS "In", coalesce("Out", 0) AS "Out",
    coalesce("In", 0) - coalesce("Out", 0) AS Net
  FROM strict_balance)"""

GEN_COLUMNS = ["Demand", *FUELS, "UNKNOWN", "Imports"]
GENERATION = f"""exogenous AS (
  SELECT CASE WHEN o_orderstatus = 'O' THEN 'Model' ELSE 'Actual' END AS side,
    o_orderdate AS date_time, REGION, CAST(count(*) AS DOUBLE) AS demand,
    CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE) AS wind
  FROM delivery GROUP BY ALL),
dispatch AS (
  SELECT {SIDE} AS side, l_shipdate AS date_time, REGION,
    coalesce({case('p_type', TECHNOLOGY)}, 'UNKNOWN') AS fuel, sum(l_quantity) AS output
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supply ON l_suppkey = s_suppkey
  GROUP BY ALL),
entries AS (
  SELECT side, date_time, REGION, fuel, output FROM dispatch
  UNION ALL SELECT side, date_time, REGION, 'Demand', demand FROM exogenous
  UNION ALL SELECT side, date_time, REGION, 'Wind', wind FROM exogenous
  UNION ALL SELECT side, date_time, REGION, 'Imports', Net FROM balance),
sums AS (
  SELECT side, date_time, REGION,
    {cells(GEN_COLUMNS, "coalesce(sum(CASE WHEN fuel = '{n}' THEN output END), 0) AS {n}")}
  FROM entries GROUP BY ALL),
generation AS (
  SELECT side, date_time, REGION,
    {cells(GEN_COLUMNS, 'round(CASE WHEN abs({n}) < 0.0001 THEN 0 ELSE {n} END, 3) AS {n}')}
  FROM sums)"""

WEIGHTS = f"""weights AS (
  SELECT side, date_time, REGION, {' + '.join(GEN_COLUMNS[1:])} AS weight FROM generation),
weighted AS (
  SELECT side, date_time,
    {cells(REGIONS, "max(CASE WHEN REGION = '{n}' THEN spot_price END) AS {n}")},
    {cells(REGIONS, "max(CASE WHEN REGION = '{n}' THEN weight END) AS {n}_W")}
  FROM price FULL JOIN weights USING (side, date_time, REGION) GROUP BY side, date_time)"""

DAY = "strftime(date_time, '%m/%d/%y')"
MONTH = "strftime(date_time, '%m')"

PRICES_ONLY = f"WITH {NODES}, {PRICE}, {PRICE_WIDE}"
FLOWS_ONLY = f"WITH {NODES}, {FLOWS}"
BALANCES = f"{FLOWS_ONLY}, {IN_OUT}"
GENERATIONS = f"{BALANCES}, {GENERATION}"
WEIGHTED = f"{GENERATIONS}, {PRICE}, {WEIGHTS}"


def link_flows(label: str, digits: int) -> str:
    """Link totals, one column per link, with the given extra group column."""
    extra = f", {label}" if label else ""
    names = ", " + label.split(" AS ")[1] if label else ""
    return f"""{FLOWS_ONLY}, totals AS (
      SELECT side{extra}, from_to, round(sum(flow) / 1000, {digits}) AS flow
      FROM arriving GROUP BY ALL)
    SELECT side{names}, {cells(LINKS, "max(CASE WHEN from_to = '{n}' THEN flow END) AS {n}")}
    FROM totals GROUP BY ALL"""


def balance_totals(label: str, prefix: str) -> str:
    sums = ", ".join(
        f'round(sum("{c}") / 1000, 3) AS {prefix}_{c.lower()}' for c in ("In", "Out", "Net")
    )
    return f"{BALANCES} SELECT side{label}, REGION, {sums} FROM balance GROUP BY ALL"


def generation_totals(label: str) -> str:
    sums = cells(GEN_COLUMNS, "round(sum({n}) / 1000, 3) AS {n}")
    return f"{GENERATIONS} SELECT side{label}, REGION, {sums} FROM generation GROUP BY ALL"


def mean_price(label: str, template: str) -> str:
    means = cells(REGIONS, template)
    return f"{PRICES_ONLY} SELECT side{label}, {means} FROM price_wide GROUP BY ALL"


def load_weighted(label: str, template: str) -> str:
    return f"{WEIGHTED} SELECT side{label}, {cells(REGIONS, template)} FROM weighted GROUP BY ALL"


def strict(expression: str, *needed: str) -> str:
    full = " AND ".join(f"count({n}) = count(*)" for n in needed)
    return f"CASE WHEN {full} THEN {expression} END AS {{n}}"


KNOWN_RATIO = (
    "round(sum({n} * {n}_W) / nullif(sum(CASE WHEN {n} IS NOT NULL THEN {n}_W END), 0), 6) AS {n}"
)
STRICT_RATIO = "round(sum({n} * {n}_W) / nullif(sum({n}_W), 0), %d)"

SPEC_COLUMNS = [c for c in PLANT_COLUMNS if c not in (*PLANT_KEYS, "CAPACITY", "VARCOST")]
PLANTS = f"""WITH yearly AS (
  SELECT l_suppkey, sum(l_quantity) AS CAPACITY, min(l_extendedprice) AS VARCOST
  FROM lineitem WHERE year(l_shipdate) = {PLANT_YEAR} GROUP BY l_suppkey)
SELECT s_name AS STATION, 'D' || s_suppkey AS DUID, {REGION_OF} AS REGION,
  n_regionkey + 1 AS REGION_KEY, CAPACITY, VARCOST,
  {', '.join(f's_suppkey + {i} AS "{c}"' for i, c in enumerate(SPEC_COLUMNS))}
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN yearly ON s_suppkey = l_suppkey
WHERE 1990 + floor(s_acctbal / 1000) <= {PLANT_YEAR}
  AND 2005 - floor(s_acctbal / 800) >= {PLANT_YEAR}"""

UNITS = f"""units AS (
  SELECT p_name AS STATION, 'P' || p_partkey AS unit,
    [{', '.join(f"'{r}'" for r in REGIONS)}][p_size % 5 + 1] AS REGION,
    p_size % 5 + 1 AS REGION_KEY, CAST(p_size AS DOUBLE) AS CAPACITY,
    {case('p_type', TECHNOLOGY)} AS FUEL_TYPE_TEXT,
    CAST(p_size * 2 AS DOUBLE) AS INITIAL_ENERGY_STOCK_IN_DAMS,
    CAST(p_size * 3 AS DOUBLE) AS HYDRO_DAM_CAPACITY, p_retailprice AS VARCOST
  FROM part)"""

SERIES = {
    "Demand": "count(*)",
    "Wind": "count(*) FILTER (WHERE o_orderpriority = '1-URGENT')",
    "Solar": "count(*) FILTER (WHERE o_orderpriority = '2-HIGH')",
    "Hydro": "count(*) FILTER (WHERE o_orderpriority = '5-LOW')",
}

SUMMARY_PARTS = [
    f"""SELECT side, 'AvPrice' AS "table", '' AS REGION, '{r}' AS item, avg({r}) AS value
        FROM price_wide GROUP BY side""" for r in REGIONS
] + [
    f"""SELECT side, 'LW_AvPrice', '', '{r}', sum({r} * {r}_W) /
          nullif(sum(CASE WHEN {r} IS NOT NULL THEN {r}_W END), 0)
        FROM weighted GROUP BY side""" for r in REGIONS
] + [
    f"""SELECT side, 'AnnualFIO', REGION, 'annual_{c.lower()}', round(sum("{c}") / 1000, 3)
        FROM balance GROUP BY ALL""" for c in ("In", "Out", "Net")
] + [
    f"""SELECT side, 'AnnualGen', REGION, '{c}', round(sum({c}) / 1000, 3)
        FROM generation GROUP BY ALL""" for c in GEN_COLUMNS
] + [
    # every link gets a row per side, null where there is no flow
    f"""SELECT side, 'AnnualFlows', '', '{n}',
          round(sum(CASE WHEN from_to = '{n}' THEN flow END) / 1000, 1)
        FROM arriving GROUP BY side""" for n in LINKS
] + [
    """SELECT side, 'Revenue', '', link, coalesce(sum((price_to - price_from) * flow), 0)
       FROM priced WHERE to_virtual NOT IN ('QNI', 'ML', 'M1', 'M2') GROUP BY ALL"""
]

ORACLE_SQL: dict[str, str] = {
    "hourly_demand": f"""WITH {FEED}
        SELECT date_time, REGION, avg(value) AS hourly_demand FROM feed GROUP BY ALL""",
    "hourly_generation": f"WITH {GENERATION_FEED} SELECT * FROM technologies",
    "hourly_generation_wide_feed": f"""WITH {FEED},
        readings AS (SELECT date_time, count(*) AS n FROM feed GROUP BY ALL),
        means AS (
          SELECT date_time, station, sum(value) / n AS output
          FROM feed JOIN readings USING (date_time) GROUP BY date_time, station, n)
        SELECT date_time, coalesce({case('station', STATION_TECHNOLOGY)}, 'UNKNOWN') AS Tech,
          round(sum(output), 3) AS output
        FROM means GROUP BY ALL""",
    "hourly_price": f"WITH {PRICE_FEED} SELECT * FROM hours",
    "hourly_flow": f"""WITH {FEED}, hours AS (
          SELECT date_time, link, avg(value) AS flow FROM feed GROUP BY ALL),
        named AS (SELECT date_time, regexp_replace(link, '1$', '') AS from_to, flow FROM hours)
        SELECT *, split_part(from_to, '_', 1) AS "from", split_part(from_to, '_', 2) AS "to"
        FROM named""",
    "daily_price_from_feed": f"""WITH {PRICE_FEED}
        SELECT {DAY} AS day, {cells(REGIONS, 'round(avg({n}), 8) AS {n}')}
        FROM hours GROUP BY ALL""",
    "residual_demand": f"""WITH {GENERATION_FEED},
        demand AS (SELECT date_time, avg(value) AS Demand FROM feed GROUP BY ALL)
        SELECT date_time, Demand, Wind, Solar, CAST(0 AS DOUBLE) AS Hydro,
          Demand - Wind - Solar - CAST(0 AS DOUBLE) AS Residual
        FROM demand FULL JOIN technologies USING (date_time)""",
    "zonal_inputs": f"WITH {ZONAL} SELECT * FROM entry",
    "demand_horizons": f"""WITH {ZONAL}, spans AS (
          SELECT k, 70 * (k - 1) AS start FROM range(1, 128) r(k))
        SELECT REGION, year, k AS horizon, t - start AS period, Residual_demand AS value
        FROM entry JOIN spans ON t BETWEEN start + 1 AND start + 100""",
    "missing_hours": f"""WITH {FEED},
        spine AS (
          SELECT station, unnest(generate_series((SELECT min(date_time) FROM feed),
            (SELECT max(date_time) FROM feed), INTERVAL 1 HOUR)) AS date_time
          FROM (SELECT DISTINCT station FROM feed))
        SELECT station, date_time FROM spine
        WHERE (station, date_time) NOT IN (SELECT (station, date_time) FROM feed)""",
    "missing_readings": f"""WITH {FEED},
        slots AS (SELECT DISTINCT REGION, time_bucket(INTERVAL 5 MINUTE, ts - INTERVAL 5 MINUTE) AS date_time FROM feed),
        spine AS (
          SELECT REGION, unnest(generate_series((SELECT min(date_time) FROM slots),
            (SELECT max(date_time) FROM slots), INTERVAL 5 MINUTE)) AS date_time
          FROM (SELECT DISTINCT REGION FROM feed))
        SELECT * FROM spine ANTI JOIN slots USING (REGION, date_time)""",
    "feed_coverage": f"""WITH {FEED},
        days AS (SELECT link, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS day
          FROM (SELECT DISTINCT link FROM feed)),
        counts AS (
          SELECT link, date_trunc('day', ts) AS day, count(*) AS readings,
            count(DISTINCT time_bucket(INTERVAL 5 MINUTE, ts)) AS present
          FROM feed GROUP BY ALL)
        SELECT link, strftime(day, '%Y-%m-%d') AS day, CAST(288 AS INTEGER) AS expected, coalesce(readings, 0) AS readings,
          CAST(288 - coalesce(present, 0) AS INTEGER) AS missing, coalesce(readings, 0) - coalesce(present, 0) AS repeated
        FROM days LEFT JOIN counts USING (link, day)""",
    "time_map": f"""WITH {YEARS},
        hours AS (SELECT year, unnest(range(8760)) AS h FROM years)
        SELECT year, 'r' || (11 + (h + 44) // 70) AS horizon, (h + 44) % 70 + 1 AS period,
          make_timestamp(year, 1, 1, 0, 0, 0) + to_hours(CAST(h AS INTEGER)) AS date_time
        FROM hours""",
    "hour_spine": f"""WITH {YEARS}
        SELECT year, unnest(generate_series(make_timestamp(year, 1, 1, 0, 0, 0),
          make_timestamp(year, 12, 31, 23, 0, 0), INTERVAL 1 HOUR)) AS date_time
        FROM years""",
    "readings_by_horizon": """WITH hours AS (
          SELECT datediff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS h
          FROM events)
        SELECT 'r' || (11 + (h + 44) // 70) AS horizon, (h + 44) % 70 + 1 AS period,
          count(*) AS readings
        FROM hours GROUP BY ALL""",
    "padded_year": f"WITH {DAYS} SELECT * FROM padded",
    "rolling_horizons": f"""WITH {DAYS}, spans AS (
          SELECT k, 70 * (k - 1) AS start FROM range(1, 7) r(k))
        SELECT year, k AS horizon, t - start AS period, quantity AS DEMAND,
          n_items AS OPERATING_RESERVE_UP, returned AS OPERATING_RESERVE_DOWN
        FROM padded JOIN spans ON t BETWEEN start + 1 AND start + 100""",
    "horizon_columns": f"""WITH {DAYS}, spans AS (
          SELECT k, 70 * (k - 1) AS start FROM range(1, {N_HORIZONS + 1}) r(k)),
        placed AS (
          SELECT year, k, t - start AS period, quantity
          FROM padded JOIN spans ON t BETWEEN start + 1 AND start + 100)
        SELECT 'ALL' AS REGION, year, period,
          {cells(range(1, N_HORIZONS + 1), 'max(CASE WHEN k = {n} THEN quantity END) AS "{n}"')}
        FROM placed GROUP BY year, period""",
    "plant_table": PLANTS,
    "unit_metadata": f"WITH {UNITS} SELECT * FROM units",
    "region_key": f"WITH {UNITS} SELECT DISTINCT REGION, REGION_KEY FROM units",
    "model_dispatch": f"""WITH sums AS (
          SELECT l_shipdate, p_type, sum(l_quantity) AS output
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
        grid AS (
          SELECT {MODEL_HOUR.format(d='l_shipdate')} AS h, l_shipdate,
            unnest([{', '.join(f"'{t}'" for t in PART_TYPES)}]) AS unit
          FROM (SELECT DISTINCT l_shipdate FROM sums)),
        metadata AS (
          SELECT p_type AS unit, CAST(sum(p_size) AS DOUBLE) AS CAPACITY,
            {case('p_type', TECHNOLOGY)} AS FUEL_TYPE_TEXT
          FROM part WHERE p_type <> 'STANDARD' GROUP BY p_type)
        SELECT {MODEL_STAMP} AS date_time, unit, output, CAPACITY, FUEL_TYPE_TEXT
        FROM grid LEFT JOIN sums ON grid.l_shipdate = sums.l_shipdate AND unit = p_type
        LEFT JOIN metadata USING (unit)
        WHERE h >= 1""",
    "model_price": f"""WITH {NODES}, {PRICE}, days AS (
          SELECT DISTINCT date_time, unnest([{', '.join(f"'{r}'" for r in REGIONS)}]) AS REGION,
            {MODEL_HOUR.format(d='date_time')} AS h
          FROM price WHERE side = 'Model'),
        known AS (SELECT date_time, REGION, spot_price FROM price WHERE side = 'Model')
        SELECT {MODEL_STAMP} AS date_time, REGION, spot_price
        FROM days LEFT JOIN known USING (date_time, REGION) WHERE h >= 1""",
    "model_flow": f"""WITH {NODES}, sums AS (
          SELECT l_shipdate, s.REGION || '_' || d.REGION AS link, sum(l_quantity) AS flow
          FROM lineitem JOIN supply s ON l_suppkey = s_suppkey
          JOIN delivery d ON l_orderkey = o_orderkey
          WHERE l_linestatus = 'O' GROUP BY ALL),
        grid AS (
          SELECT l_shipdate, {MODEL_HOUR.format(d='l_shipdate')} AS h,
            unnest([{', '.join(f"'{n}'" for n in LINKS)}]) AS link
          FROM (SELECT DISTINCT l_shipdate FROM sums))
        SELECT {MODEL_STAMP} AS date_time, link, coalesce(flow, 0) AS flow
        FROM grid LEFT JOIN sums USING (l_shipdate, link) WHERE h >= 1""",
    "exogenous_series": f"""WITH {NODES}, series AS (
          {' UNION ALL '.join(
              f"SELECT o_orderdate, REGION, '{k}' AS FUEL_TYPE_TEXT, CAST({v} AS DOUBLE) AS output "
              "FROM delivery GROUP BY o_orderdate, REGION" for k, v in SERIES.items())}),
        hours AS (
          SELECT *, datediff('day', DATE '{FIRST_DAY}', CAST(o_orderdate AS DATE)) + 1 - 720 AS h
          FROM series)
        SELECT TIMESTAMP '2020-01-01' + INTERVAL (h - 1) HOUR AS date_time, REGION, FUEL_TYPE_TEXT, output
        FROM hours WHERE h BETWEEN 1 AND 8784
          AND CAST(TIMESTAMP '2020-01-01' + INTERVAL (h - 1) HOUR AS DATE) <> DATE '2020-02-28'""",
    "storage_net_output": f"""WITH {UNITS},
        charged AS (
          SELECT l_shipdate, l_partkey, sum(l_quantity) AS charge
          FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
        discharged AS (
          SELECT l_shipdate, l_partkey, sum(l_quantity) AS discharge
          FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
        SELECT l_shipdate AS date_time, unit, round(charge, 3) AS charge,
          round(discharge, 3) AS discharge, round(discharge, 3) - round(charge, 3) AS output,
          REGION, CAPACITY
        FROM charged LEFT JOIN discharged USING (l_shipdate, l_partkey)
        LEFT JOIN units ON unit = 'P' || l_partkey
        WHERE charge > 0.0001 OR discharge > 0.0001""",
    "price_hourly_wide": f"{PRICES_ONLY} SELECT * FROM price_wide",
    "mean_price_period": mean_price("", "round(avg({n}), 6) AS {n}"),
    "mean_price_daily": mean_price(
        f", {DAY} AS day", strict("round(avg({n}), 6)", "{n}")
    ),
    "mean_price_monthly": mean_price(f", {MONTH} AS month", "round(avg({n}), 6) AS {n}"),
    "mean_price_monthly_strict": mean_price(
        f", year(date_time) AS year, {MONTH} AS month", strict("round(avg({n}), 6)", "{n}")
    ),
    "network_flows": f"{FLOWS_ONLY} SELECT * FROM flows",
    "priced_flows": f"{FLOWS_ONLY}, {PRICE}, {PRICED} SELECT * FROM priced",
    "link_flows_annual": link_flows("", 1),
    "link_flows_daily": link_flows(f"{DAY} AS day", 3),
    "link_flows_monthly": link_flows(f"{MONTH} AS month", 3),
    "link_flows_by_year": link_flows("year(date_time) AS year", 1),
    "region_balance_hourly": f"{BALANCES} SELECT * FROM balance",
    "region_balance_strict": f"{BALANCES} SELECT * FROM strict_balance",
    "region_balance_daily": balance_totals(f", {DAY} AS day", "daily"),
    "region_balance_monthly": balance_totals(f", {MONTH} AS month", "month"),
    "region_balance_annual": balance_totals("", "annual"),
    "link_revenue": f"""{FLOWS_ONLY}, {PRICE}, {PRICED}, revenue AS (
          SELECT side, link, coalesce(sum((price_to - price_from) * flow), 0) AS r
          FROM priced WHERE to_virtual NOT IN ('QNI', 'ML', 'M1', 'M2') GROUP BY ALL)
        SELECT side,
          {cells(REVENUE_LINKS, "round(max(CASE WHEN link = '{n}' THEN r END), 0) AS {n}")}
        FROM revenue GROUP BY side""",
    "output_by_fuel": f"""{GENERATIONS}
        SELECT side, date_time, REGION, nullif(fuel, 'UNKNOWN') AS FUEL_TYPE_TEXT, output
        FROM dispatch""",
    "generation_hourly": f"{GENERATIONS} SELECT * FROM generation",
    "generation_daily": generation_totals(f", {DAY} AS day"),
    "generation_monthly": generation_totals(f", {MONTH} AS month"),
    "generation_annual": generation_totals(""),
    "dispatch_weights": f"""{WEIGHTED}
        SELECT side, date_time,
          {cells(REGIONS, "max(CASE WHEN REGION = '{n}' THEN weight END) AS {n}_W")}
        FROM weights GROUP BY ALL""",
    "load_weighted_price_period": load_weighted("", KNOWN_RATIO),
    "load_weighted_price_daily": load_weighted(
        f", {DAY} AS day", strict(STRICT_RATIO % 6, "{n}", "{n}_W")
    ),
    "load_weighted_price_monthly": load_weighted(f", {MONTH} AS month", KNOWN_RATIO),
    "load_weighted_price_monthly_strict": load_weighted(
        f", year(date_time) AS year, {MONTH} AS month", strict(STRICT_RATIO % 6, "{n}", "{n}_W")
    ),
    "results_summary": f"""{WEIGHTED}, {PRICE_WIDE}, {PRICED}, summary AS (
          {' UNION ALL '.join(SUMMARY_PARTS)})
        SELECT side, "table", REGION, item, round(value, 0) AS value FROM summary""",
}


def half_hours(label: str, names, hour: str) -> str:
    """Means per half hour, one column per label, then per hour where no half of the hour lacks one."""
    return f"""halves AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS half,
    {cells(names, f'avg(CASE WHEN {label} = ' "'{n}'" ' THEN value END) AS {n}')}
  FROM feed GROUP BY ALL),
hours AS (
  SELECT date_trunc('hour', half) AS date_time,
    {cells(names, 'CASE WHEN count({n}) = count(*) THEN avg({n}) END AS {n}')}
  FROM halves GROUP BY ALL),
long AS ({' UNION ALL '.join(f"SELECT date_time, '{n}' AS label, {n} AS value FROM hours" for n in names)})
{hour}"""


# the same tables after a way through files
ORACLE_SQL |= {
    "feed_files_demand": ORACLE_SQL["hourly_demand"],
    "feed_files_generation": f"""WITH {FEED},
        means AS (SELECT date_time, REGION, station, avg(value) AS output FROM feed GROUP BY ALL)
        SELECT date_time, REGION, coalesce({case('station', STATION_TECHNOLOGY)}, 'UNKNOWN') AS Tech,
          round(sum(output), 3) AS output
        FROM means GROUP BY ALL""",
    "feed_files_price": f"WITH {FEED}, " + half_hours(
        "REGION", REGIONS, "SELECT date_time, label AS REGION, value AS spot_price FROM long"),
    "feed_files_flow": f"WITH {FEED}, " + half_hours(
        "link", FLOW_FEED_LINKS,
        """SELECT date_time, value AS flow, regexp_replace(label, '1$', '') AS from_to,
          split_part(label, '_', 1) AS "from", regexp_replace(split_part(label, '_', 2), '1$', '') AS "to" FROM long"""),
    "reserve_files": f"""WITH {NODES}, {ZONAL},
        reserves AS (
          SELECT REGION, dayofyear(l_shipdate) AS t, sum(l_quantity) AS OPERATING_RESERVE_UP,
            CAST(count(*) AS DOUBLE) AS OPERATING_RESERVE_DOWN
          FROM lineitem JOIN supply ON l_suppkey = s_suppkey GROUP BY ALL)
        SELECT * FROM (SELECT * EXCLUDE (OPERATING_RESERVE_UP, OPERATING_RESERVE_DOWN) FROM entry)
        LEFT JOIN reserves USING (REGION, t)""",
    "plant_files": ORACLE_SQL["plant_table"],
    "unit_files": ORACLE_SQL["unit_metadata"],
    "dispatch_files": ORACLE_SQL["model_dispatch"],
    "price_files": ORACLE_SQL["model_price"],
    "flow_files": ORACLE_SQL["model_flow"],
    "flow_files_of_runs": f"""WITH {NODES}, sums AS (
          SELECT l_returnflag AS run, l_shipdate, s.REGION || '_' || d.REGION AS link, sum(l_quantity) AS flow
          FROM lineitem JOIN supply s ON l_suppkey = s_suppkey
          JOIN delivery d ON l_orderkey = o_orderkey GROUP BY ALL),
        grid AS (
          SELECT run, l_shipdate, {MODEL_HOUR.format(d='l_shipdate')} AS h,
            unnest([{', '.join(f"'{n}'" for n in LINKS)}]) AS link
          FROM (SELECT DISTINCT run, l_shipdate FROM sums))
        SELECT run, {MODEL_STAMP} AS date_time, link, coalesce(flow, 0) AS flow
        FROM grid LEFT JOIN sums USING (run, l_shipdate, link) WHERE h >= 1""",
    "zonal_files": ORACLE_SQL["exogenous_series"],
    "result_files": f"""SELECT * FROM ({ORACLE_SQL['link_flows_daily']})
        FULL JOIN ({ORACLE_SQL['mean_price_daily']}) USING (side, day)""",
    "result_counts": " UNION ALL ".join(
        f'SELECT \'{table}\' AS "table", count(*) AS rows, min(date_time) AS first, max(date_time) AS last '
        f"FROM ({ORACLE_SQL[query]})" for table, query in {
            "Price.DATA": "price_hourly_wide", "IC_Flows.DATA": "priced_flows",
            "IC_Flows.FlowInOut": "region_balance_hourly"}.items()),
    "links_found": ORACLE_SQL["link_flows_daily"],
}
