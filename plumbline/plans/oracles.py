"""DuckDB SQL with the results the registered queries must have, written independently of them."""

from __future__ import annotations

TABLES = (
    "benchmark",
    "conversations",
    "customer",
    "documents",
    "embeddings",
    "events",
    "labels",
    "lineitem",
    "nation",
    "orders",
    "pages",
    "part",
    "region",
    "supplier",
)


def half_up(x: str, n: int) -> str:
    """Round the decimal value, ties away from zero."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def half_even(x: str, n: int) -> str:
    y = f"(({x}) * 1e{n})"
    return f"(CASE WHEN abs({y} - trunc({y})) = 0.5 THEN 2 * round({y} / 2) ELSE round({y}) END / 1e{n})"


def six(x: str) -> str:
    return f"(CAST(floor(({x}) * 1e6 + 0.5) AS DOUBLE) / 1e6)"


def added(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def averaged(x: str) -> str:
    return f"({added(x)} / COUNT({x}))"


def normal_equations(source: str, y: str, xs: list[str], digits: int) -> str:
    """CTEs and a final SELECT that fit ``y`` on ``xs`` over ``source`` by eliminating the covariances."""
    n = len(xs)
    cells = [(i, j) for i in range(n) for j in range(n + 1)]
    columns = [*xs, y]
    steps = [f"g0 AS (SELECT {', '.join(f'covar_pop({columns[i]}, {columns[j]}) AS a{i}{j}' for i, j in cells)} FROM {source})"]
    for k in range(n):
        new = [f"a{i}{j} / a{k}{k} AS a{i}{j}" if i == k else f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k} AS a{i}{j}" for i, j in cells]
        steps.append(f"g{k + 1} AS (SELECT {', '.join(new)} FROM g{k})")
    fitted = " + ".join(f"a{i}{n} * {x}" for i, x in enumerate(xs))
    means = " + ".join(f"a{i}{n} * m{i}" for i in range(n))
    shown = ", ".join(f"{half_up(f'a{i}{n}', digits)} AS coef_{x}" for i, x in enumerate(xs))
    totals = f"t AS (SELECT {', '.join(f'avg({x}) AS m{i}' for i, x in enumerate(xs))}, avg({y}) AS ym, var_pop({y}) AS yv, count(*) AS n FROM {source})"
    return f"""{", ".join(steps)}, {totals}, e AS (SELECT var_pop({y} - ({fitted})) AS rest FROM {source} CROSS JOIN g{n})
SELECT {half_up(f"ym - ({means})", digits)} AS intercept, {shown}, {half_up("1 - rest / yv", digits)} AS r_squared, {n} AS rank, n FROM g{n} CROSS JOIN t CROSS JOIN e"""


TRIPS = f"""
raw AS (
  SELECT ts AS tpep_pickup_datetime,
         ts + to_seconds(CAST((event_id * 7) % 20000 AS INTEGER)) AS tpep_dropoff_datetime,
         value AS fare_amount,
         CAST(0.05 AS DOUBLE) + CAST(event_id % 400 AS DOUBLE) / CAST(10 AS DOUBLE) AS trip_distance,
         event_type AS payment_type, user_id % 25 AS pulocationid, event_id % 25 AS dolocationid
  FROM events
), kept AS (
  SELECT *, (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / CAST(6e7 AS DOUBLE) AS minutes,
         {half_even("fare_amount / greatest(trip_distance, CAST(0.1 AS DOUBLE))", 2)} AS cost_per_mile,
         CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour_of_day
  FROM raw
  WHERE fare_amount >= 1 AND fare_amount <= 500 AND trip_distance >= 0.1 AND trip_distance <= 100
), trips AS (
  SELECT * EXCLUDE (minutes), least(greatest(minutes, CAST(0.5 AS DOUBLE)), CAST(300 AS DOUBLE)) AS trip_duration_mins,
         dayname(tpep_pickup_datetime) AS day_of_week
  FROM kept
)"""

def _sales(where: str = "") -> str:
    return f"""
lines AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_quantity, l_extendedprice / l_quantity, l_discount, l_partkey) = 1
), sales AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id, o_orderdate AS date, r_name AS region,
         p_brand AS product, c_mktsegment AS channel, l_quantity AS quantity,
         l_extendedprice / l_quantity AS unit_price, l_discount AS discount_pct,
         o_custkey AS customer_id, l_extendedprice * (1 - l_discount) AS revenue,
         strftime(o_orderdate, '%Y-%m') AS year_month
  FROM lines, orders, customer, nation, region, part
  WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
    AND n_regionkey = r_regionkey AND l_partkey = p_partkey {where}
)"""


SALES = _sales()

ENTITIES = {"&quot;": '"', "&#x27;": "''", "&#39;": "''", "&lt;": "<", "&gt;": ">", "&copy;": "©", "&middot;": "·"}


def unescaped(x: str) -> str:
    """The entities that occur in the pages, ampersands last."""
    for entity, sign in ENTITIES.items():
        x = f"replace({x}, '{entity}', '{sign}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


# Pages without noscript, whose only script and style are in the head.
COLLAPSED = r"regexp_replace(array_to_string(piece, ' '), '\s{2,}', ' ', 'g')"
PAGE_TEXT = rf"""
bodies AS (
  SELECT url, html,
         regexp_replace(regexp_replace(html, '<!--.*?-->', '<x>', 'gs'), '<head>.*?</head>', '<x>', 'gs') AS body
  FROM pages
), pieces AS (
  SELECT url, html, list_filter(
           list_transform(string_split_regex(body, '<[^>]*>'), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')),
           lambda p: p <> '') AS piece
  FROM bodies
), texts AS (
  SELECT url, html,
         {unescaped(COLLAPSED)} AS text
  FROM pieces
)"""
WORDS = r"CAST(len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) AS INTEGER)"

def _catalog(where: str = "") -> str:
    return f"""
shop AS (
  SELECT *, 'http://catalog.example.com/part/' || p_partkey AS url,
         p_name || ' Field Value Size ' || p_size || ' Brand ' || p_brand || ' © odd 1'
           || CASE WHEN p_partkey % 5 <> 0 THEN ' more' ELSE '' END AS text,
         '{{"sku": ' || p_partkey || ', "name": "' || p_name || '"}}' AS item
  FROM part {where}
)"""


CATALOG = _catalog()
GOOD = _catalog("WHERE p_size % 10 <> 0")
RECORDS = f"""
SELECT url, text, CAST(3 AS INTEGER) AS image_count, CAST(1 AS INTEGER) AS table_count,
       CAST([1, 2, 0][1 + p_partkey % 3] AS INTEGER) AS json_ld_count, p_name || ' & more' AS title,
       {WORDS} AS word_count
FROM shop"""

CELLS = """
side AS (SELECT CAST(ceil(sqrt(max(p_partkey) + 1)) AS BIGINT) AS k FROM part),
cells AS (
  SELECT CAST(p_partkey // k AS INTEGER) AS r, CAST(p_partkey % k AS INTEGER) AS c,
         CAST(p_size % 3 + 1 AS DOUBLE) AS cost
  FROM part, side WHERE p_size % 5 <> 0
), edges AS (
  SELECT a.r AS src_row, a.c AS src_col, b.r AS dst_row, b.c AS dst_col, b.cost AS weight
  FROM cells a JOIN (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) AS step(dr, dc) ON true
  JOIN cells b ON b.r = a.r + dr AND b.c = a.c + dc
)"""
# Lowest cost first, then fewest hops: hops are less than 1e6, so one number holds both.
SETTLED = f"""
{CELLS}, walk(r, c, score) USING KEY (r, c) AS (
  SELECT r, c, CAST(0 AS DOUBLE) FROM (SELECT r, c FROM cells ORDER BY r, c LIMIT 1)
  UNION
  SELECT n.dst_row, n.dst_col, min(w.score + n.weight * 1e6 + 1)
  FROM walk w JOIN edges n ON n.src_row = w.r AND n.src_col = w.c
  LEFT JOIN recurring.walk k ON k.r = n.dst_row AND k.c = n.dst_col
  WHERE k.score IS NULL OR w.score + n.weight * 1e6 + 1 < k.score
  GROUP BY n.dst_row, n.dst_col
), settled AS (
  SELECT r AS row, c AS col, floor(score / 1e6) AS cost, CAST(score - 1e6 * floor(score / 1e6) AS INTEGER) AS hops
  FROM walk
)"""


SITE_RECORDS = rf"""WITH {PAGE_TEXT}
SELECT url, text, CAST(0 AS INTEGER) AS image_count, CAST(0 AS INTEGER) AS table_count, CAST(0 AS INTEGER) AS json_ld_count,
       {unescaped("trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'))")} AS title, {WORDS} AS word_count
FROM texts"""


def _ranked(key: str, columns: str, limit: str = "") -> str:
    return f"WITH {SALES} SELECT {key}, {columns} FROM sales GROUP BY {key} ORDER BY total_revenue DESC, {key} {limit}"


def _anomalous_fares(limit: str, times: int = 3) -> str:
    return f"""WITH {TRIPS}, spread AS (SELECT avg(fare_amount) AS m, stddev_pop(fare_amount) AS sd FROM trips)
SELECT tpep_pickup_datetime, trip_distance, fare_amount, trip_duration_mins, payment_type,
       {half_up("(fare_amount - m) / sd", 2)} AS z_score
FROM trips, spread WHERE fare_amount > m + {times} * sd
ORDER BY fare_amount DESC, tpep_pickup_datetime, trip_distance, trip_duration_mins, payment_type {limit}"""


def _anomalous_sales(times: int = 2, limit: str = "") -> str:
    return f"""WITH {SALES}, spread AS (SELECT avg(revenue) AS m, stddev_pop(revenue) AS sd FROM sales)
SELECT sales.* FROM sales, spread WHERE revenue > m + {times} * sd
ORDER BY revenue DESC, order_id {limit}"""


def _arrays(center: str, scale: str) -> str:
    return f"""WITH v AS (SELECT vec_id, list_transform(CAST(embedding AS FLOAT[]), lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
m AS (SELECT *, {center} AS center FROM v), d AS (SELECT *, {scale} AS scale FROM m),
flat AS (SELECT vec_id, unnest(e) AS x, CAST(unnest(range(len(e))) AS INTEGER) AS position, center, scale FROM d)
SELECT vec_id, position, {six("CASE WHEN scale = 0 THEN 0 ELSE (x - center) / scale END")} AS normalized FROM flat"""


def _route_to(goal: str) -> str:
    """One cheapest path from the first open cell to ``goal``, an (r, c) of the grid."""
    return f"""WITH RECURSIVE {SETTLED}, parents AS (
  SELECT dst_row, dst_col, min((src_row, src_col)) AS up FROM edges
  JOIN settled a ON a.row = src_row AND a.col = src_col JOIN settled b ON b.row = dst_row AND b.col = dst_col
  WHERE a.cost + weight = b.cost AND a.hops + 1 = b.hops GROUP BY 1, 2
), back(row, col) AS (
  SELECT row, col FROM settled WHERE (row, col) = ({goal})
  UNION ALL SELECT up[1], up[2] FROM back JOIN parents ON dst_row = row AND dst_col = col
)
SELECT hops AS step, row, col, cost FROM settled JOIN back USING (row, col)"""


def oracle_sql() -> dict[str, str]:
    fare, distance, minutes = "fare_amount", "trip_distance", "trip_duration_mins"
    trip_count = "COUNT(*) AS trip_count"
    avg_fare = f"{half_up(averaged(fare), 2)} AS avg_fare"
    fare_total = f"{half_up(added(fare), 2)} AS total_revenue"
    avg_distance = f"{half_up(averaged(distance), 2)} AS avg_distance"
    revenue_total = f"{added('revenue')} AS total_revenue"
    order_count = "COUNT(*) AS order_count"
    avg_order = f"{averaged('revenue')} AS avg_order_value"
    net = "revenue * (1 - discount_pct)"
    value_scale = "SELECT event_id, {} AS normalized FROM events, (SELECT min(value) AS lo, max(value) AS hi, avg(value) AS m, stddev_pop(value) AS sd FROM events)"
    pivot = ", ".join(
        f"coalesce({added(f'''CASE WHEN region = '{r}' THEN revenue END''')}, 0) AS \"{r}\""
        for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
    )
    catalog = f"WITH {CATALOG}"
    return {
        "clean_trips": f"""WITH {TRIPS} SELECT * FROM trips""",
        "hourly_revenue": f"WITH {TRIPS} SELECT hour_of_day, {avg_fare}, {trip_count}, {fare_total} FROM trips GROUP BY hour_of_day",
        "avg_fare_by_hour": f"WITH {TRIPS} SELECT hour_of_day, {avg_fare}, {trip_count}, {avg_distance} FROM trips GROUP BY hour_of_day",
        "top_pickup_hours": f"""WITH {TRIPS} SELECT hour_of_day, {trip_count}, {fare_total}, {avg_fare} FROM trips
GROUP BY hour_of_day ORDER BY trip_count DESC, hour_of_day LIMIT 10""",
        "avg_duration_by_dow": f"""WITH {TRIPS} SELECT day_of_week, {half_up(averaged(minutes), 2)} AS avg_duration_mins, {avg_fare}, {trip_count}
FROM trips GROUP BY day_of_week""",
        "payment_breakdown": f"""WITH {TRIPS} SELECT payment_type, {trip_count}, {fare_total}, {avg_fare},
{half_up("COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM trips)", 1)} AS pct_trips FROM trips GROUP BY payment_type""",
        "detect_anomalies": _anomalous_fares("LIMIT 25"),
        "all_fare_anomalies": _anomalous_fares("", 1),
        "fare_anomalies": _anomalous_fares("LIMIT 20"),
        "top_routes": f"""WITH {TRIPS} SELECT pulocationid AS "PULocationID", dolocationid AS "DOLocationID", {trip_count}, {avg_fare}, {avg_distance}
FROM trips GROUP BY 1, 2 ORDER BY trip_count DESC, 1, 2 LIMIT 10""",
        "monthly_growth": f"""WITH m AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS year_month, COUNT(*) AS trip_count, {half_up(added("o_totalprice"), 2)} AS total_revenue
  FROM orders GROUP BY 1)
SELECT cur.year_month, cur.trip_count, cur.total_revenue, prev.trip_count AS prev_count,
  {half_up("(cur.trip_count - prev.trip_count) * CAST(100 AS DOUBLE) / nullif(prev.trip_count, 0)", 2)} AS growth_pct
FROM m cur LEFT JOIN m prev ON prev.year_month = (SELECT max(year_month) FROM m o WHERE o.year_month < cur.year_month)""",
        "filtered_trips": f"""WITH {TRIPS} SELECT tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, trip_distance, payment_type,
pulocationid, dolocationid, minutes AS trip_duration_mins, hour_of_day, cost_per_mile FROM kept""",
        "filtered_hourly_summary": f"WITH {TRIPS} SELECT hour_of_day, COUNT(fare_amount) AS trip_count, {averaged(fare)} AS avg_fare FROM kept GROUP BY hour_of_day",
        "filtered_payment_summary": f"""WITH {TRIPS} SELECT payment_type, {added(fare)} AS sum, COUNT(fare_amount) AS "count" FROM kept GROUP BY payment_type""",
        "clean_sales": f"""WITH {_sales("AND r_name <> 'ASIA'")} SELECT * FROM sales""",
        "total_revenue": f"WITH {SALES} SELECT {revenue_total}, {order_count}, {avg_order} FROM sales",
        "top_n_customers": _ranked("customer_id", f"{revenue_total}, {order_count}, {avg_order}", "LIMIT 10"),
        "monthly_growth_rate": f"""WITH {SALES}, m AS (SELECT year_month, {added("revenue")} AS v FROM sales GROUP BY 1)
SELECT cur.year_month, {half_up("cur.v", 2)} AS revenue, {half_up("prev.v", 2)} AS prev_revenue,
  {half_up("(cur.v - prev.v) * CAST(100 AS DOUBLE) / nullif(prev.v, 0)", 2)} AS growth_pct
FROM m cur LEFT JOIN m prev ON prev.year_month = (SELECT max(year_month) FROM m o WHERE o.year_month < cur.year_month)""",
        "cohort_retention": f"""WITH {SALES}, f AS (SELECT customer_id, min(year_month) AS cohort_month FROM sales GROUP BY 1)
SELECT cohort_month, COUNT(DISTINCT sales.customer_id) AS active_customers, COUNT(DISTINCT f.customer_id) AS cohort_size,
  {half_up("COUNT(DISTINCT sales.customer_id) * CAST(100 AS DOUBLE) / COUNT(DISTINCT f.customer_id)", 1)} AS retention_pct
FROM f LEFT JOIN sales ON sales.customer_id = f.customer_id GROUP BY cohort_month""",
        "cohort_retention_by_offset": f"""WITH {SALES}, f AS (SELECT customer_id, min(year_month) AS cohort_month FROM sales GROUP BY 1),
n AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM f GROUP BY 1),
a AS (SELECT cohort_month, CAST(datediff('month', CAST(cohort_month || '-01' AS DATE), CAST(year_month || '-01' AS DATE)) AS INTEGER) AS month_offset,
  COUNT(DISTINCT customer_id) AS active_customers FROM sales JOIN f USING (customer_id) GROUP BY 1, 2)
SELECT cohort_month, month_offset, active_customers, cohort_size,
  {half_up("active_customers * CAST(100 AS DOUBLE) / cohort_size", 1)} AS retention_pct FROM a JOIN n USING (cohort_month)""",
        "revenue_anomalies": _anomalous_sales(),
        "revenue_anomalies_one_deviation": _anomalous_sales(1),
        "revenue_anomalies_top": _anomalous_sales(1, "LIMIT 20"),
        "revenue_by_product_region": f"""WITH {SALES}, p AS (SELECT product, {pivot} FROM sales GROUP BY product)
SELECT *, 0 + "AFRICA" + "AMERICA" + "ASIA" + "EUROPE" + "MIDDLE EAST" AS grand_total FROM p""",
        "revenue_by_region": _ranked("region", f"{order_count}, {revenue_total}, {avg_order}, {added('quantity')} AS total_units"),
        "top_products": _ranked("product", f"{order_count}, {revenue_total}, {averaged('discount_pct')} AS avg_discount", "LIMIT 10"),
        "monthly_trend": f"WITH {SALES} SELECT year_month, {added('revenue')} AS monthly_revenue, {order_count} FROM sales GROUP BY year_month",
        "revenue_by_channel": _ranked("channel", f"{revenue_total}, {order_count}"),
        "summary_stats": f"""WITH {SALES} SELECT COUNT(*) AS total_orders, {revenue_total}, {avg_order}, max(revenue) AS max_order_value,
min(revenue) AS min_order_value, COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT product) AS unique_products FROM sales""",
        "region_summary": f"WITH {SALES} SELECT region, {added(net)} AS net_revenue, COUNT({net}) AS order_count FROM sales GROUP BY region",
        "product_summary": f"WITH {SALES} SELECT product, {added(net)} AS net_revenue FROM sales GROUP BY product",
        "total_net_revenue": f"WITH {SALES} SELECT {added(net)} AS total_net_revenue FROM sales",
        "ols_multi": f"""WITH {TRIPS}, s AS (SELECT var_pop(trip_distance) AS aa, var_pop(trip_duration_mins) AS bb, covar_pop(trip_distance, trip_duration_mins) AS ab,
  covar_pop(trip_distance, fare_amount) AS ay, covar_pop(trip_duration_mins, fare_amount) AS by_, var_pop(fare_amount) AS yy,
  avg(trip_distance) AS a, avg(trip_duration_mins) AS b, avg(fare_amount) AS y, COUNT(*) AS n FROM trips),
c AS (SELECT *, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM s)
SELECT {half_up("y - ca * a - cb * b", 6)} AS intercept, {half_up("ca", 6)} AS coef_trip_distance, {half_up("cb", 6)} AS coef_trip_duration_mins,
  {half_up("(ca * ay + cb * by_) / yy", 6)} AS r_squared, n FROM c""",
        "ols_simple": f"""WITH {SALES} SELECT {half_up("regr_intercept(revenue, quantity)", 4)} AS intercept, {half_up("regr_slope(revenue, quantity)", 4)} AS coef_quantity,
  {half_up("regr_r2(revenue, quantity)", 4)} AS r_squared, COUNT(*) AS n FROM sales""",
        "ols_many": f"WITH {TRIPS}, {normal_equations('trips', 'fare_amount', ['trip_distance', 'trip_duration_mins', 'hour_of_day', 'cost_per_mile'], 5)}",
        "ols_collinear": f"""WITH {TRIPS}, s AS (SELECT regr_slope(fare_amount, trip_distance) AS b, regr_intercept(fare_amount, trip_distance) AS a,
  regr_r2(fare_amount, trip_distance) AS r, COUNT(*) AS n FROM trips)
SELECT {half_up("a", 5)} AS intercept, {half_up("b / 5", 5)} AS coef_trip_distance, {half_up("2 * b / 5", 5)} AS coef_trip_km, {half_up("r", 5)} AS r_squared, 1 AS rank, n FROM s""",
        "ols_sampled": f"""WITH {TRIPS}, chosen AS (
  SELECT * FROM trips ORDER BY md5('42:' || epoch_us(tpep_pickup_datetime)), fare_amount, trip_distance, trip_duration_mins LIMIT 2000),
{normal_equations("chosen", "fare_amount", ["trip_distance", "trip_duration_mins"], 5)}""",
        "minmax_normalize": value_scale.format(six("CASE WHEN hi = lo THEN 0 ELSE (value - lo) / (hi - lo) END")),
        "zscore_normalize": value_scale.format(six("CASE WHEN sd = 0 THEN 0 ELSE (value - m) / sd END")),
        "minmax_normalize_array": _arrays("list_min(e)", "list_max(e) - list_min(e)"),
        "zscore_normalize_array": _arrays("list_sum(e) / len(e)", "sqrt(list_sum(list_transform(e, lambda x: (x - center) * (x - center))) / len(e))"),
        "describe_numeric": f"""WITH {TRIPS} SELECT COUNT(*) AS input_size, {half_up("min(trip_duration_mins)", 6)} AS min, {half_up("max(trip_duration_mins)", 6)} AS max,
  {half_up("avg(trip_duration_mins)", 6)} AS mean, {half_up("stddev_pop(trip_duration_mins)", 6)} AS std FROM trips""",
        "page_text": f"WITH {PAGE_TEXT} SELECT url, text FROM texts",
        "page_metadata": rf"""WITH {PAGE_TEXT} SELECT url,
  {unescaped("trim(regexp_extract(html, '<title>(.*?)</title>', 1, 's'))")} AS title, '' AS description,
  {unescaped("trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'))")} AS h1s, {WORDS} AS word_count FROM texts""",
        "page_stats": f"WITH {PAGE_TEXT} SELECT url, {WORDS} AS word_count, CAST(0 AS INTEGER) AS image_count FROM texts",
        "drop_failed_pages": f"WITH {GOOD} SELECT url, CAST(NULL AS VARCHAR) AS error FROM shop",
        "page_images": f"""{catalog} SELECT url, CAST(0 AS INTEGER) AS position, 'http://catalog.example.com/img/' || p_partkey || '.png' AS src, p_name AS alt FROM shop
UNION ALL SELECT url, 1, 'http://catalog.example.com/thumb/' || p_partkey || '.png', '' FROM shop
UNION ALL SELECT url, 2, 'http://cdn.example.com/' || p_partkey || '.png', 'front' FROM shop""",
        "page_tables": f"""{catalog}, c AS (
SELECT url, 0 AS row_no, 'Field' AS header, 'Size' AS value FROM shop UNION ALL SELECT url, 0, 'Value', CAST(p_size AS VARCHAR) FROM shop
UNION ALL SELECT url, 1, 'Field', 'Brand' FROM shop UNION ALL SELECT url, 1, 'Value', p_brand || '©' FROM shop)
SELECT url, CAST(0 AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, header, value FROM c""",
        "page_json_ld": f"""{catalog} SELECT url, CAST(0 AS INTEGER) AS position, item AS block FROM shop WHERE p_partkey % 3 < 2
UNION ALL SELECT url, 1, '{{"offers": ' || p_partkey || '}}' FROM shop WHERE p_partkey % 3 = 1""",
        "page_next_link": f"{catalog} SELECT url, CASE WHEN p_partkey % 5 <> 0 THEN '/part/' || p_partkey || '?next=1' END AS next_link FROM shop",
        "page_images_as_written": f"""{catalog} SELECT url, CAST(0 AS INTEGER) AS position, '/img/' || p_partkey || '.png' AS src, p_name AS alt FROM shop
UNION ALL SELECT url, 1, 'thumb/' || p_partkey || '.png', '' FROM shop
UNION ALL SELECT url, 2, 'http://cdn.example.com/' || p_partkey || '.png', 'front' FROM shop""",
        "multimodal_records": f"WITH {CATALOG} {RECORDS}",
        "multimodal_records_site": SITE_RECORDS,
        "document_words": rf"""SELECT 'DOC-' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS document,
  CAST(len(list_filter(string_split_regex(text, '[ \t\n\r\f\x0B]+'), lambda w: w <> '')) AS INTEGER) AS words,
  CAST(length(regexp_replace(regexp_replace(text, '[ \t\n\r\f\x0B]{{2,}}', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS INTEGER) AS length FROM documents""",
        "build_dataset": f"WITH {GOOD} {RECORDS}",
        "build_dataset_site": SITE_RECORDS,
        "append_new_pages": "SELECT DISTINCT url, CAST(length(html) AS INTEGER) AS html_length FROM pages",
        "stream_new_pages": "SELECT DISTINCT url, CAST(length(html) AS INTEGER) AS html_length FROM pages",
        "report_key_figures": f"""WITH {SALES} SELECT COUNT(*) AS total_orders, {half_up(added("revenue"), 4)} AS total_revenue,
{half_up(averaged("revenue"), 4)} AS avg_order_value, {half_up("max(revenue)", 4)} AS max_order_value, {half_up("min(revenue)", 4)} AS min_order_value,
COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT product) AS unique_products FROM sales""",
        "jsonl_line_count": "SELECT COUNT(*) AS line_count FROM pages",
        "csv_round_trip": "SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority FROM orders",
        "jsonl_quarantine": """SELECT CASE WHEN page_id % 5 = 0 THEN 'bad' ELSE 'good' END AS kind, CASE WHEN page_id % 5 <> 0 THEN page_id END AS page_id,
  CASE WHEN page_id % 5 = 0 THEN left(url, 20) ELSE url END AS content FROM pages WHERE page_id % 7 <> 0""",
        "jsonl_line_kinds": """SELECT COUNT(*) AS lines, COUNT(*) FILTER (page_id % 7 <> 0 AND page_id % 5 <> 0) AS good,
  COUNT(*) FILTER (page_id % 7 <> 0 AND page_id % 5 = 0) AS bad, COUNT(*) FILTER (page_id % 7 = 0) AS blank FROM pages""",
        "clean_sales_file_order": """WITH first AS (
  SELECT *, l_extendedprice / l_quantity AS unit_price FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_quantity DESC, l_extendedprice / l_quantity DESC, l_discount DESC, l_partkey DESC) = 1)
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_quantity AS quantity, unit_price, l_discount AS discount_pct, l_partkey AS part_key,
  r_name AS region, strftime(o_orderdate, '%Y-%m') AS year_month
FROM first, orders, customer, nation, region
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name <> 'ASIA'""",
        "clean_trips_counts": """WITH r AS (SELECT ts, value, CAST(0.05 AS DOUBLE) + CAST(event_id % 400 AS DOUBLE) / CAST(10 AS DOUBLE) AS d FROM events),
k AS (SELECT *, ts IS NOT NULL AS a, ts IS NOT NULL AND value IS NOT NULL AS b, value >= 1 AND value <= 500 AS c, d >= 0.1 AND d <= 100 AS e FROM r),
n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (a) AS n1, COUNT(*) FILTER (b) AS n2, COUNT(*) FILTER (b AND c) AS n3, COUNT(*) FILTER (b AND c AND e) AS n4 FROM k)
SELECT unnest(['before', 'no_tpep_pickup_datetime', 'no_tpep_dropoff_datetime', 'no_fare_amount', 'no_trip_distance', 'fare_amount_out_of_range', 'trip_distance_out_of_range', 'after']) AS rule,
  unnest([n0, n0 - n1, 0, n1 - n2, 0, n2 - n3, n3 - n4, n4]) AS rows FROM n""",
        "clean_sales_counts": """WITH l AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN r_name <> 'ASIA' THEN r_name END AS region
  FROM lineitem, orders, customer, nation, region
  WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey),
f AS (SELECT l_orderkey, l_linenumber, any_value(region) AS region FROM l GROUP BY 1, 2),
n AS (SELECT (SELECT COUNT(*) FROM l) AS n0, COUNT(*) AS n1, COUNT(region) AS n2 FROM f)
SELECT unnest(['before', 'duplicates', 'no_revenue_or_region', 'unreadable_revenue', 'unreadable_date', 'after']) AS rule, unnest([n0, n0 - n1, n1 - n2, 0, 0, n2]) AS rows FROM n""",
        "cleaned_parquet_rebuilt": f"WITH {TRIPS} SELECT hour_of_day, {avg_fare}, {trip_count}, {fare_total} FROM trips GROUP BY hour_of_day",
        "cleaned_parquet_reuse": f"WITH {TRIPS} SELECT hour_of_day, {avg_fare}, {trip_count}, {fare_total} FROM trips GROUP BY hour_of_day",
        "read_parquet_folder": "SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN true END AS late FROM orders",
        "file_inventory": " UNION ALL ".join(f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS row_count FROM {t}" for t in TABLES),
        "grid_edges": f"WITH {CELLS} SELECT * FROM edges",
        "grid_distance": f"""WITH {CELLS} SELECT r AS row, c AS col, CAST(r + c AS DOUBLE) AS manhattan,
{half_up("sqrt(CAST(r * r + c * c AS DOUBLE))", 6)} AS euclidean, CAST(greatest(r, c) AS DOUBLE) AS chebyshev FROM cells""",
        "shortest_paths": f"WITH RECURSIVE {SETTLED} SELECT * FROM settled",
        "shortest_path_route": _route_to("SELECT (r, c) FROM cells ORDER BY r DESC, c DESC LIMIT 1"),
        "shortest_path_directed": _route_to("SELECT (r, c) FROM cells WHERE 2 * r >= (SELECT max(p_partkey // k) FROM part, side) AND 2 * c >= (SELECT max(p_partkey % k) FROM part, side) ORDER BY r, c LIMIT 1"),
        "supply_graph_paths": """WITH RECURSIVE links AS (
  SELECT l_partkey * 2 AS p, l_suppkey * 2 + 1 AS s, min(l_quantity) AS w FROM lineitem GROUP BY 1, 2
), e AS (SELECT p AS a, s AS b, w FROM links UNION ALL SELECT s, p, w FROM links),
walk(node, score) USING KEY (node) AS (
  SELECT min(s), CAST(0 AS DOUBLE) FROM links
  UNION
  SELECT e.b, min(w.score + e.w * 1e6 + 1) FROM walk w JOIN e ON e.a = w.node LEFT JOIN recurring.walk k ON k.node = e.b
  WHERE k.score IS NULL OR w.score + e.w * 1e6 + 1 < k.score GROUP BY e.b
)
SELECT node, floor(score / 1e6) AS cost, CAST(score - 1e6 * floor(score / 1e6) AS INTEGER) AS hops FROM walk""",
    }
