"""The same results in plain SQL, written straight from the definitions, for comparison."""

from __future__ import annotations

from basketlens.fixed_values import ADJUSTMENT_DESCRIPTIONS, LIST_SIZES, NON_PRODUCT_CODES


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in dict.fromkeys(values))


def _trim(expr: str) -> str:
    return f"nullif(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g'), '')"


def _hash(seed: int, *keys: str) -> str:
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5({text} || '|{seed}'), 1, 8) AS BIGINT)"


def _stable(expr: str) -> str:
    return f"(round(({expr}) * 1e10) / 1e10)"


RAW = f"""
raw AS (
  SELECT CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'C' ELSE '' END || CAST(l_orderkey AS VARCHAR) AS InvoiceNo,
    CASE WHEN l_partkey % 97 = 0 THEN 'POST' WHEN l_partkey % 89 = 0 THEN 'C2' ELSE CAST(l_partkey AS VARCHAR) END AS StockCode,
    {_trim("CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 47 = 0 THEN ' damaged ' ELSE ' ' || p_name || ' ' END")} AS Description,
    CAST(CASE WHEN l_linenumber = 7 THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS InvoiceDate,
    p_retailprice AS UnitPrice,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
    {_trim("n_name")} AS Country,
    l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""
KEPT = "raw_kept AS (SELECT * FROM raw WHERE NOT coalesce(contains(InvoiceNo, 'C'), false))"
SOLD = "sold AS (SELECT * FROM raw_kept WHERE Quantity > 0)"
_CODES = "coalesce(regexp_matches(StockCode, '" + "|".join(NON_PRODUCT_CODES) + "'), false)"
PRODUCTS = f"products AS (SELECT * FROM sold WHERE NOT {_CODES})"
CLEAN = f"""
clean AS (
  SELECT * REPLACE (TRY_CAST(InvoiceNo AS DOUBLE) AS InvoiceNo),
    CAST(InvoiceDate AS DATE) AS Date, strftime(InvoiceDate, '%H:%M:%S') AS Time
  FROM products WHERE Description IS NOT NULL AND Description NOT IN ({_texts(ADJUSTMENT_DESCRIPTIONS)}))
"""
RETAIL = _with(RAW, KEPT, SOLD, PRODUCTS, CLEAN)

PART_BASKETS = "baskets AS (SELECT DISTINCT l_orderkey AS order_id, l_partkey AS item FROM lineitem)"
NAME_BASKETS = (
    "baskets AS (SELECT DISTINCT l_orderkey AS order_id, p_name AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"
)
PART_RATINGS = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item, avg(1 + floor((l_quantity - 1) / 10)) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
"""
EVENT_RATINGS = """
ratings AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item,
    avg(least(5, 1 + floor(value / 25))) AS rating
  FROM events GROUP BY 1, 2)
"""

SQL: dict[str, str] = {}

SQL["clean_retail"] = RETAIL + """
SELECT InvoiceNo, StockCode, Description, Quantity, strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, UnitPrice,
  CustomerID, Country, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, CAST(Date AS VARCHAR) AS Date, Time
FROM clean"""
SQL["cancellation_count"] = _with(RAW) + "SELECT count(*) AS Total FROM raw WHERE contains(InvoiceNo, 'C')"
SQL["cleaning_counts"] = RETAIL + """
SELECT CAST(0 AS INT) AS step, 'raw' AS name, count(*) AS lines FROM raw UNION ALL
SELECT 1, 'without cancellations', count(*) FROM raw_kept UNION ALL
SELECT 2, 'positive quantities', count(*) FROM sold UNION ALL
SELECT 3, 'without other codes', count(*) FROM products UNION ALL
""" + f"""
SELECT 4, 'without adjustments', count(*) FROM products WHERE NOT coalesce(Description IN ({_texts(ADJUSTMENT_DESCRIPTIONS)}), false) UNION ALL
SELECT 5, 'with description', count(*) FROM clean"""
SQL["adjustment_audit"] = _with(RAW, KEPT) + """
SELECT Description, UnitPrice, count(*) AS count FROM raw_kept WHERE Quantity <= 0 GROUP BY 1, 2"""
SQL["stockcode_audit"] = _with(RAW, KEPT, SOLD) + f"""
SELECT StockCode, Description, count(*) AS count FROM sold WHERE {_CODES} GROUP BY 1, 2"""
SQL["product_line_count"] = _with(RAW, KEPT, SOLD, PRODUCTS) + "SELECT count(*) AS n_rows FROM products"

SQL["text_lines"] = _with(RAW) + """
SELECT InvoiceNo, StockCode, Description, Quantity, strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, UnitPrice, CustomerID, Country
FROM raw WHERE l_partkey % 43 <> 0"""
SQL["text_line_report"] = _with(RAW) + """
SELECT count(*) AS lines, count(*) FILTER (WHERE l_partkey % 43 = 0) AS broken_lines,
  count(*) FILTER (WHERE l_partkey % 43 <> 0 AND CustomerID IS NULL) AS without_key FROM raw"""
SQL["text_ratings"] = _with(PART_RATINGS) + "SELECT user_id, item, round(rating, 6) AS rating FROM ratings"
SQL["first_lines"] = _with(RAW) + """
SELECT * REPLACE (strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate) FROM raw ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice LIMIT 6"""
_PROFILED = {
    "InvoiceNo": "string", "StockCode": "string", "Description": "string", "Quantity": "int", "InvoiceDate": "timestamp_ntz",
    "UnitPrice": "double", "CustomerID": "string", "Country": "string",
}
SQL["null_profile"] = _with(RAW) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw" for c in _PROFILED
)
SQL["distinct_with_null"] = _with(RAW) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + CAST(coalesce(max(CAST({c} IS NULL AS INT)), 0) AS BIGINT) AS n_distinct FROM raw"
    for c in ("InvoiceNo", "CustomerID")
)


def _profile_row(c: str) -> str:
    kind = _PROFILED[c]
    numeric = kind in ("int", "double")
    stats = {"mean": "avg(v)", "sd": "stddev_samp(v)", "min": "min(v)", "max": "max(v)"}
    stats |= {f"p{int(s * 100)}": f"quantile_cont(v, {s})" for s in (0.25, 0.5, 0.75)}
    columns = ", ".join(f"round({e}, 4) AS {n}" for n, e in stats.items())
    value = f"CAST({c} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    length = "length(x)" if kind == "string" else "NULL"
    day = "strftime(x, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp_ntz" else "CAST(NULL AS VARCHAR)"
    columns = (
        f"count(DISTINCT x) AS n_distinct, CAST(min({length}) AS DOUBLE) AS shortest, CAST(max({length}) AS DOUBLE) AS longest, "
        f"min({day}) AS earliest, max({day}) AS latest, {columns}"
    )
    return f"SELECT '{c}' AS \"column\", '{kind}' AS type, count(*) AS n, count(*) FILTER (WHERE x IS NULL) AS n_null, {columns} FROM (SELECT {c} AS x, {value} AS v FROM raw)"


SQL["column_profile"] = _with(RAW) + " UNION ALL ".join(_profile_row(c) for c in _PROFILED)
SQL["customer_profile"] = _with(RAW) + """
SELECT 'CustomerID' AS "column", count(*) AS n, count(*) FILTER (WHERE CustomerID IS NULL) AS n_null FROM raw"""

SQL["best_sellers_top10"] = RETAIL + """
SELECT Description, count FROM (
  SELECT Description, count, rank() OVER (ORDER BY count DESC) AS place
  FROM (SELECT Description, count(*) AS count FROM clean GROUP BY 1)) WHERE place <= 10"""
SQL["item_share_top10"] = RETAIL + """
SELECT Description, count, round(pct, 6) AS pct FROM (
  SELECT *, rank() OVER (ORDER BY pct DESC) AS place FROM (
    SELECT Description, count, count / CAST((SELECT count(*) FROM clean) AS DOUBLE) * 100 AS pct
    FROM (SELECT Description, count(*) AS count FROM clean GROUP BY 1))) WHERE place <= 10"""
SQL["lines_by_hour"] = RETAIL + "SELECT CAST(hour(InvoiceDate) AS INT) AS hour, count(*) AS count FROM clean GROUP BY 1"
SQL["lines_by_weekday"] = RETAIL + """
SELECT CAST(isodow(Date) AS INT) AS weekday, count(*) AS count,
  (['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'])[isodow(Date)] AS label FROM clean GROUP BY 1, 3"""
SQL["units_by_country"] = RETAIL + "SELECT Country, CAST(sum(Quantity) AS BIGINT) AS units FROM clean GROUP BY 1"
SQL["avg_line_quantity"] = RETAIL + "SELECT InvoiceNo, round(avg(Quantity), 6) AS avg_line_quantity FROM clean GROUP BY 1"
SQL["avg_line_value"] = RETAIL + "SELECT InvoiceNo, round(avg(UnitPrice * Quantity), 4) AS avg_line_value FROM clean GROUP BY 1"


def _histogram(value: str, bins: int, upper: str, digits: int) -> str:
    return RETAIL + f""",
means AS (SELECT InvoiceNo, {value} AS x FROM clean GROUP BY 1),
ends AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS width FROM means),
placed AS (
  SELECT lo, width, CAST(CASE WHEN width = 0 THEN {bins - 1} ELSE least(floor((x - lo) / width), {bins - 1}) END AS BIGINT) AS bin
  FROM means, ends WHERE x IS NOT NULL)
SELECT bin, round(lo + bin * width, {digits}) AS bin_from, round(lo + bin * width + width, {digits}) AS bin_to, count(*) AS count
FROM placed WHERE lo + bin * width + width >= 0 AND lo + bin * width <= {upper} GROUP BY bin, lo, width"""


SQL["line_quantity_histogram"] = _histogram("avg(Quantity)", 100_000, "100", 6)
SQL["basket_value_histogram"] = _histogram("round(avg(UnitPrice * Quantity), 4)", 200_000, "1e9", 8)

SQL["dedupe_lines"] = RETAIL + """
SELECT InvoiceNo, Description, Quantity, UnitPrice, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY InvoiceNo, Description
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS place FROM clean) WHERE place = 1"""
SQL["baskets"] = RETAIL + "SELECT DISTINCT InvoiceNo AS order_id, Description AS item FROM clean"
SQL["item_list"] = RETAIL + "SELECT DISTINCT Description AS item FROM clean"
_PIVOT = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SQL["basket_pivot"] = (
    "SELECT l_orderkey AS order_id, "
    + ", ".join(f"CAST(max(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END) AS INT) AS {t}" for t in _PIVOT)
    + " FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"
)

_TYPES = ", ".join(f"'{t}'" for t in _PIVOT)
SQL["basket_cells"] = f"SELECT DISTINCT l_orderkey AS order_id, p_type AS item FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ({_TYPES})"
SQL["invoice_keys"] = _with(RAW) + "SELECT coalesce(CustomerID, 'NA') || ' ' || coalesce(InvoiceNo, 'NA') AS key, count(*) AS lines FROM raw GROUP BY 1"
SQL["last_order_membership"] = _with(PART_BASKETS) + """
SELECT item, CAST(max(CASE WHEN order_id = (SELECT max(order_id) FROM baskets) THEN 1 ELSE 0 END) AS DOUBLE) AS value FROM baskets GROUP BY 1"""
SQL["appended_orders"] = """
WITH dated AS (
  SELECT DISTINCT l_orderkey AS order_id, 'part ' || CAST(l_partkey AS VARCHAR) AS item, year(o_orderdate) AS y, (SELECT year(max(o_orderdate)) FROM orders) AS latest
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT order_id, item FROM dated UNION ALL
SELECT DISTINCT order_id, '(no such item)' FROM dated WHERE y = latest"""

RECOMMENDED = """
sizes AS (SELECT order_id, count(*) AS size FROM baskets GROUP BY 1),
shared_items AS (
  SELECT a.order_id AS basket_id, b.order_id AS order_id, count(*) AS overlap
  FROM baskets a JOIN baskets b ON a.item = b.item AND a.order_id <> b.order_id GROUP BY 1, 2),
sims AS (
  SELECT basket_id, o.order_id, overlap / sqrt(CAST(s.size * t.size AS DOUBLE)) AS sim
  FROM shared_items o JOIN sizes s ON s.order_id = o.basket_id JOIN sizes t ON t.order_id = o.order_id),
near AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY basket_id ORDER BY sim DESC) AS place FROM sims) WHERE place <= 3),
scored AS (
  SELECT basket_id, item, sum(sim * 1.0) / sum(abs(sim)) AS score, sum(sim) AS support_sim
  FROM near JOIN baskets USING (order_id) GROUP BY 1, 2)
"""
SQL["basket_recommend_all"] = _with(PART_BASKETS, RECOMMENDED) + """
SELECT basket_id, item, round(score, 6) AS score, round(support_sim, 6) AS support_sim FROM scored"""
SQL["basket_recommend_unseen"] = _with(PART_BASKETS, RECOMMENDED) + """
SELECT basket_id, item AS Recommendations, round(support_sim, 6) AS support_sim FROM scored s
WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM baskets b WHERE b.order_id = s.basket_id AND b.item = s.item)"""

SQL["name_basket_recommend"] = SQL["basket_recommend_unseen"].replace(PART_BASKETS, NAME_BASKETS)

NEW_AND_PAST = """
dated AS (
  SELECT DISTINCT l_orderkey AS order_id, 'part ' || CAST(l_partkey AS VARCHAR) AS item, year(o_orderdate) AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
latest AS (SELECT year(max(o_orderdate)) AS y FROM orders),
past AS (SELECT order_id, item FROM dated WHERE y < (SELECT y FROM latest)),
new AS (
  SELECT order_id AS basket_id, item FROM dated
  WHERE y = (SELECT y FROM latest) AND item IN (SELECT item FROM past)),
new_sizes AS (SELECT basket_id, count(*) AS size FROM new GROUP BY 1),
past_sizes AS (SELECT order_id, count(*) AS size FROM past GROUP BY 1),
sims AS (
  SELECT basket_id, order_id, count(*) / sqrt(CAST(any_value(n.size) * any_value(p.size) AS DOUBLE)) AS sim
  FROM new JOIN past USING (item) JOIN new_sizes n USING (basket_id) JOIN past_sizes p USING (order_id) GROUP BY 1, 2),
near AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY basket_id ORDER BY sim DESC) AS place FROM sims) WHERE place <= 3),
scored AS (
  SELECT basket_id, item, sum(sim * 1.0) / sum(abs(sim)) AS score, sum(sim) AS support_sim
  FROM near JOIN past USING (order_id) GROUP BY 1, 2)
"""
SQL["new_basket_scores"] = _with(NEW_AND_PAST) + """
SELECT basket_id, item, round(score, 6) AS score, round(support_sim, 6) AS support_sim FROM scored"""
SQL["new_basket_recommend"] = _with(NEW_AND_PAST) + """
SELECT basket_id, item AS Recommendations, round(support_sim, 6) AS support_sim FROM scored s
WHERE score > 0 AND NOT EXISTS (SELECT 1 FROM new n WHERE n.basket_id = s.basket_id AND n.item = s.item)"""
SQL["stored_basket_recommend"] = SQL["new_basket_recommend"]

PLAIN = "vals AS (SELECT user_id, item, rating AS v FROM ratings)"


def _centered(by: str = "") -> str:
    return f"""
means AS (SELECT {by} user_id, avg(rating) AS mean FROM ratings GROUP BY ALL),
vals AS (
  SELECT {by} user_id, item, CASE WHEN rating = mean THEN 1e-6 ELSE rating - mean END AS v
  FROM ratings JOIN means USING ({by} user_id))
"""


def _sims(entity: str, metric: str, k: int | None, shift: bool = False, by: str = "") -> str:
    """``by`` is empty or 'fold,'."""
    own, other = ("item", "user_id") if entity == "item" else ("user_id", "item")
    same = f"a.{other} = b.{other}" + (" AND a.fold = b.fold" if by else "")
    fold = "a.fold AS fold," if by else ""
    if metric == "cosine":
        unit = f"prep AS (SELECT {by} {own}, {other}, v / sqrt(sum(v * v) OVER (PARTITION BY {by} {own})) AS x FROM vals)"
        value = "sum(a.x * b.x)"
    else:
        unit = f"prep AS (SELECT {by} {own}, {other}, v - avg(v) OVER (PARTITION BY {by} {own}) AS x FROM vals)"
        value = "sum(a.x * b.x) / nullif(sqrt(sum(a.x * a.x)) * sqrt(sum(b.x * b.x)), 0)"
    shifted = _stable("s - least((SELECT min(s) FROM raw_sims), 0)") if shift else "s"
    cut = "" if k is None else f"WHERE place <= {k}"
    return f"""
{unit},
raw_sims AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN s = 0 THEN 1e-6 ELSE s END AS s) FROM (
    SELECT {fold} a.{own} AS target, b.{own} AS neighbour, {_stable(value)} AS s
    FROM prep a JOIN prep b ON {same} AND a.{own} <> b.{own} GROUP BY ALL) WHERE s IS NOT NULL),
sims AS (
  SELECT {by} target, neighbour, sim FROM (
    SELECT {by} target, neighbour, {shifted} AS sim, rank() OVER (PARTITION BY {by} target ORDER BY s DESC) AS place
    FROM raw_sims) {cut})
"""


def _predicted(entity: str, requests: str, by: str = "") -> str:
    own, other = ("item", "user_id") if entity == "item" else ("user_id", "item")
    fold = " AND v.fold = r.fold AND s.fold = r.fold" if by else ""
    key = "r.fold, " if by else ""
    return f"""
predicted AS (
  SELECT p.{by + " p." if by else ""}user_id, item, p.prediction + mean AS prediction FROM (
    SELECT {key} r.user_id, r.item, sum(v.v * s.sim) / nullif(sum(abs(s.sim)), 0) AS prediction
    FROM {requests} r JOIN vals v ON v.{other} = r.{other}
    JOIN sims s ON s.target = r.{own} AND s.neighbour = v.{own} {fold}
    GROUP BY ALL) p JOIN means m ON m.user_id = p.user_id {"AND m.fold = p.fold" if by else ""}
  WHERE p.prediction IS NOT NULL)
"""


_SIM_OUT = "SELECT target, neighbour, round(sim, 6) AS sim FROM sims"
SQL["item_cosine"] = _with(PART_RATINGS, PLAIN, _sims("item", "cosine", 20)) + _SIM_OUT
SQL["user_cosine"] = _with(PART_RATINGS, PLAIN, _sims("user", "cosine", 20)) + _SIM_OUT
SQL["item_correlation"] = _with(EVENT_RATINGS, PLAIN, _sims("item", "correlation", None)) + _SIM_OUT
SQL["item_products"] = _with(EVENT_RATINGS) + """
SELECT a.item AS x_col, b.item AS y_col, round(sum(a.rating * b.rating), 6) AS value FROM ratings a JOIN ratings b ON a.user_id = b.user_id GROUP BY 1, 2"""
SQL["item_jaccard"] = _with(
    PART_RATINGS,
    "sizes AS (SELECT item, count(*) AS n FROM ratings GROUP BY 1)",
    f"""both_rated AS (
      SELECT a.item AS target, b.item AS neighbour, {_stable("count(*) / CAST(any_value(x.n) + any_value(y.n) - count(*) AS DOUBLE)")} AS sim
      FROM ratings a JOIN ratings b ON a.user_id = b.user_id AND a.item <> b.item
      JOIN sizes x ON x.item = a.item JOIN sizes y ON y.item = b.item GROUP BY 1, 2)""",
    "sims AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY target ORDER BY sim DESC) AS place FROM both_rated) WHERE place <= 20)",
) + _SIM_OUT
SQL["center_ratings"] = _with(PART_RATINGS, _centered()) + """
SELECT user_id, item, round(rating, 6) AS rating, round(v, 6) AS v FROM vals JOIN ratings USING (user_id, item)"""
SQL["shifted_similarities"] = _with(EVENT_RATINGS, _centered(), _sims("item", "cosine", 20, shift=True)) + _SIM_OUT
_PRED_OUT = "SELECT user_id, item, round(prediction, 4) AS prediction FROM predicted"
SQL["ibcf_predict"] = _with(PART_RATINGS, _centered(), _sims("item", "cosine", 300), _predicted("item", "ratings")) + _PRED_OUT
SQL["ibcf_correlation_predict"] = (
    _with(EVENT_RATINGS, _centered(), _sims("item", "correlation", 20, shift=True), _predicted("item", "ratings")) + _PRED_OUT
)
SQL["ubcf_predict"] = _with(PART_RATINGS, _centered(), _sims("user", "cosine", 300), _predicted("user", "ratings")) + _PRED_OUT

_REQUESTS = """asked AS (
  SELECT user_id, item FROM (SELECT DISTINCT user_id FROM ratings WHERE user_id IN (5, 10, 30)), (SELECT DISTINCT item FROM ratings))"""
SQL["ibcf_requests"] = _with(PART_RATINGS, _REQUESTS, _centered(), _sims("item", "cosine", 300), _predicted("item", "asked")) + _PRED_OUT
SQL["ubcf_requests"] = _with(PART_RATINGS, _REQUESTS, _centered(), _sims("user", "cosine", 300), _predicted("user", "asked")) + _PRED_OUT


def _cross_validated(source: str, folds: int) -> str:
    """Train rows of every fold, then the same steps with the fold in each key."""
    cells = source.replace("ratings AS (", "all_cells AS (", 1)
    return _with(
        cells,
        f"cells AS (SELECT *, CAST({_hash(1, 'user_id', 'item')} % {folds} + 1 AS INT) AS own FROM all_cells)",
        f"ratings AS (SELECT f.fold, user_id, item, rating FROM cells, (SELECT unnest(range(1, {folds + 1})) AS fold) f WHERE own <> f.fold)",
        "asked AS (SELECT own AS fold, user_id, item, rating AS actual FROM cells)",
        _centered("fold,"),
        _sims("item", "cosine", 300, by="fold,"),
        _predicted("item", "asked", by="fold,"),
        """clamped AS (
          SELECT CAST(p.fold AS INT) AS fold, user_id, item, greatest(1.0, least(5.0, prediction)) AS prediction, actual AS rating
          FROM predicted p JOIN asked USING (user_id, item))""",
    )


SQL["rating_cv_predictions"] = _cross_validated(PART_RATINGS, 3) + """
SELECT fold, user_id, item, round(CAST(prediction AS DOUBLE), 4) AS prediction, round(rating, 4) AS rating FROM clamped"""
SQL["rating_cv_rmse"] = _cross_validated(EVENT_RATINGS, 10) + """
SELECT round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse, count(*) AS n_predicted FROM clamped"""

SUPPORT, CONFIDENCE = 0.003, 0.01


def _rules(by_fold: bool = False) -> str:
    """Rules of frequent sets of two and three items. No set of four is frequent in the given tables."""
    src = "train" if by_fold else "(SELECT 1 AS fold, * FROM baskets)"
    return f"""
rb AS (SELECT fold, order_id, item FROM {src}),
total AS (SELECT fold, count(DISTINCT order_id) AS n, ceil(CAST({SUPPORT} AS DOUBLE) * count(DISTINCT order_id)) AS least_n FROM rb GROUP BY 1),
single AS (SELECT fold, item, count(*) AS n FROM rb GROUP BY 1, 2),
pairs AS (
  SELECT a.fold, a.item AS a, b.item AS b, count(*) AS n
  FROM rb a JOIN rb b ON a.fold = b.fold AND a.order_id = b.order_id AND a.item < b.item GROUP BY ALL),
triples AS (
  SELECT a.fold, a.item AS a, b.item AS b, c.item AS c, count(*) AS n
  FROM rb a JOIN rb b ON a.fold = b.fold AND a.order_id = b.order_id AND a.item < b.item
  JOIN rb c ON c.fold = a.fold AND c.order_id = a.order_id AND b.item < c.item GROUP BY ALL),
candidates AS (
  SELECT fold, [a] AS antecedent, b AS consequent, n FROM pairs UNION ALL
  SELECT fold, [b], a, n FROM pairs UNION ALL
  SELECT fold, [a, b], c, n FROM triples UNION ALL
  SELECT fold, [a, c], b, n FROM triples UNION ALL
  SELECT fold, [b, c], a, n FROM triples),
known AS (
  SELECT fold, [item] AS items, n FROM single UNION ALL
  SELECT fold, [a, b], n FROM pairs),
rules AS (
  SELECT p.fold, p.antecedent, p.consequent, CAST(p.n AS DOUBLE) / s.n AS confidence,
    (CAST(p.n AS DOUBLE) / s.n) / (CAST(c.n AS DOUBLE) / t.n) AS lift, CAST(p.n AS DOUBLE) / t.n AS support
  FROM candidates p JOIN known s ON s.fold = p.fold AND s.items = p.antecedent
  JOIN single c ON c.fold = p.fold AND c.item = p.consequent JOIN total t ON t.fold = p.fold
  WHERE p.n >= t.least_n AND CAST(p.n AS DOUBLE) / s.n >= {CONFIDENCE})
"""


SQL["rules_mined"] = _with(NAME_BASKETS, _rules()) + f"""
SELECT array_to_string(antecedent, ',') AS antecedent, consequent, round({_stable("confidence")}, 6) AS confidence, round(lift, 6) AS lift, round(support, 6) AS support
FROM rules"""

# every order completed from all orders
FULL = """
train AS (SELECT 1 AS fold, order_id, item FROM baskets),
given AS (SELECT 1 AS fold, order_id AS basket_id, item FROM baskets)
"""


def _scheme(folds: int = 5, seed: int = 1) -> str:
    return f"""
numbered AS (SELECT *, CAST({_hash(seed, 'order_id')} % {folds} + 1 AS INT) AS own FROM baskets),
held AS (
  SELECT order_id AS basket_id, own AS fold, item AS held_item, n - 1 AS n_given FROM (
    SELECT *, count(*) OVER (PARTITION BY order_id) AS n,
      row_number() OVER (PARTITION BY order_id ORDER BY {_hash(seed, 'order_id', 'item')}, item) AS place FROM numbered)
  WHERE n > 1 AND place = 1),
given AS (
  SELECT h.fold, basket_id, item FROM held h JOIN baskets b ON b.order_id = h.basket_id WHERE item <> held_item),
train AS (
  SELECT CAST(f.fold AS INT) AS fold, order_id, item FROM numbered, (SELECT unnest(range(1, {folds + 1})) AS fold) f WHERE own <> f.fold)
"""


SQL["basket_folds"] = _with(PART_BASKETS, _scheme()) + "SELECT basket_id, fold, held_item, n_given FROM held"

COUNTS = "counts AS (SELECT fold, item, count(*) AS n FROM train GROUP BY 1, 2)"
GIVEN_SIZES = "given_sizes AS (SELECT fold, basket_id, count(*) AS size FROM given GROUP BY 1, 2)"


def _scored_rules() -> str:
    return _rules(True) + f""",
parts AS (SELECT *, len(antecedent) AS needed, unnest(antecedent) AS item FROM rules),
fired AS (
  SELECT basket_id, antecedent, consequent, confidence
  FROM given g JOIN parts r ON r.fold = g.fold AND r.item = g.item
  GROUP BY basket_id, antecedent, consequent, confidence, needed HAVING count(*) = needed),
scored AS (SELECT basket_id, consequent AS item, max({_stable("confidence")}) AS score FROM fired GROUP BY 1, 2)"""


def _scored_popular(n: int) -> str:
    """The n best items a basket does not hold are among its size + n best of all."""
    return f"""
{COUNTS}, {GIVEN_SIZES},
places AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY n DESC, item) AS place FROM counts),
scored AS (
  SELECT basket_id, item, CAST(n AS DOUBLE) AS score FROM given_sizes g JOIN places p ON p.fold = g.fold AND p.place <= g.size + {n})
"""


def _scored_random(n: int, seed: int = 1) -> str:
    return f"""
{GIVEN_SIZES},
circle AS (
  SELECT item, row_number() OVER (ORDER BY {_hash(seed, 'item')}, item) - 1 AS number FROM (SELECT DISTINCT item FROM train)),
total AS (SELECT count(*) AS n FROM circle),
tries AS (SELECT n + unnest(range(0, 300)) AS p FROM total),
divided AS (SELECT p, unnest(range(2, CAST(floor(sqrt(p)) AS BIGINT) + 1)) AS d FROM tries),
prime AS (SELECT min(p) AS p FROM tries WHERE p > 1 AND p NOT IN (SELECT p FROM divided WHERE p % d = 0)),
steps AS (
  SELECT basket_id, p, unnest(range(0, least(size + {n} + p - n, p))) AS step, {_hash(seed, 'basket_id')} % p AS start,
    1 + {_hash(seed + 1, 'basket_id')} % (p - 1) AS stride
  FROM given_sizes, prime, total),
scored AS (
  SELECT basket_id, item, CAST(-step AS DOUBLE) AS score FROM steps JOIN circle ON number = (start + step * stride) % p)
"""


def _scored_item_based(k: int = 5) -> str:
    return f"""
{COUNTS},
both_held AS (
  SELECT a.fold, a.item AS item, b.item AS neighbour, count(*) AS n
  FROM train a JOIN train b ON a.fold = b.fold AND a.order_id = b.order_id AND a.item <> b.item GROUP BY ALL),
sims AS (
  SELECT p.fold, p.item, neighbour, CAST(p.n AS DOUBLE) / (x.n + y.n - p.n) AS sim
  FROM both_held p JOIN counts x ON x.fold = p.fold AND x.item = p.item JOIN counts y ON y.fold = p.fold AND y.item = p.neighbour),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fold, item ORDER BY sim DESC, neighbour) AS place FROM sims)
  WHERE place <= {k}),
scored AS (
  SELECT basket_id, s.item, {_stable("sum(sim)")} AS score
  FROM given g JOIN near s ON s.fold = g.fold AND s.neighbour = g.item GROUP BY 1, 2)
"""


def _scored_user_based(k: int = 500) -> str:
    return f"""
{GIVEN_SIZES},
order_sizes AS (SELECT order_id, count(*) AS size FROM baskets GROUP BY 1),
shared_items AS (
  SELECT g.fold, basket_id, order_id, count(*) AS overlap FROM given g JOIN train t ON t.fold = g.fold AND t.item = g.item GROUP BY ALL),
sims AS (
  SELECT o.fold, o.basket_id, o.order_id, overlap / sqrt(CAST(s.size * t.size AS DOUBLE)) AS sim
  FROM shared_items o JOIN given_sizes s ON s.basket_id = o.basket_id JOIN order_sizes t ON t.order_id = o.order_id),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY basket_id ORDER BY sim DESC, order_id) AS place FROM sims)
  WHERE place <= {k}),
scored AS (
  SELECT basket_id, item, {_stable("sum(sim)")} AS score FROM near JOIN baskets USING (order_id) GROUP BY 1, 2)
"""


def _top(n: int) -> str:
    return f"""
lists AS (
  SELECT * FROM (
    SELECT basket_id, item, score, row_number() OVER (PARTITION BY basket_id ORDER BY score DESC, item) AS rank
    FROM scored s WHERE NOT EXISTS (SELECT 1 FROM given g WHERE g.basket_id = s.basket_id AND g.item = s.item))
  WHERE rank <= {n})
"""


_TOP_OUT = "SELECT basket_id, item, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM lists"
SQL["rules_recommend"] = _with(NAME_BASKETS, FULL, _scored_rules(), _top(10)) + _TOP_OUT
SQL["popular_topn"] = _with(PART_BASKETS, FULL, _scored_popular(10), _top(10)) + _TOP_OUT
SQL["random_topn"] = _with(PART_BASKETS, FULL, _scored_random(10), _top(10)) + _TOP_OUT
SQL["item_based_topn"] = _with(PART_BASKETS, FULL, _scored_item_based(), _top(10)) + _TOP_OUT
SQL["user_based_topn"] = _with(PART_BASKETS, _scheme(), _scored_user_based(), _top(10)) + _TOP_OUT

SQL["training_part_lists"] = _with(
    PART_BASKETS,
    _scheme().replace("train AS (", "all_train AS (", 1).replace("given AS (", "all_given AS (", 1),
    "train AS (SELECT * FROM all_train WHERE fold = 1)",
    "given AS (SELECT * FROM all_given WHERE fold = 1)",
    _scored_item_based(),
    _top(10),
) + "SELECT basket_id, string_agg(CAST(item AS VARCHAR), ',' ORDER BY rank) AS items FROM lists GROUP BY 1"

_SCORED = {
    "association rules": _scored_rules(),
    "random items": _scored_random(20),
    "popular items": _scored_popular(20),
    "item-based CF": _scored_item_based(),
    "user-based CF": _scored_user_based(),
}
_SIZES = ", ".join(f"({s})" for s in LIST_SIZES)
_MEANS = ["precision", "recall", "TPR", "FPR"]


def _confusion(model: str) -> str:
    return f"""
found AS (
  SELECT l.basket_id, count(*) AS listed, min(CASE WHEN item = held_item THEN rank END) AS hit
  FROM lists l JOIN held h ON h.basket_id = l.basket_id GROUP BY 1),
n_items AS (SELECT count(DISTINCT item) AS n_items FROM baskets),
numbers AS (
  SELECT fold, n, n_items, n_given, CASE WHEN hit <= n THEN 1 ELSE 0 END AS TP, least(coalesce(listed, 0), n) AS long
  FROM held LEFT JOIN found USING (basket_id), (VALUES {_SIZES}) sizes(n), n_items),
full_numbers AS (
  SELECT fold, n, TP, long - TP AS FP, 1 - TP AS FN, n_items - n_given - TP - (long - TP) - (1 - TP) AS TN FROM numbers),
confusion AS (
  SELECT '{model}' AS model, fold, CAST(n AS INT) AS n, avg(TP) AS TP, avg(FP) AS FP, avg(FN) AS FN, avg(TN) AS TN,
    avg(CAST(TP AS DOUBLE) / nullif(TP + FP, 0)) AS precision, avg(CAST(TP AS DOUBLE) / nullif(TP + FN, 0)) AS recall,
    avg(CAST(TP AS DOUBLE) / nullif(TP + FN, 0)) AS TPR, avg(CAST(FP AS DOUBLE) / nullif(FP + TN, 0)) AS FPR
  FROM full_numbers GROUP BY fold, n)
"""


def _confusion_sql(model: str) -> str:
    return _with(NAME_BASKETS, _scheme(), _SCORED[model], _top(20), _confusion(model))


_CONFUSION_COLUMNS = ", ".join(f"round({c}, 6) AS {c}" for c in ["TP", "FP", "FN", "TN", *_MEANS])
for _name, _model in [
    ("rules", "association rules"),
    ("random", "random items"),
    ("popular", "popular items"),
    ("item_based", "item-based CF"),
    ("user_based", "user-based CF"),
]:
    SQL[f"model_confusion_{_name}"] = _confusion_sql(_model) + f"SELECT model, fold, n, {_CONFUSION_COLUMNS} FROM confusion"


def _summary(columns: list[str]) -> str:
    out = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
    means = ", ".join(f"avg({c}) AS {c}" for c in _MEANS)
    each = " UNION ALL ".join(
        f"SELECT * FROM ({_confusion_sql(m)} SELECT model, n, {means} FROM confusion GROUP BY model, n)" for m in _SCORED
    )
    return f"SELECT model, n, {out} FROM ({each})"


SQL["model_summary"] = _summary(_MEANS)
SQL["roc_points"] = _summary(["FPR", "TPR"])
SQL["pr_points"] = _summary(["recall", "precision"])
