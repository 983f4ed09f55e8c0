"""The same queries as SQL for another engine to run on the same tables."""

from __future__ import annotations

from sluice.plans.catalogue import THRESHOLDS

PEOPLE = """
  people AS (
    SELECT c_custkey AS "Customer_ID", c_mktsegment AS "Profession",
           c_acctbal AS "Account_Balance", n_name AS "City", r_name AS "Location"
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey)"""
SALES = """
  sales AS (
    SELECT o_custkey AS "Customer_ID", o_orderkey AS "Order_ID", o_totalprice AS "Sale_Amount",
           o_orderpriority AS "Lead_Source", o_orderdate AS "Start_Date",
           CASE WHEN o_orderstatus = 'F' THEN 'Converted' ELSE 'Not Converted' END
             AS "Conversion_Status"
    FROM orders)"""
MARKETING = """
  marketing AS (
    SELECT user_id AS "Customer_ID", count(*) AS "Touches",
           round(count(*) FILTER (event_type = 'view') * 100.0::DOUBLE / count(*), 6)
             AS "Email_open_rate",
           round(count(*) FILTER (event_type = 'click') * 100.0::DOUBLE / count(*), 6)
             AS "click_through_rate"
    FROM events GROUP BY user_id)"""


def bucket(key: str) -> str:
    return f"('0x' || substr(md5(':' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT % 1000"


LEADS = f"""{PEOPLE}, {SALES},
  leads AS (
    SELECT *, CASE WHEN bucket < 600 THEN 'train' WHEN bucket < 800 THEN 'validation'
                   ELSE 'test' END AS split
    FROM (SELECT "Order_ID" AS "Lead_ID", *,
                 CASE "Conversion_Status" WHEN 'Converted' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label,
                 {bucket('"Customer_ID"')} AS bucket,
                 least(1.0, greatest(0.0, ("Account_Balance" + 1000.0::DOUBLE) / 11000.0::DOUBLE))::DOUBLE
                   AS score
          FROM sales JOIN people USING ("Customer_ID")))"""
SCORED = f"""{LEADS},
  scored AS (SELECT *, CASE WHEN score > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
             FROM leads)"""


INDEXED = ("Profession", "City", "Location", "Lead_Source", "Customer_ID")


def level_ranks(column: str, source: str = "leads WHERE split = 'train'") -> str:
    """Levels of a column by falling frequency, ties by name."""
    return (f'(SELECT "{column}" AS level, row_number() OVER (ORDER BY count(*) DESC, "{column}") - 1 '
            f'AS rank FROM {source} GROUP BY "{column}")')


def f1(source: str, *by: str) -> str:
    """Weighted F1 from precision and recall per class, for 0/1 classes."""
    group = "".join(f"{b}, " for b in by)
    tail = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""
  counts AS (
    SELECT {group}
           count(*) FILTER (label = 0 AND prediction = 0)::DOUBLE AS h0,
           count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS h1,
           count(*) FILTER (label = 0)::DOUBLE AS s0, count(*) FILTER (label = 1)::DOUBLE AS s1,
           count(*) FILTER (prediction = 0)::DOUBLE AS p0,
           count(*) FILTER (prediction = 1)::DOUBLE AS p1,
           count(*) AS rows
    FROM {source} {tail}),
  rates AS (
    SELECT *, CASE WHEN p0 > 0 THEN h0 / p0 ELSE 0 END AS prec0,
           CASE WHEN p1 > 0 THEN h1 / p1 ELSE 0 END AS prec1,
           CASE WHEN s0 > 0 THEN h0 / s0 ELSE 0 END AS rec0,
           CASE WHEN s1 > 0 THEN h1 / s1 ELSE 0 END AS rec1
    FROM counts),
  f1 AS (
    SELECT {group} rows,
           round((s0 * CASE WHEN prec0 + rec0 > 0 THEN 2 * prec0 * rec0 / (prec0 + rec0) ELSE 0 END
                + s1 * CASE WHEN prec1 + rec1 > 0 THEN 2 * prec1 * rec1 / (prec1 + rec1) ELSE 0 END)
                 / (s0 + s1), 6) AS weighted_f1
    FROM rates)"""


_CUTS = ", ".join(f"({t}::DOUBLE, {i + 1})" for i, t in enumerate(THRESHOLDS))
SWEPT = f"""{LEADS},
  swept AS (
    SELECT leads.label, leads.split, cut.threshold, cut.trial_id,
           CASE WHEN leads.score > cut.threshold THEN 1.0 ELSE 0.0 END AS prediction
    FROM leads, (VALUES {_CUTS}) AS cut(threshold, trial_id))"""

CHAIN = f"""
WITH {PEOPLE}, {SALES}, {MARKETING},
  unique_sales AS (SELECT DISTINCT "Customer_ID", "Sale_Amount", "Lead_Source", "Start_Date",
                                   "Conversion_Status" FROM sales)
SELECT "Customer_ID", "Profession", "Account_Balance", "City", "Location", "Touches",
       "Email_open_rate", "click_through_rate", "Sale_Amount", "Lead_Source", "Start_Date",
       "Conversion_Status"
FROM people JOIN marketing USING ("Customer_ID") JOIN unique_sales USING ("Customer_ID")"""

TOUCHES = f"""
WITH {PEOPLE}, {SALES}
SELECT "Customer_ID", "Profession", "Account_Balance", "City", "Location", event_type AS "Touch",
       "Order_ID", "Sale_Amount", "Lead_Source", "Start_Date", "Conversion_Status"
FROM people JOIN events ON user_id = "Customer_ID" JOIN sales USING ("Customer_ID")"""

#: The smaller side fills a cell with what it has, up to ten rows; the other gets the rest of 100.
GRIDS = """
WITH counts AS (
  SELECT user_id AS k, t, s, least(t, s, 10) AS few
  FROM (SELECT user_id, count(*) AS t FROM events GROUP BY user_id)
  JOIN (SELECT o_custkey, count(*) AS s FROM orders GROUP BY o_custkey) ON user_id = o_custkey)
SELECT k AS "Customer_ID",
       ceil(t / CASE WHEN t <= s THEN few ELSE least(t, floor(100 / few)) END)::BIGINT AS touch_axis,
       ceil(s / CASE WHEN t <= s THEN least(s, floor(100 / few)) ELSE few END)::BIGINT AS sale_axis
FROM counts WHERE t * s > 100"""

GAPPY = f"""{LEADS}, {MARKETING},
  gappy AS (
    SELECT leads.* EXCLUDE ("Sale_Amount"), "Touches", "Email_open_rate", "click_through_rate",
           CASE WHEN floor("Sale_Amount") % 10 <> 0 THEN "Sale_Amount" END AS "Sale_Amount"
    FROM leads LEFT JOIN marketing USING ("Customer_ID"))"""


def _imputed() -> str:
    """Discrete medians of the training leads; columns without a gap there are left alone."""
    columns = ("Sale_Amount", "Touches", "Email_open_rate", "click_through_rate")
    medians = ", ".join(f'quantile_disc("{c}", 0.5) AS "m_{c}"' for c in columns)
    filled = ", ".join(f'round(coalesce("{c}"::DOUBLE, "m_{c}"::DOUBLE), 6) AS "{c}", '
                       f'CASE WHEN "{c}" IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "{c}_missing"'
                       for c in columns)
    return f"""
WITH {GAPPY}, medians AS (SELECT {medians} FROM gappy WHERE split = 'train')
SELECT "Lead_ID", round("Account_Balance", 6) AS "Account_Balance", {filled} FROM gappy, medians"""


def _level_shares(*columns: str) -> str:
    return f"WITH {LEADS}" + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", "{c}" AS level, count(*) AS rows, round(avg(label), 6) AS label_mean, TRUE AS same
FROM leads WHERE split = 'train' GROUP BY "{c}" """ for c in columns)


#: Gradient sums at even odds; a leaf weighs -T(g) / (h + 1), T drawing g towards zero by five.
STUMP = f"""
WITH {SALES},
  x AS (SELECT "Order_ID", CASE "Conversion_Status" WHEN 'Converted' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS y,
               substr("Lead_Source", 1, 1)::DOUBLE AS urgency, month("Start_Date")::DOUBLE AS month FROM sales),
  total AS (SELECT sum(0.5::DOUBLE - y) AS g, 0.25::DOUBLE * count(*) AS h FROM x),
  cuts AS (
    SELECT 0 AS feature, e.v, sum(0.5::DOUBLE - y) AS gl, 0.25::DOUBLE * count(*) AS hl
    FROM (SELECT DISTINCT urgency AS v FROM x) e JOIN x ON urgency <= e.v GROUP BY e.v
    UNION ALL
    SELECT 1, e.v, sum(0.5::DOUBLE - y), 0.25::DOUBLE * count(*)
    FROM (SELECT DISTINCT month AS v FROM x) e JOIN x ON month <= e.v GROUP BY e.v),
  shrunk AS (
    SELECT feature, v, gl, hl, h - hl AS hr, h, greatest(abs(gl) - 5, 0) * sign(gl) AS tl,
           greatest(abs(g - gl) - 5, 0) * sign(g - gl) AS tr, greatest(abs(g) - 5, 0) * sign(g) AS t
    FROM cuts, total),
  best AS (
    SELECT * FROM (SELECT *, round((tl * tl / (hl + 1) + tr * tr / (hr + 1) - t * t / (h + 1)) / 2, 9) AS gain
                   FROM shrunk WHERE hl >= 1 AND hr >= 1)
    ORDER BY gain DESC, feature, v LIMIT 1)
SELECT "Order_ID", round(1 / (1 + exp(0.5::DOUBLE * CASE
         WHEN gain <= 0 THEN t / (h + 1)
         WHEN CASE feature WHEN 0 THEN urgency ELSE month END <= v THEN tl / (hl + 1)
         ELSE tr / (hr + 1) END)), 6) AS probability
FROM x, best"""


_ENCODED = ("Lead_Source", "Profession", "City", "Location")


def _target_encode(rows: str) -> str:
    stats = ",".join(f"""
  m_{c} AS (
    SELECT "{c}" AS level,
           prior + (avg(label) - prior) / (1 + exp(-(count(*) - 20.0::DOUBLE) / 10.0::DOUBLE)) AS enc
    FROM leads, prior WHERE {rows} GROUP BY "{c}", prior)""" for c in _ENCODED)
    picks = ", ".join(f'round(coalesce(m_{c}.enc, prior), 6) AS "{c}"' for c in _ENCODED)
    joins = " ".join(f'LEFT JOIN m_{c} ON leads."{c}" = m_{c}.level' for c in _ENCODED)
    return f"""
WITH {LEADS}, prior AS (SELECT avg(label) AS prior FROM leads WHERE {rows}), {stats}
SELECT leads."Lead_ID", {picks} FROM prior, leads {joins}"""


def _rformula() -> str:
    dummies = ", ".join(
        [f"CASE WHEN p.rank = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x{i}" for i in range(4)]
        + [f"CASE WHEN s.rank = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x{i + 4}"
           for i in range(4)])
    return f"""
WITH {LEADS}
SELECT "Lead_ID", {dummies}, "Account_Balance" AS x8, "Sale_Amount" AS x9,
       l.rank::DOUBLE AS label
FROM leads
JOIN {level_ranks('Profession')} p ON "Profession" = p.level
JOIN {level_ranks('Lead_Source')} s ON "Lead_Source" = s.level
JOIN {level_ranks('Conversion_Status')} l ON "Conversion_Status" = l.level
WHERE split = 'validation'"""


_LINEITEM = {
    "l_orderkey": 1, "l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 1,
    "l_extendedprice": 1, "l_discount": 1, "l_tax": 1, "l_returnflag": 0, "l_linestatus": 0,
    "l_shipdate": 0,
}


def _profile() -> str:
    def part(c: str, number: int) -> str:
        if number:
            rest = f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, " + ", ".join(
                f"quantile_disc({c}, {p / 100})::DOUBLE AS p{p}" for p in (25, 50, 75))
        else:
            rest = "NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev, " + ", ".join(
                f"NULL::DOUBLE AS p{p}" for p in (25, 50, 75))
        return (f"SELECT '{c}' AS \"column\", count({c}) AS \"values\", count(*) - count({c}) AS nulls, "
                f"count(DISTINCT {c}) AS \"distinct\", min({c})::VARCHAR AS min, "
                f"max({c})::VARCHAR AS max, {rest} FROM lineitem")
    return " UNION ALL ".join(part(c, n) for c, n in _LINEITEM.items())


_LEAD_TYPES = (
    ("Lead_ID", "bigint", "numeric"), ("Customer_ID", "bigint", "numeric"),
    ("Sale_Amount", "double", "numeric"), ("Lead_Source", "string", "categorical"),
    ("Start_Date", "timestamp_ntz", "temporal"), ("Conversion_Status", "string", "label"),
    ("Profession", "string", "categorical"), ("Account_Balance", "double", "numeric"),
    ("City", "string", "categorical"), ("Location", "string", "categorical"),
)
_TYPED = " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", '{t}' AS dtype, '{r}' AS role, "
    f"count(\"{c}\") AS \"values\" FROM leads" for i, (c, t, r) in enumerate(_LEAD_TYPES))


ORACLES: dict[str, str] = {
    "csv_scan_infer": "SELECT * FROM orders",
    "csv_scan_multiline": "SELECT * FROM documents",
    "csv_scan_split": "SELECT * FROM documents",
    "table_scan": "SELECT * FROM lineitem",
    "save_overwrite_roundtrip": "SELECT * FROM customer",
    "database_ddl": """SELECT o_orderpriority AS "Lead_Source", count(*) AS count
                       FROM orders GROUP BY 1""",
    "run_log_append": f"""
WITH {SWEPT},
  runs AS (SELECT *, 'rule_' || split AS run_name FROM swept WHERE split <> 'train'),
  {f1('runs', 'run_name', 'trial_id', 'threshold')}
SELECT run_name, trial_id::BIGINT AS trial_id, threshold, 'weighted_f1' AS metric,
       weighted_f1 AS value FROM f1""",
    "preview_rows": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "drop_columns": f"""WITH {SALES} SELECT * EXCLUDE ("Order_ID") FROM sales""",
    "drop_columns_lenient": f"""
WITH {LEADS}
SELECT "Sale_Amount", "Lead_Source", "Conversion_Status", "Profession", "Account_Balance", "City",
       "Location", 20::INTEGER AS absent FROM leads""",
    "select_distinct": "SELECT DISTINCT l_shipdate FROM lineitem",
    "rename_columns": f"WITH {MARKETING} SELECT * FROM marketing",
    "typed_columns": f"WITH {LEADS} {_TYPED}",
    "null_row_filter": f"""
WITH {SALES}, {MARKETING},
  complete AS (
    SELECT "Order_ID", "Customer_ID", strftime("Start_Date", '%Y-%m-%d') AS "Start_Day", "Touches",
           {bucket('"Customer_ID"')} AS bucket
    FROM sales LEFT JOIN marketing USING ("Customer_ID")
    WHERE "Touches" IS NOT NULL AND "Start_Date" IS NOT NULL)
SELECT "Order_ID", "Customer_ID", "Start_Day", "Touches" FROM complete
WHERE bucket >= 800 AND "Start_Day" IN (SELECT "Start_Day" FROM complete WHERE bucket < 600)""",
    "funnel_join_pair": f"WITH {PEOPLE} SELECT * FROM people",
    "funnel_join_chain": CHAIN,
    "funnel_join_heavy_keys": CHAIN,
    "funnel_join_touches": TOUCHES,
    "penalised_stump_scores": STUMP,
    "lr_level_means": _level_shares("Profession", "Lead_Source", "City", "Location"),
    "encoded_lr_level_means": _level_shares("Lead_Source", "City"),
    "lr_certificate": f"""
WITH {LEADS}
SELECT kind, count(*) AS rows, TRUE AS optimal
FROM leads, (VALUES ('logistic'), ('logistic_encoded')) AS k(kind) WHERE split = 'train' GROUP BY kind""",
    "forest_node_scores": f"""
WITH {LEADS}
SELECT split, count(*) AS scored, count(*) AS same FROM leads WHERE split <> 'train' GROUP BY split""",
    "forest_gain_importance": """
SELECT unnest(['Account_Balance', 'Sale_Amount', 'Profession', 'City', 'Location', 'Lead_Source']) AS feature,
       TRUE AS same""",
    "impute_features": _imputed(),
    "gappy_train_coverage": f"""
WITH {GAPPY}
SELECT kind, split, count(*) AS given, count(*) AS scored, 0::BIGINT AS skipped
FROM gappy, (VALUES ('logistic'), ('logistic_encoded'), ('forest'), ('boosted'), ('indexed_boosted')) AS k(kind)
WHERE split <> 'train' GROUP BY kind, split""",
    "funnel_join_touches_spread": TOUCHES,
    "hot_key_grids": GRIDS,
    "join_size": """
WITH joined AS (
  SELECT c_custkey AS k FROM customer JOIN events ON user_id = c_custkey
                                      JOIN orders ON o_custkey = c_custkey),
  keys AS (SELECT c_custkey AS k FROM customer UNION SELECT user_id FROM events
           UNION SELECT o_custkey FROM orders)
SELECT (SELECT count(*) FROM keys) AS distinct_keys,
       (SELECT count(DISTINCT k) FROM joined) AS joined_keys,
       (SELECT count(*) FROM joined)::DECIMAL(38, 0) AS joined_rows,
       (SELECT count(*) FROM customer) AS rows_0, (SELECT count(*) FROM events) AS rows_1,
       (SELECT count(*) FROM orders) AS rows_2,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey))
         AS max_rows_per_key_0,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM events GROUP BY user_id))
         AS max_rows_per_key_1,
       (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey))
         AS max_rows_per_key_2""",
    "table_shape": "SELECT count(*) AS rows, 11::INTEGER AS columns FROM lineitem",
    "drop_duplicates": "SELECT DISTINCT * FROM lineitem",
    "duplicate_audit": """
SELECT 2 * (SELECT count(*) FROM lineitem) AS rows, count(*) AS distinct_rows,
       2 * (SELECT count(*) FROM lineitem) - count(*) AS duplicate_rows
FROM (SELECT DISTINCT * FROM lineitem)""",
    "group_count": f"WITH {SCORED} SELECT prediction, count(*) AS count FROM scored GROUP BY 1",
    "funnel_effectiveness": f"""
WITH {SCORED}
SELECT count(*) AS scored_leads, count(*) FILTER (prediction = 0) AS predicted_converted,
       round(count(*) FILTER (prediction = 0) * 100.0::DOUBLE / count(*), 6) AS effectiveness
FROM scored""",
    "funnel_effectiveness_by_location": f"""
WITH {SCORED}
SELECT "Location", count(*) AS scored_leads,
       count(*) FILTER (prediction = 0) AS predicted_converted,
       round(count(*) FILTER (prediction = 0) * 100.0::DOUBLE / count(*), 6) AS effectiveness
FROM scored GROUP BY 1""",
    "column_profile": _profile(),
    "label_binarize": f'WITH {LEADS} SELECT "Lead_ID", "Conversion_Status", label FROM leads',
    "split_three_way": f'WITH {LEADS} SELECT "Lead_ID", "Customer_ID", split FROM leads',
    "target_encode": _target_encode("split = 'train'"),
    "target_encode_all_rows": _target_encode("true"),
    "rformula_encode": _rformula(),
    "standard_scale": f"""
WITH {LEADS},
  sd AS (SELECT stddev_samp("Account_Balance") AS a, stddev_samp("Sale_Amount") AS b
         FROM leads WHERE split = 'train')
SELECT "Lead_ID", round("Account_Balance" / a, 6) AS x0, round("Sale_Amount" / b, 6) AS x1
FROM leads, sd WHERE split = 'test'""",
    "string_index": f"""
WITH {LEADS}
SELECT "Lead_ID", "City", "Lead_Source", c.rank::DOUBLE AS "City_si",
       s.rank::DOUBLE AS "Lead_Source_si"
FROM leads JOIN {level_ranks('City')} c ON "City" = c.level
           JOIN {level_ranks('Lead_Source')} s ON "Lead_Source" = s.level
WHERE split = 'test'""",
    "wide_index": f"""
WITH {LEADS}
SELECT "Lead_ID", {', '.join(f"""coalesce((SELECT rank FROM {level_ranks(c)} r WHERE r.level = leads."{c}"),
       (SELECT count(DISTINCT "{c}") FROM leads WHERE split = 'train'))::DOUBLE AS "{c}_si" """ for c in INDEXED)}
FROM leads WHERE split = 'test'""",
    "wide_index_levels": " UNION ALL ".join(f"""
SELECT '{c}' AS "column", {c}::VARCHAR AS level, count(*) AS n,
       row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR) - 1 AS rank
FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}""" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")),
    "assemble_features": f"""
WITH {LEADS}
SELECT "Lead_ID", "Sale_Amount" AS x0, "Account_Balance" AS x1, label FROM leads""",
    "weighted_f1": f"WITH {SCORED}, {f1('scored')} SELECT rows, weighted_f1 FROM f1",
    "threshold_sweep": f"""
WITH {SWEPT}, {f1('swept', 'threshold')} SELECT threshold, rows, weighted_f1 FROM f1""",
    "model_save_load": f"""
WITH {LEADS}
SELECT count(*) AS scored, count(*) AS same, 2::BIGINT AS classes FROM leads WHERE split = 'test'""",
    "score_leads_stream": f"""
WITH {LEADS} SELECT count(*) AS scored, count(*) AS same, 2::BIGINT AS classes FROM leads""",
    "score_leads_deliveries": f"""
WITH {LEADS} SELECT "Lead_ID", 1::BIGINT AS model_version, true AS same FROM leads""",
}
