"""For each query the same result in plain SQL over the given tables, to check against.

Where possible the SQL takes another way than the query: a merge is stated by its outcome, a
refresh by the full computation.
"""

from __future__ import annotations

from ledgermill import fixed_values as fx
from ledgermill.plans import catalogue as cat
from ledgermill.sources import adapter

NINE = ", ".join(fx.BILLING_COLUMNS)
FLAT = ", ".join(cat.FLAT)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(map(_text, values))


def _contains_any(words) -> str:
    return " OR ".join(f"contains(upper(item_description), {_text(word)})" for word in words)


CATEGORY = (
    "CASE "
    + " ".join(f"WHEN {_contains_any(words)} THEN {_text(label)}" for words, label in fx.CATEGORY_RULES)
    + f" ELSE {_text(fx.OTHER_CATEGORY)} END"
)
TYPE_NAME = (
    "CASE billing_type "
    + " ".join(f"WHEN {_text(code)} THEN {_text(name)}" for code, name in fx.BILLING_TYPE_NAMES.items())
    + f" ELSE {_text(fx.OTHER_BILLING_TYPE)} END"
)

TABLES = {
    "order_lines": f"""
        SELECT l_orderkey, l_partkey, l_returnflag, l_linestatus, l_quantity, l_discount,
               CAST(l_quantity AS BIGINT) AS whole_qty,
               CAST(l_shipdate AS DATE) AS ship_day,
               (((l_partkey * 100 + CAST(l_quantity AS BIGINT)) * 100
                 + CAST(round(l_discount * 100) AS BIGINT)) * 100
                 + CAST(round(l_tax * 100) AS BIGINT)) * 10 + l_linenumber AS item,
               list_extract([{_list(adapter.WORDS)}], l_partkey % 8 + 1) || ' ' || p_name AS item_description,
               p_brand AS material_group
        FROM lineitem, part
        WHERE p_partkey = l_partkey""",
    "b": f"""
        SELECT l_orderkey AS billing_document, item,
               CASE WHEN l_returnflag || l_linestatus = 'AO' THEN 'ZXP' ELSE 'ZF2' END AS billing_type,
               CASE WHEN l_orderkey % 89 <> 0 THEN ship_day END AS billing_date,
               CASE WHEN l_orderkey % 83 = 0 THEN 0 - whole_qty ELSE whole_qty END AS billing_qty_in_sku,
               CASE WHEN l_orderkey % 79 <> 0
                    THEN CAST({adapter.MATERIAL_OFFSET} + l_partkey AS VARCHAR) END AS material,
               item_description, material_group, l_orderkey AS assignment
        FROM order_lines
        UNION ALL
        SELECT l_orderkey + {adapter.RETURN_OFFSET}, item,
               CASE l_linestatus WHEN 'F' THEN 'ZRE' ELSE 'S1' END, ship_day,
               CAST(floor(l_quantity * l_discount * 10) AS BIGINT),
               CAST({adapter.MATERIAL_OFFSET} + l_partkey AS VARCHAR),
               item_description, material_group, l_orderkey
        FROM order_lines WHERE l_returnflag = 'R'""",
    "silver": f"""
        SELECT *, {CATEGORY} AS product_category, strftime(billing_date, '%Y-%m') AS year_month,
               coalesce(
                   if(billing_document IS NULL, 'MISSING_DOC_ID', NULL),
                   if(billing_date IS NULL, 'INVALID_DATE', NULL),
                   if(coalesce(billing_qty_in_sku, -1) < 0, 'INVALID_QUANTITY', NULL),
                   if(material IS NULL, 'MISSING_MATERIAL', NULL),
                   'VALID') AS data_quality_flag
        FROM b""",
    "returned": """
        SELECT assignment, material, item_description, CAST(sum(billing_qty_in_sku) AS BIGINT) AS return_qty
        FROM silver WHERE billing_type IN ('ZRE', 'S1')
        GROUP BY ALL""",
    "netted": f"""
        SELECT {", ".join("s." + name for name in fx.BILLING_COLUMNS)},
               coalesce(r.return_qty, 0) AS return_qty,
               s.billing_qty_in_sku - coalesce(r.return_qty, 0) AS final_qty
        FROM silver s LEFT JOIN returned r
          ON (s.billing_document, s.material, s.item_description) = (r.assignment, r.material, r.item_description)
        WHERE s.data_quality_flag = 'VALID'""",
    "gold": """
        SELECT *, if(final_qty = 0, return_qty, final_qty) AS t_final_amount
        FROM netted WHERE billing_type = 'ZF2'""",
    "pairs": f"""
        SELECT {", ".join("s." + name for name in fx.BILLING_COLUMNS)},
               s.billing_qty_in_sku - coalesce(r.billing_qty_in_sku, 0) AS final_qty
        FROM (SELECT * FROM b WHERE billing_type = 'ZF2') s
        LEFT JOIN (SELECT * FROM b WHERE billing_type IN ('ZRE', 'S1')) r
          ON (s.billing_document, s.material, s.item_description) = (r.assignment, r.material, r.item_description)""",
    "returned_by_type": """
        SELECT assignment, material, item_description, count(*) AS n_returns,
               CAST(sum(billing_qty_in_sku) FILTER (WHERE billing_type = 'ZRE') AS BIGINT) AS zre_bq,
               CAST(sum(billing_qty_in_sku) FILTER (WHERE billing_type = 'S1') AS BIGINT) AS s1_bq
        FROM b WHERE billing_type IN ('ZRE', 'S1') AND material IS NOT NULL GROUP BY ALL""",
    "net_lines": f"""
        SELECT {", ".join("s." + name for name in fx.BILLING_COLUMNS)}, coalesce(n_returns, 0) AS n_returns, zre_bq, s1_bq,
               s.billing_qty_in_sku - coalesce(zre_bq, 0) - coalesce(s1_bq, 0) AS final_qty
        FROM b s LEFT JOIN returned_by_type r
          ON s.billing_document = r.assignment AND s.material = r.material AND s.item_description = r.item_description
        WHERE s.billing_type = 'ZF2'""",
    "one_per_line": """
        SELECT b.billing_document, b.item, b.billing_date, b.billing_qty_in_sku, b.material, b.billing_type,
               b.assignment, n.final_qty
        FROM b LEFT JOIN (SELECT billing_document, item, CAST(sum(final_qty) AS BIGINT) AS final_qty FROM net_lines GROUP BY ALL) n
          ON n.billing_document = b.billing_document AND n.item = b.item""",
    "enriched": """
        SELECT b.billing_document, b.item, b.billing_date, b.billing_qty_in_sku, b.material, b.billing_type,
               b.assignment, p.final_qty
        FROM b LEFT JOIN pairs p ON p.billing_document = b.billing_document AND p.item = b.item""",
    "products": """
        SELECT material, item_description, material_group, product_category
        FROM silver WHERE material IS NOT NULL
        QUALIFY row_number() OVER (
            PARTITION BY material
            ORDER BY billing_date DESC NULLS LAST, item_description, material_group, product_category) = 1""",
    "types": f"""
        SELECT billing_type, {TYPE_NAME} AS billing_type_desc FROM (SELECT DISTINCT billing_type FROM silver)""",
    "days": """
        SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter, month(date_key) AS month,
               strftime(date_key, '%b') AS month_name, week(date_key) AS week, day(date_key) AS day,
               strftime(date_key, '%a') AS day_name, strftime(date_key, '%Y-%m') AS year_month
        FROM (SELECT DISTINCT billing_date AS date_key FROM silver WHERE billing_date IS NOT NULL)""",
    "dash": """
        SELECT billing_document, item, d.year_month, billing_type_desc, product_category, p.material_group,
               billing_qty_in_sku, return_qty, final_qty, t_final_amount
        FROM gold g
        JOIN days d ON d.date_key = g.billing_date
        JOIN types USING (billing_type)
        JOIN products p USING (material)""",
    "by_date": """
        SELECT date_key, year, quarter, month, month_name, year_month,
               count(DISTINCT billing_document) AS total_documents,
               CAST(sum(final_qty) AS BIGINT) AS total_final_qty,
               CAST(sum(t_final_amount) AS BIGINT) AS total_final_amount
        FROM gold JOIN days ON date_key = billing_date GROUP BY ALL""",
    "by_product": """
        SELECT material, p.item_description, p.product_category, p.material_group,
               count(DISTINCT billing_document) AS total_documents,
               CAST(sum(final_qty) AS BIGINT) AS total_final_qty,
               CAST(sum(t_final_amount) AS BIGINT) AS total_final_amount
        FROM gold JOIN products p USING (material) GROUP BY ALL""",
    "months": """
        SELECT DISTINCT year_month FROM dash ORDER BY year_month DESC LIMIT 3""",
    "feed": f"""
        SELECT *, 'DELETE' AS action, billing_document % 10 = 2 AS is_update
        FROM b WHERE billing_document % 10 IN (1, 2)
        UNION ALL
        SELECT * REPLACE (CAST(billing_qty_in_sku + CASE billing_document % 10 WHEN 2 THEN 1 WHEN 4 THEN 100 ELSE 0 END
                               AS BIGINT) AS billing_qty_in_sku),
               'INSERT', billing_document % 10 = 2
        FROM b WHERE billing_document % 10 IN (2, 3, 4)""",
    "after": """
        SELECT * REPLACE (CAST(billing_qty_in_sku + if(billing_document % 10 = 2, 1, 0) AS BIGINT) AS billing_qty_in_sku)
        FROM b WHERE billing_document % 10 <> 1""",
    "after_gold": """
        SELECT s.*, coalesce(r.return_qty, 0) AS return_qty, s.billing_qty_in_sku - coalesce(r.return_qty, 0) AS final_qty
        FROM after s LEFT JOIN (
            SELECT assignment, material, item_description, sum(billing_qty_in_sku) AS return_qty
            FROM after WHERE billing_type IN ('ZRE', 'S1') GROUP BY ALL
        ) r ON s.billing_document = r.assignment AND s.material = r.material AND s.item_description = r.item_description
        WHERE s.billing_type = 'ZF2' AND s.billing_date IS NOT NULL AND s.billing_qty_in_sku >= 0 AND s.material IS NOT NULL""",
    "mended": """
        SELECT * REPLACE (CASE WHEN billing_document % 10 > 6 AND billing_type = 'ZF2' THEN 600 ELSE billing_qty_in_sku END
                          AS billing_qty_in_sku)
        FROM b WHERE billing_document % 10 NOT BETWEEN 4 AND 6""",
    "mended_gold": """
        SELECT s.billing_qty_in_sku, coalesce(r.return_qty, 0) AS return_qty
        FROM mended s LEFT JOIN (
            SELECT assignment, material, item_description, sum(billing_qty_in_sku) AS return_qty
            FROM mended WHERE billing_type IN ('ZRE', 'S1') GROUP BY ALL
        ) r ON s.billing_document = r.assignment AND s.material = r.material AND s.item_description = r.item_description
        WHERE s.billing_type = 'ZF2' AND s.billing_date IS NOT NULL AND s.billing_qty_in_sku >= 0 AND s.material IS NOT NULL""",
}

PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in TABLES.items())


def _sql(body: str) -> str:
    return f"{PREFIX}\n{body}"


def _counts(*layers: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, count(*) AS n_rows FROM {table}" for layer, table in layers
    )


LAYERS = (
    ("bronze", "b"),
    ("silver", "silver"),
    ("gold", "gold"),
    ("fact_sales", "gold"),
    ("dim_product", "products"),
    ("dim_billing_type", "types"),
    ("dim_date", "days"),
)
FACT = "billing_document, item, billing_date, billing_qty_in_sku, material, billing_type, assignment"
ANY_COLUMN = " OR ".join(
    f"coalesce(regexp_matches(CAST({name} AS VARCHAR), {_text(cat.SEARCH_TERM)}, 'i'), false)"
    for name in (
        "billing_document",
        "item",
        "year_month",
        "billing_type_desc",
        "product_category",
        "material_group",
        "billing_qty_in_sku",
        "return_qty",
        "final_qty",
        "t_final_amount",
    )
)
BY_HAND = ", ".join(f"({_text(row[2])}, {row[4]})" for row in cat.HAND_ENTERED)
CHANGED = "SELECT billing_document, item FROM feed"

COUNTERPARTS: dict[str, str] = {
    "null_tokens": """
        SELECT p_partkey, if(p_partkey % 10 IN (1, 2, 3), NULL, p_brand) AS p_brand FROM part""",
    "typed_ingest": _sql(f"SELECT {NINE} FROM b"),
    "csv_round_trip": _sql(f"SELECT {NINE} FROM b"),
    "quarantine_rows": _sql(
        "SELECT billing_document, item, 'billing_qty_in_sku' AS reason FROM b WHERE assignment % 50 = 0"
    ),
    "new_files_only": _sql(
        f"""SELECT DISTINCT coalesce(strftime(billing_date, '%Y-%m'), 'undated') AS month FROM b
            WHERE billing_date IS NULL OR billing_date >= DATE '{cat.LEDGER_END}'"""
    ),
    "batch_summary": _sql(
        f"""SELECT CAST({fx.FIRST_BATCH_ID} + if(billing_type IN ('ZRE', 'S1'), 1, 0) AS BIGINT) AS batch_id, count(*) AS n_rows
            FROM b GROUP BY 1"""
    ),
    "append_rows": _sql(
        f"""SELECT billing_type, count(*) AS n_rows, CAST(sum(billing_qty_in_sku) AS BIGINT) AS total_qty
            FROM (SELECT billing_type, billing_qty_in_sku FROM b UNION ALL VALUES {BY_HAND}) GROUP BY 1"""
    ),
    "evolve_schema": _sql(
        """SELECT billing_type, count(*) AS n_rows, count(*) - count(final_qty) AS n_null_final
           FROM (SELECT billing_type, NULL AS final_qty FROM b UNION ALL SELECT billing_type, final_qty FROM gold)
           GROUP BY 1"""
    ),
    "layer_row_counts": _sql(_counts(*LAYERS)),
    "raw_extract": _sql(f"SELECT {NINE} FROM b"),
    "rename_prefix": _sql("SELECT " + ", ".join(f"{name} AS z3_{name}" for name in fx.BILLING_COLUMNS) + " FROM b"),
    "filter_and": _sql(
        f"""SELECT {FLAT} FROM b
            WHERE billing_type = 'ZF2' AND material_group = 'Brand#13' AND billing_qty_in_sku = 20"""
    ),
    "filter_in": _sql(f"SELECT {FLAT} FROM b WHERE billing_type IN ('ZRE', 'S1')"),
    "null_count": _sql("SELECT count(*) AS n_rows, count(*) - count(final_qty) AS n_null_final FROM enriched"),
    "update_where": _sql(
        """SELECT billing_document, item,
                  if(billing_type = 'ZF2' AND material_group = 'Brand#13', 600, billing_qty_in_sku) AS billing_qty_in_sku
           FROM b"""
    ),
    "delete_where": _sql(
        """SELECT billing_document, item, billing_qty_in_sku FROM b
           WHERE billing_date IS NULL OR billing_date >= DATE '1999-01-01'"""
    ),
    "product_category": _sql("SELECT billing_document, item, product_category FROM silver"),
    "data_quality_flag": _sql("SELECT billing_document, item, year_month, data_quality_flag FROM silver"),
    "billing_type_desc": _sql(f"SELECT billing_document, item, {TYPE_NAME} AS billing_type_desc FROM b"),
    "final_amount": _sql("SELECT billing_document, item, t_final_amount FROM gold"),
    "dq_summary": _sql("SELECT data_quality_flag, count(*) AS record_count FROM silver GROUP BY 1"),
    "returns_agg": _sql("SELECT * FROM returned"),
    "gold_netout": _sql("SELECT * FROM gold"),
    "gold_pairwise": _sql("SELECT * FROM net_lines"),
    "gold_priority": _sql(
        f"""SELECT {", ".join("c." + name for name in fx.BILLING_COLUMNS)}, r.zre_bq, r.s1_bq,
                   c.billing_qty_in_sku - coalesce(r.zre_bq, r.s1_bq, 0) AS final_quantity
            FROM (SELECT DISTINCT {NINE} FROM b) c
            LEFT JOIN (SELECT assignment, material, CAST(sum(zre_bq) AS BIGINT) AS zre_bq,
                              CAST(sum(s1_bq) AS BIGINT) AS s1_bq FROM returned_by_type GROUP BY ALL) r
              ON r.assignment = c.billing_document AND r.material = c.material
            WHERE c.billing_type = 'ZF2' OR r.assignment IS NOT NULL"""
    ),
    "affected_invoices": _sql(
        f"""SELECT billing_document, item FROM b i
            WHERE billing_type = 'ZF2'
              AND (EXISTS (FROM feed f WHERE f.billing_document = i.billing_document AND f.item = i.item)
                OR EXISTS (FROM feed f WHERE f.billing_type IN ('ZRE', 'S1') AND f.assignment = i.billing_document
                             AND f.material = i.material AND f.item_description = i.item_description))"""
    ),
    "unmatched_returns": _sql(
        """SELECT billing_document, item FROM silver r
           WHERE billing_type IN ('ZRE', 'S1')
             AND NOT EXISTS (FROM gold g WHERE g.billing_document = r.assignment AND g.material = r.material
                               AND g.item_description = r.item_description)"""
    ),
    "fk_orphans": _sql(
        "SELECT material, count(*) AS n_rows FROM gold WHERE CAST(material AS BIGINT) % 2 = 1 GROUP BY 1"
    ),
    "pk_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "dim_product": _sql("SELECT * FROM products"),
    "dim_product_upsert": _sql("SELECT * FROM products"),
    "dim_billing_type": _sql("SELECT * FROM types"),
    "dim_date": _sql("SELECT * FROM days"),
    "dim_insert_only": _sql(
        """SELECT * REPLACE (if(CAST(material AS BIGINT) % 2 = 0, 'kept', product_category) AS product_category)
           FROM products"""
    ),
    "fact_sales": _sql(f"SELECT {FACT}, return_qty, final_qty, t_final_amount FROM gold"),
    "fact_left_enrich": _sql("SELECT * FROM one_per_line"),
    "fact_append_once": _sql(
        """SELECT 1001 + billing_document % 2 AS batch_id, count(*) AS n_rows,
                  CAST(sum(final_qty) AS BIGINT) AS total_final_qty
           FROM gold GROUP BY 1"""
    ),
    "update_from": _sql(
        f"""SELECT {FACT}, (SELECT final_qty FROM gold g
                            WHERE g.billing_document = b.billing_document AND g.item = b.item) AS final_qty
            FROM b"""
    ),
    "sales_dashboard": _sql("SELECT * FROM dash"),
    "sales_by_billing_type": _sql(
        """SELECT billing_type, billing_type_desc, count(DISTINCT billing_document) AS total_documents,
                  CAST(sum(billing_qty_in_sku) AS BIGINT) AS total_quantity,
                  CAST(sum(return_qty) AS BIGINT) AS total_returns,
                  CAST(sum(final_qty) AS BIGINT) AS total_final_qty,
                  CAST(sum(t_final_amount) AS BIGINT) AS total_final_amount
           FROM gold JOIN types USING (billing_type) GROUP BY ALL"""
    ),
    "sales_by_product": _sql("SELECT * FROM by_product"),
    "sales_by_date": _sql("SELECT * FROM by_date"),
    "billing_teams": _sql(
        "SELECT billing_type, CAST(sum(final_qty) AS BIGINT) AS total_final_qty FROM enriched GROUP BY 1"
    ),
    "material_teams": _sql(
        "SELECT material, CAST(sum(final_qty) AS BIGINT) AS total_final_qty FROM enriched GROUP BY 1"
    ),
    "distinct_categories": _sql("SELECT DISTINCT product_category FROM silver"),
    "top_products": _sql("SELECT * FROM by_product ORDER BY total_final_qty DESC, material LIMIT 10"),
    "latest_dates": _sql("SELECT * FROM by_date ORDER BY date_key DESC LIMIT 30"),
    "approx_percentile_qty": _sql("SELECT quantile_disc(billing_qty_in_sku, 0.7) AS value FROM b"),
    "approx_distinct_docs": _sql("SELECT count(DISTINCT billing_document) AS n_exact, true AS within_error FROM b"),
    "approx_distinct_merged": _sql("SELECT count(DISTINCT billing_document) AS n_exact, true AS within_error FROM b"),
    "approx_top_materials": _sql(
        """SELECT CAST(row_number() OVER (ORDER BY n DESC, material) AS INTEGER) AS place, n AS n_exact, true AS within_error
           FROM (SELECT material, count(*) AS n FROM b WHERE material IS NOT NULL GROUP BY 1 ORDER BY n DESC, material LIMIT 3)"""
    ),
    "quantity_ranks": _sql(
        """SELECT final_qty, count(*) AS n_rows,
                  CAST(coalesce(sum(count(*)) OVER (ORDER BY final_qty NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1
                       AS BIGINT) AS first_place
           FROM one_per_line GROUP BY 1"""
    ),
    "quantity_order": _sql(
        """SELECT billing_document, item, final_qty,
                  row_number() OVER (ORDER BY final_qty NULLS LAST, billing_document, item NULLS FIRST) AS place
           FROM one_per_line"""
    ),
    "top_k_documents": _sql(
        "SELECT billing_document, count(*) AS n FROM b GROUP BY 1 ORDER BY n DESC, billing_document LIMIT 3"
    ),
    "snapshot_diff": _sql(f"SELECT {FLAT}, action, is_update FROM feed WHERE billing_document % 10 <> 4"),
    "diff_by_digests": _sql(
        """SELECT billing_document, item, billing_type, unnest([billing_qty_in_sku, billing_qty_in_sku + 1]) AS billing_qty_in_sku,
                  unnest(['DELETE', 'INSERT']) AS action, true AS is_update
           FROM b WHERE billing_document % 997 = 5"""
    ),
    "net_changes": _sql(
        f"SELECT {FLAT}, action, is_update FROM feed WHERE NOT (action = 'DELETE' AND is_update)"
    ),
    "change_counts": _sql("SELECT action, is_update, count(*) AS n FROM feed GROUP BY 1, 2"),
    "merge_cdc": _sql(f"SELECT {FLAT} FROM after"),
    "merge_cdc_overwrite": _sql(
        f"""SELECT {FLAT} FROM
            (SELECT * REPLACE (CAST(billing_qty_in_sku + if(billing_document % 10 = 4, 100, 0) AS BIGINT)
                               AS billing_qty_in_sku) FROM after)"""
    ),
    "merge_upsert": _sql(
        f"""SELECT {FLAT} FROM b
            WHERE billing_document % 10 <> 3 AND (billing_document % 10 NOT IN (2, 4) OR material IS NULL)
            UNION ALL
            SELECT {FLAT} FROM feed WHERE action = 'INSERT'"""
    ),
    "gold_refreshed": _sql(
        f"""SELECT * EXCLUDE (amount), if(final_qty = 0, return_qty, final_qty) AS t_final_amount FROM (
              SELECT {", ".join("s." + name for name in fx.BILLING_COLUMNS)},
                     CAST(coalesce(r.amount, 0) AS BIGINT) AS return_qty,
                     CAST(s.billing_qty_in_sku - coalesce(r.amount, 0) AS BIGINT) AS final_qty, r.amount
              FROM after s LEFT JOIN (
                  SELECT assignment, material, item_description, sum(billing_qty_in_sku) AS amount
                  FROM after WHERE billing_type IN ('ZRE', 'S1') GROUP BY ALL) r
                ON s.billing_document = r.assignment AND s.material = r.material
               AND s.item_description = r.item_description
              WHERE s.billing_type = 'ZF2' AND s.billing_date IS NOT NULL AND s.billing_qty_in_sku >= 0
                AND s.material IS NOT NULL)"""
    ),
    "run_report": _sql(
        "SELECT layer AS step, n_rows, 'done' AS status FROM ("
        + _counts(*LAYERS)
        + ") UNION ALL SELECT 'views', NULL, 'done'"
    ),
    "reset_report": _sql("SELECT layer, n_rows AS rows_deleted, 0 AS rows_left FROM (" + _counts(*LAYERS) + ")"),
    "load_twice": _sql(_counts(*LAYERS)),
    "quarantine_run": _sql(
        """SELECT unnest(['bronze', 'silver', 'quarantine']) AS step, unnest([good, good, bad]) AS n_rows
           FROM (SELECT count(*) FILTER (WHERE assignment % 50 <> 0) AS good,
                        count(*) FILTER (WHERE assignment % 50 = 0) AS bad FROM b)"""
    ),
    "edited_layers": _sql(
        """SELECT layer, count(*) AS n_rows, CAST(sum(billing_qty_in_sku) AS BIGINT) AS quantity
           FROM after, (VALUES ('silver'), ('gold'), ('fact_sales')) layers(layer)
           WHERE layer = 'silver'
              OR billing_type = 'ZF2' AND billing_date IS NOT NULL AND billing_qty_in_sku >= 0 AND material IS NOT NULL
           GROUP BY layer"""
    ),
    "late_and_replaced": _sql(
        """SELECT unnest(['first', 'first', 'late', 'late', 'replaced', 'replaced', 'renamed', 'renamed', 'forced', 'forced']) AS step,
                  unnest(['bronze', 'silver', 'bronze', 'silver', 'bronze', 'silver', 'bronze', 'silver', 'bronze', 'silver']) AS layer,
                  unnest([f, f, f + l, f + l, f + l + r, f + l + r, f + l + r, f + l + r, f + 2 * l + 2 * r, f + l + r]) AS n_rows
           FROM (SELECT count(*) FILTER (WHERE billing_document % 10 < 4) AS f,
                        count(*) FILTER (WHERE billing_document % 10 BETWEEN 4 AND 5) AS l,
                        count(*) FILTER (WHERE billing_document % 10 BETWEEN 6 AND 8) AS r FROM b)"""
    ),
    "edited_batches": _sql(
        """SELECT unnest(['bronze', 'silver']) AS layer, count(*) AS n_rows, CAST(sum(billing_qty_in_sku) AS BIGINT) AS quantity,
                  CAST(NULL AS BIGINT) AS returned FROM mended
           UNION ALL
           SELECT unnest(['gold', 'fact_sales']), count(*), CAST(sum(billing_qty_in_sku) AS BIGINT), CAST(sum(return_qty) AS BIGINT)
           FROM mended_gold"""
    ),
    "any_order": _sql(
        """SELECT billing_document % 10 AS digit, count(*) AS n_rows,
                  CAST(sum(billing_qty_in_sku + if(billing_document % 10 IN (1, 2), 5, 0)) AS BIGINT) AS quantity
           FROM b WHERE billing_document % 10 <> 3 GROUP BY 1"""
    ),
    "kept_views": _sql(
        """SELECT label.by AS by, label.key AS key, count(DISTINCT billing_document) AS n_documents,
                  CAST(sum(billing_qty_in_sku) AS BIGINT) AS billed, CAST(sum(return_qty) AS BIGINT) AS returned,
                  CAST(sum(final_qty) AS BIGINT) AS net, CAST(sum(if(final_qty = 0, return_qty, final_qty)) AS BIGINT) AS amount
           FROM (
               SELECT g.*, unnest([
                   {'by': 'billing_type', 'key': billing_type}, {'by': 'material', 'key': g.material},
                   {'by': 'date_key', 'key': strftime(billing_date, '%Y-%m-%d')},
                   {'by': 'year_month', 'key': strftime(billing_date, '%Y-%m')}, {'by': 'all', 'key': ''},
                   {'by': 'product_category', 'key': p.product_category}, {'by': 'material_group', 'key': p.material_group}
               ]) AS label
               FROM after_gold g JOIN products p USING (material)
           ) GROUP BY 1, 2"""
    ),
    "kept_sketches": _sql(
        "SELECT count(DISTINCT billing_document) AS n_exact, true AS distinct_ok, true AS quantile_ok, true AS top_ok FROM b"
    ),
    "small_batch": _sql(
        """SELECT material, item_description, material_group, product_category, n_rows, returned, remaining
           FROM products LEFT JOIN (
               SELECT material, count(*) AS n_rows, CAST(sum(return_qty) AS BIGINT) AS returned,
                      CAST(sum(final_qty) AS BIGINT) AS remaining
               FROM gold GROUP BY 1) USING (material)"""
    ),
    "empty_run": _sql(
        f"""SELECT 'bronze' AS step, unnest([count(*), 0]) AS n_rows, unnest(['done', 'skipped']) AS status,
                   CAST({fx.FIRST_BATCH_ID} AS BIGINT) AS newest FROM b"""
    ),
    "rows_per_file": _sql(
        "SELECT billing_type, CAST(1007 AS BIGINT) AS batch_id, count(*) AS n_rows, 1 AS n_files FROM b GROUP BY 1"
    ),
    "stream_refresh": _sql(_counts(*LAYERS)),
    "dash_filter": _sql(
        f"""SELECT * FROM dash
            WHERE year_month IN ({_list(cat.DASH_MONTHS)}) AND product_category IN ({_list(cat.DASH_CATEGORIES)})
              AND billing_type_desc IN ({_list(cat.DASH_TYPES)})"""
    ),
    "last3_months": _sql("SELECT * FROM months"),
    "dash_default": _sql("SELECT * FROM dash WHERE year_month IN (FROM months)"),
    "kpis": _sql(
        """SELECT *, if(total_qty > 0, CAST(total_returns AS DOUBLE) / CAST(total_qty AS DOUBLE) * 100, 0) AS return_rate_pct
           FROM (SELECT count(DISTINCT billing_document) AS total_documents,
                        CAST(sum(billing_qty_in_sku) AS BIGINT) AS total_qty,
                        CAST(sum(return_qty) AS BIGINT) AS total_returns,
                        CAST(sum(final_qty) AS BIGINT) AS final_qty FROM dash)"""
    ),
    "sales_trend": _sql(
        f"SELECT date_key, total_final_qty FROM by_date WHERE year_month IN ({_list(cat.DASH_MONTHS)})"
    ),
    "billing_type_share": _sql(
        """SELECT billing_type_desc, total_qty,
                  CAST(total_qty AS DOUBLE) / CAST((sum(total_qty) OVER ()) AS DOUBLE) AS share
           FROM (SELECT if(billing_type = 'ZXP', 'Other', billing_type_desc) AS billing_type_desc,
                        CAST(sum(final_qty) AS BIGINT) AS total_qty
                 FROM netted JOIN types USING (billing_type) GROUP BY 1)"""
    ),
    "category_sales": _sql(
        """SELECT product_category, CAST(sum(final_qty) AS BIGINT) AS total_qty,
                  count(DISTINCT billing_document) AS total_docs FROM dash GROUP BY 1"""
    ),
    "monthly_sales": _sql(
        """SELECT year_month, CAST(sum(billing_qty_in_sku) AS BIGINT) AS billing_qty,
                  CAST(sum(return_qty) AS BIGINT) AS returns, CAST(sum(final_qty) AS BIGINT) AS final_qty,
                  count(DISTINCT billing_document) AS documents FROM dash GROUP BY 1"""
    ),
    "material_group_sales": _sql(
        """SELECT material_group, CAST(sum(final_qty) AS BIGINT) AS total_qty,
                  count(DISTINCT billing_document) AS total_docs FROM dash GROUP BY 1"""
    ),
    "search_rows": _sql(f"SELECT * FROM dash WHERE {ANY_COLUMN}"),
    "detail_rows": _sql(
        """SELECT * FROM dash
           ORDER BY billing_document, item, year_month, billing_type_desc, product_category, material_group,
                    billing_qty_in_sku, return_qty, final_qty, t_final_amount LIMIT 100"""
    ),
    "detail_counts": _sql(
        f"""SELECT least(count(*) FILTER (WHERE {ANY_COLUMN}), 100) AS shown_records, count(*) AS total_records,
                   count(DISTINCT material_group) AS unique_material_groups FROM dash"""
    ),
    "convert_tz": "SELECT event_id, ts + INTERVAL '5 hours 30 minutes' AS ts_ist FROM events",
    "last_24h": """
        SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
}
