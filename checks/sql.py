"""The same results as SQL, for an independent engine to check.

``with_query`` prefixes a query with the common table expressions it names,
directly or through one another.
"""

from __future__ import annotations

import re

from sales_engine.functions.dates import DEFAULT_SEASON, SEASONS
from sales_engine.functions.geo import CONTINENT_BOXES, NO_CONTINENT
from sales_engine.schemas import CSV_SPEC, DB_SPEC, STORE_SENTINELS, STREAM_SPEC, CleanSpec

LOAD_TS = "2025-01-01 00:00:00"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _invalid(column: str, sentinels) -> str:
    return f"({column} IS NULL OR cast({column} AS varchar) IN ({_quoted(sentinels)}))"


def _dirty(value: str, modulus: int, sentinel: str, outlier: str | None = None) -> str:
    more = f"WHEN 4 THEN {outlier}" if outlier else ""
    return (
        f"CASE k % {modulus} WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN concat({value}, '_err') "
        f"WHEN 3 THEN '{sentinel}' {more} ELSE {value} END"
    )


_DATE = "cast(cast(l_shipdate AS date) AS varchar)"
_QTY = "cast(cast(l_quantity AS int) AS varchar)"
_REV = "cast(cast(l_extendedprice AS decimal(18,2)) AS varchar)"


def _keyed_sum(expr: str) -> str:
    return f"cast(sum(cast({expr} AS decimal(28,6))) AS double)"


def _revenue(alias: str = "total_revenue") -> str:
    return f"{_keyed_sum('revenue')} AS {alias}"


_UNITS = "cast(sum(quantity_Sold) AS bigint)"

_CTES = {
    "f_stores": """
        SELECT cast(s_suppkey AS varchar) AS store_ID, s_name AS store_name, n_name AS location,
               CASE WHEN s_suppkey % 17 = 0 THEN 'abcde' WHEN s_suppkey % 19 = 0 THEN NULL
                    ELSE concat('(', cast((n_nationkey * 7) % 131 - 50 AS varchar), '.5, ',
                                cast((n_nationkey * 29) % 341 - 170 AS varchar), '.25)') END AS demographics
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "f_stores_once": """
        SELECT CASE cast(store_ID AS int) % 13 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'STORE_ERROR'
                    WHEN 3 THEN concat(store_ID, '_err') ELSE store_ID END AS store_code,
               store_name, location, demographics
        FROM f_stores""",
    "f_stores_export": "SELECT * FROM f_stores_once UNION ALL SELECT * FROM f_stores_once",
    "f_lines": """
        SELECT *, l_orderkey * 31 + l_partkey * 7 + l_linenumber AS k FROM lineitem
        UNION ALL
        SELECT *, l_orderkey * 31 + l_partkey * 7 + l_linenumber AS k FROM lineitem WHERE l_orderkey % 50 = 0""",
    "f_csv": f"""
        SELECT {_dirty(_DATE, 13, 'DATE_ERROR')} AS "Date",
               {_dirty('cast(l_suppkey AS varchar)', 17, 'STORE_ERROR')} AS "StoreID",
               {_dirty('cast(l_partkey AS varchar)', 19, 'PRODUCT_ERROR')} AS "ProductID",
               {_dirty(_QTY, 23, 'QUANTITY_ERROR', "'999'")} AS "QuantitySold",
               {_dirty(_REV, 29, 'REVENUE_ERROR', f"concat('9', {_REV})")} AS "Revenue"
        FROM f_lines""",
    "f_db": """
        SELECT "Date" AS event_date, "StoreID" AS store_code, "ProductID" AS product_code,
               "QuantitySold" AS sold_units, "Revenue" AS total_sales
        FROM f_csv""",
    "f_stream": """
        SELECT CASE WHEN event_id % 23 <> 0 THEN cast(epoch_us(ts) // 1000 AS varchar) END AS "timestamp",
               CASE WHEN event_id % 11 <> 0 THEN cast(user_id % 100 AS int) END AS store_id,
               CASE event_id % 13 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE cast(event_id % 2000 AS varchar) END
                   AS product_id,
               CASE WHEN event_id % 17 <> 0 THEN cast(json_extract_string(props, '$.k') AS int) END
                   AS quantity_sold,
               CASE WHEN event_id % 19 <> 0 THEN value END AS revenue
        FROM events""",
    "coordinates": """
        SELECT store_ID, store_name, location, demographics,
               try_cast(substr(split_part(demographics, ',', 1), 2) AS double) AS latitude,
               CASE WHEN contains(demographics, ',') THEN
                   try_cast(left(split_part(demographics, ',', 2), length(split_part(demographics, ',', 2)) - 1)
                            AS double) END AS longitude
        FROM f_stores""",
    "continents": "SELECT *, CASE "
    + " ".join(
        f"WHEN latitude BETWEEN {a} AND {b} AND longitude BETWEEN {c} AND {d} THEN '{name}'"
        for name, (a, b), (c, d) in CONTINENT_BOXES
    )
    + f" ELSE '{NO_CONTINENT}' END AS continent FROM coordinates",
    "sales": """
        SELECT "Date" AS date, cast("StoreID" AS varchar) AS store_ID, "ProductID" AS product_ID,
               "QuantitySold" AS quantity_Sold, "Revenue" AS revenue, "Processed" AS Tratado,
               "Insert_Date" AS fecha_Insercion
        FROM csv_clean
        UNION ALL
        SELECT "timestamp", cast(store_id AS varchar), product_id, quantity_sold, revenue, "Processed",
               "Insertion_Date"
        FROM stream_clean""",
    "joined": """
        SELECT s.*, d.store_name, d.location, d.demographics
        FROM sales s JOIN f_stores d ON s.store_ID = d.store_ID""",
}


def _cleaning(name: str, source: str, spec: CleanSpec, text: bool) -> dict[str, str]:
    """The cleaning steps of one channel; ``text`` where its numbers arrive as text."""
    d, s, p, q, r = (f'"{c}"' for c in (spec.date, spec.store, spec.product, spec.quantity, spec.revenue))
    bad = {c: _invalid(c, spec.sentinels) for c in (d, s, p, q, r)}
    as_own_type = (lambda v: f"cast({v} AS varchar)") if text else (lambda v: v)
    number = {c: f"try_cast({c} AS double)" for c in (q, r)}

    def mean(c: str) -> str:
        return f"{_keyed_sum(number[c])} / count({number[c]})"

    def bounds(c: str, table: str) -> str:
        return (
            f"SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM ("
            f"SELECT quantile_disc({number[c]}, 0.25) AS q1, quantile_disc({number[c]}, 0.75) AS q3 FROM {table})"
        )

    def cut(c: str, table: str, limits: str) -> str:
        return f"SELECT t.* FROM {table} t, {limits} b WHERE {number[c]} BETWEEN b.low AND b.high"

    when = f"make_timestamp(try_cast({d} AS bigint) * 1000)" if spec.epoch_ms else f"try_cast({d} AS timestamp)"
    typed = f"""{when} AS {d}, try_cast({s} AS int) AS {s}, {p}, cast(trunc({number[q]}) AS int) AS {q},
               {number[r]} AS {r}"""
    return {
        f"{name}_mode": f"""
        SELECT {d}, count(*) AS n FROM {source} WHERE NOT {bad[d]} GROUP BY {d} ORDER BY n DESC, {d} LIMIT 1""",
        f"{name}_profile": f"""
        SELECT (SELECT {d} FROM {name}_mode) AS mode_date,
               cast(trunc({mean(q)}) AS bigint) AS mean_quantity, {mean(r)} AS mean_revenue
        FROM {source}""",
        f"{name}_flagged": f'SELECT *, ({bad[r]} OR {bad[q]} OR {bad[d]}) AS "{spec.processed}" FROM {source}',
        f"{name}_kept": f"SELECT * FROM {name}_flagged WHERE NOT {bad[s]} AND NOT {bad[p]}",
        f"{name}_filled": f"""
        SELECT CASE WHEN {bad[d]} THEN mode_date ELSE {d} END AS {d}, {s}, {p},
               CASE WHEN {bad[q]} THEN {as_own_type('mean_quantity')} ELSE {q} END AS {q},
               CASE WHEN {bad[r]} THEN {as_own_type('mean_revenue')} ELSE {r} END AS {r}, "{spec.processed}"
        FROM {name}_kept, {name}_profile""",
        f"{name}_unique": f"SELECT DISTINCT * FROM {name}_filled",
        f"{name}_quantity_bounds": bounds(q, f"{name}_unique"),
        f"{name}_quantity_cut": cut(q, f"{name}_unique", f"{name}_quantity_bounds"),
        f"{name}_revenue_bounds": bounds(r, f"{name}_quantity_cut"),
        f"{name}_revenue_cut": cut(r, f"{name}_quantity_cut", f"{name}_revenue_bounds"),
        f"{name}_typed": f"SELECT {typed} FROM {source}",
        f"{name}_clean": f"""
        SELECT {typed}, "{spec.processed}", cast('{LOAD_TS}' AS timestamp) AS "{spec.load_ts}"
        FROM {name}_revenue_cut""",
    }


_CTES |= _cleaning("csv", "f_csv", CSV_SPEC, text=True)
_CTES |= _cleaning("db", "f_db", DB_SPEC, text=True)
_CTES |= _cleaning("stream", "f_stream", STREAM_SPEC, text=False)


def with_query(query: str) -> str:
    """The query behind the expressions it needs, in an order each can refer back to."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _CTES:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(_CTES[name])
                order.append(name)

    need(query)
    parts = ",\n".join(f"{name} AS ({_CTES[name]})" for name in order)
    return f"WITH {parts}\n{query}" if parts else query


def _period(name: str, expr: str) -> str:
    return (
        f"SELECT {expr} AS {name}, {_revenue()}, {_UNITS} AS total_quantity_sold FROM joined GROUP BY 1"
    )


_SEASON = "CASE " + " ".join(
    f"WHEN month(date) IN ({', '.join(map(str, months))}) THEN '{label}'" for label, months in SEASONS.items()
) + f" ELSE '{DEFAULT_SEASON}' END"

_SALE = "date, store_ID, product_ID, quantity_Sold, revenue, Tratado, fecha_Insercion"

_CSV_NULLED = ", ".join(
    f"""nullif("{c}", '') AS "{c}" """ for c in ("Date", "StoreID", "ProductID", "QuantitySold", "Revenue")
)

QUERIES = {
    "land_csv_roundtrip": f"SELECT {_CSV_NULLED} FROM f_csv",
    "compact_json": "SELECT * FROM f_stream",
    "compact_new_batches": "SELECT * FROM f_stream UNION ALL SELECT * FROM f_stream",
    "stream_stop_restart": "SELECT * FROM f_stream",
    "repair_gap": "SELECT * FROM f_stream",
    "decode_json_events": """
        SELECT * FROM f_stream
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL FROM f_stream""",
    "stream_land_sales": "SELECT * FROM f_stream",
    "stream_land_compact_clean": "SELECT * FROM stream_clean",
    "mode_date": "SELECT * FROM csv_mode",
    "mode_timestamp": "SELECT * FROM stream_mode",
    "mode_store": """
        SELECT CAST(store_id AS VARCHAR) AS store_id, count(*) AS n FROM f_stream WHERE store_id IS NOT NULL
        GROUP BY ALL ORDER BY n DESC, CAST(store_id AS VARCHAR) LIMIT 1""",
    "profile_means": "SELECT mean_quantity, mean_revenue FROM csv_profile",
    "profile_stream": "SELECT * FROM stream_profile",
    "flag_processed": "SELECT * FROM csv_flagged",
    "require_keys": "SELECT * FROM csv_kept",
    "impute": "SELECT * FROM csv_filled",
    "dedupe_rows": "SELECT DISTINCT * FROM f_csv",
    "quartiles_approx": """
        SELECT * FROM (VALUES ('quantity', true, true), ('revenue', true, true)) AS t(measure, q1_within, q3_within)""",
    "clock_load_time": "SELECT cast(0 AS bigint) AS missing, cast(1 AS bigint) AS different",
    "quartiles": """
        SELECT 'quantity' AS measure, quantile_disc(try_cast("QuantitySold" AS double), 0.25) AS q1,
               quantile_disc(try_cast("QuantitySold" AS double), 0.75) AS q3 FROM f_csv
        UNION ALL
        SELECT 'revenue', quantile_disc(try_cast("Revenue" AS double), 0.25),
               quantile_disc(try_cast("Revenue" AS double), 0.75) FROM f_csv""",
    "iqr_quantity": "SELECT * FROM csv_quantity_cut",
    "iqr_revenue": "SELECT * FROM csv_revenue_cut",
    "cast_types": "SELECT * FROM csv_typed",
    "epoch_ms_to_ts": """
        SELECT "timestamp" AS epoch_ms, make_timestamp(cast("timestamp" AS bigint) * 1000) AS event_time
        FROM f_stream""",
    "clean_sales_csv": "SELECT * FROM csv_clean",
    "clean_sales_csv_lazy": "SELECT * FROM csv_clean",
    "clean_sales_csv_staged": "SELECT * FROM csv_clean",
    "clean_sales_stream": "SELECT * FROM stream_clean",
    "clean_sales_db": "SELECT * FROM db_clean",
    "clean_stores": f"""
        SELECT DISTINCT try_cast(store_code AS int) AS store_code, store_name, location, demographics,
               cast('{LOAD_TS}' AS timestamp) AS "Insert_Date"
        FROM f_stores_export WHERE NOT {_invalid('store_code', STORE_SENTINELS)}""",
    "parse_lat_lon": "SELECT store_ID, latitude, longitude FROM coordinates",
    "assign_continent": "SELECT store_ID, continent FROM continents",
    "conform_sales": """
        SELECT "Date" AS date, cast("StoreID" AS varchar) AS store_ID, "ProductID" AS product_ID,
               "QuantitySold" AS quantity_Sold, "Revenue" AS revenue, "Processed" AS Tratado,
               "Insert_Date" AS fecha_Insercion
        FROM csv_clean""",
    "union_channels": "SELECT * FROM sales",
    "enrich_sales": "SELECT * FROM joined",
    "enrich_sales_salted": "SELECT * FROM joined",
    "top_store": f"""
        SELECT store_ID, total_revenue, store_name, location, demographics
        FROM (SELECT store_ID, {_revenue()} FROM joined GROUP BY 1
              QUALIFY sum(cast(revenue AS decimal(28,6))) = max(sum(cast(revenue AS decimal(28,6)))) OVER ())
        JOIN f_stores USING (store_ID)""",
    "units_on_date": f"""
        SELECT date, {_UNITS} AS total_sold FROM sales WHERE date = timestamp '1998-08-23 00:00:00' GROUP BY date""",
    "top_product_sales": f"""
        SELECT product_ID, total_sold, date, store_ID, quantity_Sold, revenue, Tratado, fecha_Insercion
        FROM (SELECT product_ID, {_UNITS} AS total_sold FROM sales GROUP BY 1
              QUALIFY sum(quantity_Sold) = max(sum(quantity_Sold)) OVER ())
        JOIN sales USING (product_ID)""",
    "revenue_by_location": f"SELECT location, {_revenue()} FROM joined GROUP BY 1 ORDER BY 2 DESC, 1",
    "top_location": f"""
        SELECT location, total_revenue, store_ID, store_name, demographics
        FROM (SELECT location, {_revenue()} FROM joined GROUP BY 1
              QUALIFY sum(cast(revenue AS decimal(28,6))) = max(sum(cast(revenue AS decimal(28,6)))) OVER ())
        JOIN f_stores USING (location)""",
    "revenue_by_continent": f"""
        SELECT continent, {_revenue()}
        FROM joined JOIN (SELECT store_ID, continent FROM continents) USING (store_ID)
        GROUP BY 1 ORDER BY 1 DESC""",
    "sales_by_day": _period("date_only", "cast(date AS date)"),
    "sales_by_week": _period("week_of_year", "cast(weekofyear(date) AS int)"),
    "sales_by_month": _period("month", "cast(month(date) AS int)"),
    "sales_by_season": _period("season", _SEASON),
    "sales_by_day_preaggregated": _period("date_only", "cast(date AS date)"),
    "revenue_by_demographic": f"SELECT demographics, {_revenue()} FROM joined GROUP BY 1 ORDER BY 2 DESC, 1",
    "product_preference": f"""
        SELECT demographics, product_ID, {_revenue()} FROM joined GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2""",
    "top_product_per_demographic": f"""
        SELECT demographics, product_ID, {_revenue()} FROM joined GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY demographics
            ORDER BY sum(cast(revenue AS decimal(28,6))) DESC, product_ID) = 1""",
    "top_product_per_demographic_preaggregated": f"""
        SELECT demographics, product_ID, {_revenue()} FROM joined GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY demographics
            ORDER BY sum(cast(revenue AS decimal(28,6))) DESC, product_ID) = 1""",
}
