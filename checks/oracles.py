"""SQL for the queries, for an engine that is not Spark."""

from __future__ import annotations

from checks.literals import DEVICE, RATES, REGION, STATUS, TYPES, XTS_RATE


def values(entries: list[tuple[str, str]], name: str) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in entries)
    return f"{name}(k, v) AS (VALUES {rows})"


RAW = """raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'direct'
      ELSE 'k-site' || (o_orderkey % 5) || '_d-' ||
        CASE o_orderkey % 4 WHEN 0 THEN 'm' WHEN 1 THEN 'd' WHEN 2 THEN 't' ELSE 'x' END
        || '_p-' || o_custkey END AS conversion_key,
    CAST(o_custkey AS VARCHAR) AS accommodation,
    CASE o_orderkey % 7 WHEN 0 THEN 'stayed' WHEN 1 THEN 'booked'
      WHEN 2 THEN 'cancelled_by_guest' WHEN 3 THEN 'no_show' WHEN 4 THEN NULL
      ELSE o_orderstatus END AS status,
    CASE c_nationkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
      WHEN 3 THEN 'JPY' WHEN 4 THEN 'XTS' END AS currency,
    CAST(o_orderdate AS DATE) AS check_in_date,
    CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS check_out_date,
    o_totalprice AS amount,
    CAST(o_totalprice AS DECIMAL(18,2)) AS revenue,
    CASE o_orderkey % 3 WHEN 0 THEN 'leisure' WHEN 1 THEN 'business' END AS travel_purpose,
    CASE c_nationkey % 7 WHEN 0 THEN 'us' WHEN 1 THEN 'gb' WHEN 2 THEN 'fr'
      WHEN 3 THEN 'jp' WHEN 4 THEN 'br' WHEN 5 THEN 'zz' END AS country_code
  FROM orders JOIN customer ON o_custkey = c_custkey)"""



def rates(entries: list[tuple[str, str]]) -> str:
    return "fx(c, r) AS (VALUES {})".format(", ".join(f"('{c}', CAST({r} AS DOUBLE))" for c, r in entries))


FX = rates(RATES)
ST, DV = values(STATUS, "st"), values(DEVICE, "dv")
RG = values(list(REGION.items()), "rg")
CODES = " ".join([*REGION, "ZZ"])
DEALT = f"""dealt AS (SELECT *, list_extract(string_split('{CODES}', ' '),
    CAST(CAST(transaction_id AS BIGINT) % {len(CODES.split())} + 1 AS INTEGER)) AS code FROM raw)"""

USD = "CAST(CAST(revenue AS DOUBLE) * r AS DECIMAL(18,2)) AS revenue_usd"
SITE = "upper(regexp_extract(conversion_key, 'k-([^_]+)', 1)) AS site_key"
DEVICE_CODE = "regexp_extract(conversion_key, 'd-([^_]+)', 1)"
REFERRAL = "regexp_extract(conversion_key, 'p-([^_]+)', 1) AS referral_property_id"

CAN = f"""SELECT transaction_id, conversion_key, 'BC-' || accommodation AS property_id,
    coalesce(st.v, status) AS status, currency, check_in_date, check_out_date, revenue,
    travel_purpose, upper(country_code) AS country_code, {SITE}, {REFERRAL},
    dv.v AS device, rg.v AS region, {USD}
  FROM raw LEFT JOIN st ON status = st.k LEFT JOIN dv ON {DEVICE_CODE} = dv.k
    LEFT JOIN rg ON upper(country_code) = rg.k LEFT JOIN fx ON currency = fx.c"""
CANONICAL_SQL = f"WITH {RAW}, {ST}, {DV}, {RG}, {FX} {CAN}"

BOOK = f"{ST}, {DV}, {RG}, {FX}, book AS ({CAN})"
EARLY = "t AS (SELECT * FROM book WHERE check_in_date <= DATE '1998-12-31')"
LATE = "s AS (SELECT * REPLACE ('X' AS status) FROM book WHERE check_in_date >= DATE '1998-01-01')"
PARTS = f"WITH {RAW}, {BOOK}, {EARLY}, {LATE}"
MERGED = f"""{PARTS} SELECT * FROM s UNION ALL
  SELECT * FROM t WHERE transaction_id NOT IN (SELECT transaction_id FROM s)"""

LOG = """log AS (SELECT max(o_orderkey) AS snapshot_id,
    date_trunc('month', o_orderdate)::TIMESTAMP AS committed_at,
    CASE month(date_trunc('month', o_orderdate)) % 3 WHEN 0 THEN 'append'
      WHEN 1 THEN 'overwrite' ELSE 'replace' END AS operation
  FROM orders GROUP BY date_trunc('month', o_orderdate))"""
SYNCS = """syncs AS (SELECT snapshot_id, committed_at + INTERVAL 1 HOUR AS processed_at
  FROM log WHERE committed_at < (SELECT max(committed_at) FROM log))"""

FLAT = """transaction_id, conversion_key, accommodation AS property_id, status, currency,
  {check_in} AS check_in_date, CAST(check_out_date AS VARCHAR) AS check_out_date,
  amount AS revenue, travel_purpose, country_code"""

FLAT_TYPES = {
    "transaction_id": "string",
    "conversion_key": "string",
    "property_id": "string",
    "status": "string",
    "currency": "string",
    "check_in_date": "string",
    "check_out_date": "string",
    "revenue": "double",
    "travel_purpose": "string",
    "country_code": "string",
}


def compare_sql() -> str:
    rows = ", ".join(
        f"('{name}', '{kind}', "
        + (f"'{FLAT_TYPES[name]}'" if name in FLAT_TYPES else "NULL")
        + ")"
        for name, kind in TYPES
    )
    return f"""WITH c(column_name, left_type, right_type) AS (VALUES {rows}),
        n AS (SELECT count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey)
      SELECT column_name, left_type, right_type,
        left_type IS NOT DISTINCT FROM right_type AS same_type,
        n AS left_rows, n AS right_rows FROM c, n"""


ORACLES = {
    "jsonl_date_window": f"""WITH {RAW} SELECT {FLAT.format(check_in='check_in_date')} FROM raw
      WHERE check_in_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-31'""",
    "lookup_table": "SELECT c_name AS key, c_mktsegment AS value FROM customer",
    "currencies_in_use": f"WITH {RAW} SELECT DISTINCT currency FROM raw WHERE currency <> ''",
    "rates_in_use": f"""WITH {RAW}, {FX} SELECT c AS currency, r AS rate_to_usd FROM fx
      WHERE c IN (SELECT currency FROM raw)""",
    "missing_rates": f"""WITH {RAW}, {FX} SELECT DISTINCT currency FROM raw
      WHERE currency <> '' AND currency NOT IN (SELECT c FROM fx)""",
    "flatten_nested": f"WITH {RAW} SELECT "
    + FLAT.format(check_in="CAST(check_in_date AS VARCHAR)")
    + " FROM raw",
    "country_upper": f"WITH {RAW} SELECT transaction_id, upper(country_code) AS country_code FROM raw",
    "label_extract": f"""WITH {RAW} SELECT transaction_id, conversion_key, {SITE},
      {DEVICE_CODE} AS device_code, {REFERRAL} FROM raw""",
    "property_prefix": f"""WITH {RAW} SELECT transaction_id,
      'BC-' || accommodation AS property_id FROM raw""",
    "cast_types": f"WITH {RAW} SELECT transaction_id, check_in_date, check_out_date, revenue FROM raw",
    "status_map": f"""WITH {RAW}, {ST} SELECT transaction_id, coalesce(v, status) AS status
      FROM raw LEFT JOIN st ON status = k""",
    "device_map": f"""WITH {RAW}, {DV} SELECT transaction_id, v AS device
      FROM raw LEFT JOIN dv ON {DEVICE_CODE} = k""",
    "region_map": f"""WITH {RAW}, {RG}, {DEALT} SELECT transaction_id, code AS country_code,
      v AS region FROM dealt LEFT JOIN rg ON code = k""",
    "jsonl_mixed_amounts": f"WITH {RAW} SELECT transaction_id, revenue FROM raw",
    "revenue_usd_strict": f"""WITH {RAW}, {rates([*RATES, XTS_RATE])} SELECT transaction_id,
      currency, revenue, {USD} FROM raw LEFT JOIN fx ON currency = c""",
    "revenue_usd": f"""WITH {RAW}, {FX} SELECT transaction_id, currency, revenue, {USD}
      FROM raw LEFT JOIN fx ON currency = c""",
    "bookings_canonical": CANONICAL_SQL,
    "booking_job": f"""WITH first_{RAW}, raw AS (SELECT * REPLACE (
        CASE WHEN check_in_date >= DATE '1998-01-01' THEN 'amended' ELSE status END AS status,
        CASE WHEN check_in_date >= DATE '1998-01-01' THEN CAST(amount * 2 AS DECIMAL(18,2))
          ELSE revenue END AS revenue) FROM first_raw), {ST}, {DV}, {RG}, {FX} {CAN}""",
    "merge_upsert": MERGED,
    "merge_actions": f"""{PARTS} SELECT
      (SELECT count(*) FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM t)) AS inserted,
      (SELECT count(*) FROM t WHERE transaction_id IN (SELECT transaction_id FROM s)) AS updated,
      (SELECT count(*) FROM t WHERE transaction_id NOT IN (SELECT transaction_id FROM s)) AS kept""",
    "merge_repeated_keys": f"""WITH {RAW}, {BOOK},
      k AS (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 > 0
          THEN transaction_id END AS transaction_id),
        CASE WHEN CAST(transaction_id AS BIGINT) % 3 > 0
          THEN 1 + CAST(transaction_id AS BIGINT) % 2 ELSE 1 END AS copies FROM book),
      n AS (SELECT * FROM (VALUES (1), (2)) AS v(i)),
      t AS (SELECT k.* EXCLUDE (copies) FROM k, n WHERE check_in_date <= DATE '1998-12-31' AND i <= copies),
      s AS (SELECT k.* EXCLUDE (copies) REPLACE ('X' AS status) FROM k, n
        WHERE check_in_date >= DATE '1998-01-01'
          AND i <= CASE WHEN check_in_date > DATE '1998-12-31' THEN copies ELSE 1 END)
      SELECT t.* FROM t
        WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.transaction_id = t.transaction_id)
      UNION ALL SELECT s.* FROM t JOIN s USING (transaction_id)
      UNION ALL SELECT s.* FROM s
        WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.transaction_id = s.transaction_id)""",
    "published_earlier": f"{PARTS} SELECT * FROM t",
    "row_count": "SELECT count(*) AS row_count FROM orders JOIN customer ON o_custkey = c_custkey",
    "schema_listing": "SELECT * FROM (VALUES {}) AS l(ordinal, column_name, data_type)".format(
        ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(TYPES, start=1))
    ),
    "dataset_compare": compare_sql(),
    "snapshot_history": f"WITH {LOG} SELECT * FROM log ORDER BY committed_at DESC",
    "latest_snapshot": f"""WITH {LOG} SELECT snapshot_id, committed_at FROM log
      ORDER BY committed_at DESC, snapshot_id DESC LIMIT 1""",
    "tracking_log": f"""WITH {LOG}, {SYNCS} SELECT * FROM syncs UNION ALL
      (SELECT snapshot_id, TIMESTAMP '2002-01-01 00:00:00' FROM log
       ORDER BY committed_at DESC LIMIT 1)""",
    "last_tracked": f"""WITH {LOG}, {SYNCS} SELECT * FROM syncs
      ORDER BY processed_at DESC, snapshot_id DESC LIMIT 1""",
    "sync_decision": f"""WITH {LOG}, {SYNCS},
      l AS (SELECT snapshot_id FROM log ORDER BY committed_at DESC LIMIT 1),
      p AS (SELECT snapshot_id FROM syncs ORDER BY processed_at DESC LIMIT 1)
      SELECT l.snapshot_id AS latest_id, p.snapshot_id AS tracked_id,
        CASE WHEN l.snapshot_id IS NULL THEN 'none'
          WHEN l.snapshot_id = p.snapshot_id THEN 'skip' ELSE 'full' END AS decision
      FROM l LEFT JOIN p ON true""",
    "sync_run": f"""{PARTS}, a AS (SELECT count(*) AS n FROM t), b AS (SELECT count(*) AS n FROM book)
      SELECT CAST(1 AS BIGINT) AS run, 'full' AS decision, CAST(1 AS BIGINT) AS snapshot_id,
        n AS rows_moved, n AS stored FROM a
      UNION ALL SELECT 2, 'skip', 1, 0, n FROM a
      UNION ALL SELECT 3, 'full', 2, n, n FROM b""",
    "expire_snapshots": f"""WITH {LOG}, r AS (SELECT *, row_number() OVER
        (ORDER BY committed_at DESC, snapshot_id DESC) AS newness FROM log)
      SELECT snapshot_id, committed_at, operation FROM r WHERE newness > 5""",
    "orphan_files": f"{PARTS} SELECT * FROM s",
}
ORACLES |= {
    "rejected_lines": f"""WITH {RAW} SELECT transaction_id,
      CAST(transaction_id AS BIGINT) % 17 = 0 AS rejected FROM raw""",
    "merge_scattered": f"""WITH {RAW}, {BOOK},
      s AS (SELECT * REPLACE ('X' AS status) FROM book WHERE CAST(transaction_id AS BIGINT) % 50 = 1),
      n AS (SELECT * REPLACE (transaction_id || '-new' AS transaction_id) FROM book
        WHERE CAST(transaction_id AS BIGINT) % 50 = 2)
      SELECT * FROM s UNION ALL SELECT * FROM n
      UNION ALL SELECT * FROM book WHERE CAST(transaction_id AS BIGINT) % 50 <> 1""",
    "merge_filter_counts": f"""WITH {RAW} SELECT count(*) AS held, count(*) AS held_and_passing,
      true AS most_are_cut FROM raw WHERE CAST(transaction_id AS BIGINT) % 50 = 1""",
    "merge_bucketed_table": f"""WITH {RAW}, {BOOK},
      k AS (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 > 0
        THEN transaction_id END AS transaction_id) FROM book),
      t AS (SELECT * FROM k WHERE check_in_date <= DATE '1998-12-31'),
      s AS (SELECT * REPLACE ('X' AS status) FROM k WHERE check_in_date >= DATE '1998-01-01')
      SELECT * FROM s UNION ALL SELECT * FROM t
      WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.transaction_id = t.transaction_id)""",
    "content_compare": f"""WITH {RAW}, {BOOK},
      k AS (SELECT *, CAST(transaction_id AS BIGINT) % 100 AS rest FROM book),
      l AS (SELECT * EXCLUDE (rest) FROM k),
      r AS (SELECT * EXCLUDE (rest) REPLACE (CASE WHEN rest = 5 THEN 'X' ELSE device END AS device)
        FROM k WHERE rest <> 3 UNION ALL SELECT * EXCLUDE (rest) FROM k WHERE rest = 7),
      d AS (SELECT transaction_id FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
        UNION SELECT transaction_id FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l))
      SELECT transaction_id,
        (SELECT count(*) FROM l WHERE l.transaction_id = d.transaction_id) AS left_rows,
        (SELECT count(*) FROM r WHERE r.transaction_id = d.transaction_id) AS right_rows FROM d""",
    "rows_processed": f"""{PARTS}, merged AS (SELECT transaction_id FROM s UNION SELECT transaction_id FROM t)
      SELECT (SELECT count(*) FROM s) AS moved, count(*) AS stored FROM merged""",
}
ORACLES["revenue_usd_udf"] = ORACLES["revenue_usd"]
for same_rows in ("merge_rerun", "external_upsert", "published_current", "compact_files"):
    ORACLES[same_rows] = MERGED
