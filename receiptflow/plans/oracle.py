"""The same answers in plain SQL, for comparison on another engine."""

from __future__ import annotations

_TX = """
tx AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS receipt_id,
         concat('', o_custkey) AS customer_id,
         concat('pr-', l_partkey) AS product_id,
         p_name AS product_name,
         p_retailprice AS product_price,
         CAST(l_quantity AS INT) AS product_quantity,
         l_extendedprice AS total_amount,
         l_shipdate AS receipt_date,
         epoch_us(l_shipdate) // 1000 AS receipt_date_ms,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Voucher' WHEN '2' THEN 'Invoice'
              WHEN '3' THEN 'Cash' WHEN '4' THEN 'Bank transfer' ELSE 'Store credit' END AS payment_method,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) AS arrival_rank
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_CUST = """
cust AS (
  SELECT concat('', c_custkey) AS customer_id, c_name AS name,
         concat('c', c_custkey, '@example.org') AS email,
         concat(1950 + c_custkey % 50, '-0', 1 + c_custkey % 9, '-1', c_custkey % 10) AS birthdate
  FROM customer)"""

_MARKS = """
marks AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS receipt_id,
         epoch_us(l_shipdate + INTERVAL 1 DAY) // 1000 AS detected_ts_ms
  FROM lineitem WHERE l_orderkey % 10 = 0)"""

_TX_COLUMNS = """receipt_id, customer_id, product_id, product_name, product_price, product_quantity,
       total_amount, receipt_date_ms, payment_method"""

_SPEND = """
WITH e AS (
  SELECT concat('', user_id) AS customer_id, value,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10000 AS us
  FROM events)
SELECT customer_id, us // 10000000 * 10000 AS window_start_ms,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
FROM e GROUP BY 1, 2"""

_SIGNUPS = """
SELECT concat('', user_id) AS customer_id, concat('user ', user_id, ' v', event_id) AS name,
       concat('u', user_id, '@example.org') AS email,
       concat('19', 50 + user_id % 50, '-01-01') AS birthdate
FROM events WHERE event_type = 'signup'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""

# Column list of an enriched purchase t with customer record c, both rows of the event table.
_PAIR_COLUMNS = """
       concat('ev-', t.event_id) AS receipt_id, concat('', c.user_id) AS customer_id,
       concat('pr-', substr(t.props, 7, length(t.props) - 7)) AS product_id, t.event_type AS product_name,
       t.value AS product_price, 1 AS product_quantity, t.value AS total_amount,
       epoch_us(t.ts) // 1000 AS receipt_date_ms, 'Cash' AS payment_method,
       concat('user ', c.user_id, ' v', c.event_id) AS customer_name,
       concat('u', c.user_id, '@example.org') AS customer_email,
       concat('19', 50 + c.user_id % 50, '-01-01') AS customer_birthdate,
       t.event_id AS tx_arrival, c.event_id AS customer_arrival"""

_ASOF_PAIRS = """
log AS (
  SELECT user_id, event_id, event_type,
         max(CASE WHEN event_type = 'signup' THEN event_id END) OVER so_far AS before,
         min(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id) AS opening
  FROM events WHERE event_type IN ('signup', 'purchase')
  WINDOW so_far AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
pairs AS (
  SELECT event_id AS tx, coalesce(before, opening) AS cust FROM log
  WHERE event_type = 'purchase' AND opening IS NOT NULL)"""

_ASOF = f"""
WITH {_ASOF_PAIRS}
SELECT {_PAIR_COLUMNS}
FROM pairs JOIN events t ON t.event_id = pairs.tx JOIN events c ON c.event_id = pairs.cust"""

# The two-slot buffer run row by row: held is the waiting transaction, known the stored record.
_PAIR_BUFFER = f"""
WITH RECURSIVE log AS (
  SELECT user_id, event_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i
  FROM events WHERE event_type IN ('signup', 'purchase')),
run AS (
  SELECT user_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS held, CAST(NULL AS BIGINT) AS known,
         CAST(NULL AS BIGINT) AS tx, CAST(NULL AS BIGINT) AS cust
  FROM log WHERE i = 1
  UNION ALL
  SELECT l.user_id, l.i,
         CASE WHEN l.event_type = 'purchase' AND r.known IS NULL THEN l.event_id
              WHEN l.event_type = 'signup' THEN NULL ELSE r.held END,
         CASE WHEN l.event_type = 'signup' AND r.held IS NULL THEN l.event_id ELSE r.known END,
         CASE WHEN l.event_type = 'purchase' AND r.known IS NOT NULL THEN l.event_id
              WHEN l.event_type = 'signup' AND r.held IS NOT NULL THEN r.held END,
         CASE WHEN l.event_type = 'purchase' THEN r.known
              WHEN r.held IS NOT NULL THEN l.event_id END
  FROM run r JOIN log l ON l.user_id = r.user_id AND l.i = r.i + 1),
pairs AS (SELECT tx, cust FROM run WHERE tx IS NOT NULL AND cust IS NOT NULL)
SELECT {_PAIR_COLUMNS}
FROM pairs JOIN events t ON t.event_id = pairs.tx JOIN events c ON c.event_id = pairs.cust"""

_LATEST_TX = f"WITH {_TX} SELECT {_TX_COLUMNS} FROM tx WHERE arrival_rank = 1"

_WITHOUT_FRAUD = f"""
WITH {_TX}, {_MARKS}
SELECT {_TX_COLUMNS} FROM tx
WHERE arrival_rank = 1 AND NOT EXISTS (SELECT 1 FROM marks WHERE marks.receipt_id = tx.receipt_id)"""

_DEDUPED = f"""
WITH {_TX}
SELECT receipt_id, customer_id, payment_method, true AS is_copy FROM tx WHERE arrival_rank = 1"""

_PEAK_HOURS = """
SELECT CAST(hour(ts) AS INT) AS h, count(*) AS n, CAST(rank() OVER (ORDER BY count(*) DESC) AS INT) AS rk
FROM events GROUP BY 1"""

# Receipts of three events each: the newest copy, unless a signup among them marks it.
_CORRECTED = """
WITH p AS (
  SELECT concat('', user_id) AS customer_id, value, ts, event_id // 3 AS receipt,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10000 AS us
  FROM events WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY event_id // 3 ORDER BY event_id DESC) = 1),
kept AS (
  SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'signup' AND e.event_id // 3 = p.receipt))"""

# Slices by the id; a row is late if its window's end is not after the newest row of all slices before.
_SPEND_LATE = """
WITH e AS (
  SELECT concat('', user_id) AS customer_id, value, (4 - event_id % 4) % 4 AS slice,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 10000 AS us
  FROM events),
seen AS (SELECT slice, max(max(us)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM e GROUP BY slice)
SELECT customer_id, us // 10000000 * 10000 AS window_start_ms, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
       count(*) AS n, count(*) FILTER (WHERE (us // 10000000 + 1) * 10000000 <= newest) AS n_late
FROM e JOIN seen USING (slice) GROUP BY 1, 2"""

ORACLE: dict[str, str] = {
    "spend_10s": _SPEND,
    "spend_10s_stream": _SPEND,
    "spend_10s_shuffled_stream": _SPEND,
    "spend_processing_time": """
SELECT concat('', user_id) AS customer_id,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
FROM events GROUP BY 1""",
    "spend_fired_stream": """
SELECT concat('', user_id) AS customer_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n,
       CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS early, CAST(0 AS BIGINT) AS askew
FROM events GROUP BY 1""",
    "decode_transactions": f"WITH {_TX} SELECT {_TX_COLUMNS} FROM tx",
    "decode_customers": f"WITH {_CUST} SELECT customer_id, name, email, birthdate FROM cust",
    "decode_fraud": f"WITH {_MARKS} SELECT receipt_id, detected_ts_ms FROM marks",
    "decode_quarantine": """
SELECT event_id,
       CASE WHEN event_id % 10 IN (5, 6, 7, 9) THEN concat('', event_id) END AS receipt_id,
       CASE WHEN event_id % 10 IN (5, 9) THEN value WHEN event_id % 10 IN (6, 7) THEN 0.0 END AS total_amount,
       CASE event_id % 10 WHEN 5 THEN 0 WHEN 6 THEN 2 WHEN 7 THEN 0 WHEN 9 THEN 3 END AS product_quantity,
       CASE WHEN event_id % 10 IN (0, 3, 4) THEN 'not a JSON object'
            WHEN event_id % 10 = 1 THEN 'unknown field extra'
            WHEN event_id % 10 = 8 THEN 'bad value for productQuantity' END AS problem
FROM events WHERE event_id % 10 <> 2""",
    "decode_unusable": """
SELECT event_id, CASE WHEN ok THEN concat('', event_id) END AS receipt_id, CASE WHEN ok THEN 'c' END AS customer_id,
       CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS VARCHAR) AS product_name, CASE WHEN ok THEN 0.0::DOUBLE END AS product_price,
       CASE WHEN ok THEN 0 END AS product_quantity, CASE WHEN ok THEN 0.004::DOUBLE END AS total_amount,
       CASE WHEN ok THEN 1704067200000 END AS receipt_date_ms, CAST(NULL AS VARCHAR) AS payment_method,
       CASE event_id % 7 WHEN 0 THEN 'no value for receiptId' WHEN 1 THEN 'no value for customerId' WHEN 2 THEN 'no value for receiptDate'
            WHEN 6 THEN NULL ELSE 'bad value for totalAmount' END AS problem
FROM (SELECT *, event_id % 7 = 6 AS ok FROM events)""",
    "encode_enriched": f"""
WITH {_TX}, {_CUST}
SELECT concat('receiptId,customerId,productId,productName,productPrice,productQuantity,totalAmount,',
              'receiptDate,paymentMethod,customerName,customerEmail,customerBirthdate') AS names,
       {_TX_COLUMNS}, name AS customer_name, email AS customer_email, birthdate AS customer_birthdate
FROM tx JOIN cust USING (customer_id) WHERE arrival_rank = 1""",
    "upsert_transactions": _LATEST_TX,
    "upsert_transactions_stream": _LATEST_TX,
    "upsert_customers": _SIGNUPS,
    "upsert_customers_stream": _SIGNUPS,
    "upsert_fraud": f"WITH {_MARKS} SELECT receipt_id, max(detected_ts_ms) AS detected_ts_ms FROM marks GROUP BY 1",
    "enrich_current": f"""
WITH {_TX}, {_CUST}
SELECT {_TX_COLUMNS}, name AS customer_name, email AS customer_email, birthdate AS customer_birthdate
FROM tx JOIN cust USING (customer_id) WHERE arrival_rank = 1""",
    "enrich_current_hot": f"""
WITH {_TX}, {_CUST}
SELECT {_TX_COLUMNS}, name AS customer_name, email AS customer_email, birthdate AS customer_birthdate
FROM tx JOIN cust USING (customer_id) WHERE arrival_rank = 1""",
    "enrich_asof": _ASOF,
    "enrich_asof_hot": _ASOF,
    "enrich_asof_stream": _ASOF,
    "enrich_asof_batches": _ASOF,
    "enrich_pair_buffer": _PAIR_BUFFER,
    "enrich_pair_buffer_hot": _PAIR_BUFFER,
    "enrich_pair_buffer_stream": _PAIR_BUFFER,
    "enrich_pair_buffer_batches": _PAIR_BUFFER,
    "enriched_table": f"""
WITH {_ASOF_PAIRS}
SELECT concat('u', c.user_id, '@example.org') AS customer_email, count(*) AS n,
       CAST(sum(CAST(t.value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM pairs JOIN events t ON t.event_id = pairs.tx JOIN events c ON c.event_id = pairs.cust
GROUP BY 1""",
    "dedupe_transactions": _LATEST_TX,
    "dedupe_stream": _DEDUPED,
    "dedupe_late_stream": _DEDUPED,
    "drop_fraud": _WITHOUT_FRAUD,
    "drop_fraud_stream": _WITHOUT_FRAUD,
    "drop_fraud_late_stream": _WITHOUT_FRAUD,
    "monthly_spend": f"""
WITH {_TX}
SELECT customer_id, CAST(year(receipt_date) AS INT) AS y, CAST(month(receipt_date) AS INT) AS m,
       CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS n
FROM tx WHERE arrival_rank = 1 GROUP BY 1, 2, 3""",
    "job_enriched": f"SELECT * EXCLUDE (tx_arrival, customer_arrival) FROM ({_ASOF})",
    "job_totals": """
SELECT concat('', user_id) AS customer_id, epoch_us(ts) // 10000000 * 10000 AS window_start_ms,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "job_tables": f"""
WITH {_MARKS}, {_ASOF_PAIRS}
SELECT 'Raw_Transactions' AS name, count(*) AS n, count(*) AS keys FROM events WHERE event_type = 'purchase'
UNION ALL SELECT 'Customer', count(DISTINCT user_id), count(DISTINCT user_id) FROM events WHERE event_type = 'signup'
UNION ALL SELECT 'Fraud_Transactions', count(DISTINCT receipt_id), count(DISTINCT receipt_id) FROM marks
UNION ALL SELECT 'Customer_Transactions', count(*), count(*) FROM pairs""",
    "monthly_spend_stream": """
SELECT concat('', user_id) AS customer_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 3""",
    "spend_10s_late_stream": _SPEND_LATE,
    "totals_without_fraud_late_stream": f"""{_CORRECTED}
SELECT customer_id, us // 10000000 * 10000 AS window_start_ms,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
FROM kept GROUP BY 1, 2""",
    "monthly_without_fraud_late_stream": f"""{_CORRECTED}
SELECT customer_id, CAST(year(ts) AS INT) AS y, CAST(month(ts) AS INT) AS m,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS n
FROM kept GROUP BY 1, 2, 3""",
    "peak_hours": _PEAK_HOURS,
    "peak_hours_stream": _PEAK_HOURS,
}
