"""DuckDB-side fixture mapping, prepended as CTEs to every oracle query.

The CTE texts are the section-B mapping of FIXTURES.md, verbatim in meaning,
so the oracle computes from the same driver tables with an independent engine.
"""

from __future__ import annotations

FIXTURE_CTES = {
    "users": """
SELECT CAST(c_custkey AS BIGINT) AS id,
       CAST(18 + (c_custkey * 31) % 70 AS INT) AS current_age,
       CAST(60 + c_custkey % 11 AS INT) AS retirement_age,
       CAST(2024 - (18 + (c_custkey * 31) % 70) AS INT) AS birth_year,
       CAST(1 + c_custkey % 12 AS INT) AS birth_month,
       CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       concat(CAST((c_custkey * 13) % 9999 AS VARCHAR(9)), ' ', c_mktsegment, ' Street') AS address,
       concat(CAST(25 + c_custkey % 25 AS VARCHAR(9)), '.', CAST(10 + (c_custkey * 3) % 90 AS VARCHAR(9))) AS latitude,
       concat('-', CAST(70 + c_custkey % 50 AS VARCHAR(9)), '.', CAST(10 + (c_custkey * 7) % 90 AS VARCHAR(9))) AS longitude,
       CAST(20000 + (c_custkey * 97) % 30000 AS DECIMAL(12,2)) AS per_capita_income,
       CAST(CASE WHEN c_custkey % 101 = 0 THEN 0 ELSE 12000 + (c_custkey * 7919) % 140001 END AS DECIMAL(12,2)) AS yearly_income,
       CAST((c_custkey * 104729) % 200000 AS DECIMAL(12,2)) AS total_debt,
       CAST(480 + (c_custkey * 37) % 371 AS INT) AS credit_score,
       CAST(1 + c_custkey % 9 AS INT) AS num_credit_cards
FROM customer""",
    "cards": """
SELECT CAST(o_orderkey AS BIGINT) AS id,
       CAST(o_custkey AS BIGINT) AS client_id,
       CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Amex' WHEN '2' THEN 'Discover'
            WHEN '3' THEN 'Mastercard' ELSE 'Visa' END AS card_brand,
       CASE o_orderstatus WHEN 'O' THEN 'Credit' WHEN 'F' THEN 'Debit' ELSE 'Debit (Prepaid)' END AS card_type,
       CAST(4000000000000000 + o_orderkey * 7919 AS VARCHAR(20)) AS card_number,
       make_date(CAST(2000 + o_orderkey % 10 AS INT), CAST(1 + o_orderkey % 12 AS INT), 1) AS expires,
       CAST(100 + o_orderkey % 900 AS VARCHAR(9)) AS cvv,
       CASE WHEN o_orderkey % 5 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
       CAST(1 + o_orderkey % 3 AS INT) AS num_cards_issued,
       CAST(CASE WHEN o_orderkey % 250 = 0 THEN 0 ELSE (o_orderkey * 613) % 40001 END AS DECIMAL(12,2)) AS credit_limit,
       CAST(o_orderdate AS DATE) AS acct_open_date,
       CAST(1990 + o_orderkey % 9 AS INT) AS year_pin_last_changed
FROM orders""",
    "mcc_codes": """
SELECT CAST(5000 + p_partkey AS BIGINT) AS mcc_id, concat(p_type, '/', p_name) AS description
FROM part""",
    "txn_base": """
SELECT l.*, o.o_custkey,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
                  l_discount, l_tax, l_returnflag, l_linestatus) AS rn
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "transactions": """
SELECT l_orderkey * 1000 + l_linenumber * 100 + rn AS id,
       l_shipdate + ((l_partkey * 7919) % 86400) * INTERVAL '1' SECOND AS date,
       CAST(o_custkey AS BIGINT) AS client_id,
       CAST(CASE WHEN l_partkey % 199 = 0 THEN -1 - l_orderkey ELSE l_orderkey END AS BIGINT) AS card_id,
       CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice
                 WHEN l_quantity = 50 AND l_linenumber = 2 THEN 0
                 ELSE l_extendedprice END AS DECIMAL(10,2)) AS amount,
       CASE WHEN (l_orderkey * 3 + l_linenumber) % 97 = 0 THEN NULL
            WHEN l_linenumber % 3 = 0 THEN 'Chip Transaction'
            WHEN l_linenumber % 3 = 1 THEN 'Swipe Transaction'
            WHEN l_orderkey % 11 = 0 THEN 'Online Order'
            ELSE 'Online Transaction' END AS use_chip,
       CAST(CASE WHEN (l_orderkey + l_partkey) % 83 <> 0 THEN l_suppkey END AS BIGINT) AS merchant_id,
       CASE WHEN l_linenumber % 3 = 2 THEN 'ONLINE' ELSE concat('City', CAST(l_suppkey % 40 AS VARCHAR(9))) END AS merchant_city,
       CASE WHEN l_linenumber % 3 = 2 THEN CASE WHEN l_orderkey % 7 = 0 THEN '' END ELSE concat('S', CAST(l_suppkey % 25 AS VARCHAR(9))) END AS merchant_state,
       CASE WHEN l_linenumber % 3 = 2 THEN CASE WHEN l_orderkey % 5 = 0 THEN '' END ELSE CAST(10000 + l_suppkey AS VARCHAR(9)) END AS zip,
       CAST(CASE WHEN l_partkey % 110 = 109 THEN 1000 + l_partkey % 10 ELSE 5000 + l_partkey END AS BIGINT) AS mcc,
       CASE (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 59
            WHEN 0 THEN 'Insufficient Balance'
            WHEN 1 THEN CASE WHEN l_partkey % 3 = 0 THEN 'Bad PIN,Insufficient Balance'
                             WHEN l_partkey % 3 = 1 THEN 'Bad PIN' ELSE 'Technical Glitch' END
       END AS errors
FROM txn_base""",
    "users_v2": """
SELECT id, current_age, retirement_age, birth_year, birth_month, gender,
       address, latitude, longitude,
       per_capita_income, yearly_income, total_debt,
       CAST(CASE WHEN id % 10 = 0 THEN credit_score + 25 ELSE credit_score END AS INT) AS credit_score,
       CAST(CASE WHEN id % 7 = 0 THEN num_credit_cards + 1 ELSE num_credit_cards END AS INT) AS num_credit_cards
FROM users""",
    "scored": """
SELECT id, CASE WHEN errors IS NULL THEN 0 ELSE 1 END AS label,
       CAST((id * 37 + CAST(floor(amount) AS INT)) % 101 AS DOUBLE) / 200
         + CASE WHEN errors IS NOT NULL AND id % 3 = 0 THEN 0.25 ELSE 0.0 END AS score
FROM transactions WHERE amount > 0""",
}


def with_fixtures(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix an oracle query with the fixture CTEs (and any extra CTEs)."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in FIXTURE_CTES.items()]
    for name, sql in extra_ctes or []:
        parts.append(f"{name} AS ({sql.strip()})")
    body = body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(parts) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(parts) + "\n" + body
