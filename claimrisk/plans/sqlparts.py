"""Common table expressions of the checking SQL: the mapped domain and the feature table."""

from __future__ import annotations

# Spark rounds the decimal text of a double; so does this.
def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


TREATMENTS = """
treatments AS (
  SELECT (line_id * 1000000 + nth - 1) AS claim_id, * EXCLUDE (line_id, nth)
  FROM (
    SELECT l_orderkey * 10 + l_linenumber AS line_id, o_custkey AS member_id,
           l_suppkey AS provider_id, p_type AS proc_code,
           CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS site,
           l_extendedprice AS amount, l_returnflag, l_linestatus,
           CAST(least(o_orderdate, l_shipdate) AS DATE) AS proc_date,
           CAST(greatest(o_orderdate, l_shipdate) AS DATE) AS req_date,
           'NF' || l_suppkey || '-' || l_partkey AS document,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag,
             l_linestatus) AS nth
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey))"""

CLAIMS = TREATMENTS + """,
claims AS (
  SELECT * EXCLUDE (l_returnflag, l_linestatus), l_linestatus AS decision,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
  FROM treatments WHERE l_returnflag <> 'N')"""

NETWORK = """
network AS (SELECT claim_id AS procedure_id, member_id, provider_id, proc_code, site, proc_date, amount
  FROM treatments WHERE l_returnflag = 'N')"""

MEMBERS = """
members AS (SELECT c_custkey AS member_id, c_nationkey AS region, c_mktsegment AS plan_id,
  DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS enrolled_on FROM customer)"""

PROVIDERS = """
providers AS (SELECT s_suppkey AS provider_id, s_nationkey AS region, s_suppkey % 5 < 3 AS in_network
  FROM supplier)"""

PLANS = """
plans AS (SELECT DISTINCT c_mktsegment AS plan_id, length(c_mktsegment) / 20.0::DOUBLE AS plan_rate
  FROM customer)"""

PRICES = """
prices AS (SELECT proc_code, """ + rnd("quantile_disc(amount, 0.5)", 2) + """ AS reference_price
  FROM network GROUP BY proc_code)"""

DOMAIN = ",".join([CLAIMS, NETWORK, MEMBERS, PROVIDERS, PLANS, PRICES])

def enriched(claims: str = "claims") -> str:
    return DOMAIN + f""",
enriched AS (
  SELECT c.*, m.region, m.plan_id, m.enrolled_on, l.plan_rate, p.in_network,
         p.region AS provider_region, r.reference_price
  FROM {claims} c
  LEFT JOIN members m ON m.member_id = c.member_id
  LEFT JOIN plans l ON l.plan_id = m.plan_id
  LEFT JOIN providers p ON p.provider_id = c.provider_id
  LEFT JOIN prices r ON r.proc_code = c.proc_code),
own AS (
  SELECT *, {rnd("amount / reference_price", 4)} AS price_ratio,
         CAST(proc_date - enrolled_on AS INTEGER) AS days_since_enrolment,
         CASE WHEN proc_date - enrolled_on <= 120 THEN 1 ELSE 0 END AS recent_enrolment,
         CASE WHEN NOT in_network THEN 1 ELSE 0 END AS out_of_network,
         CASE WHEN region <> provider_region THEN 1 ELSE 0 END AS region_mismatch,
         CASE WHEN amount > 51000 AND amount <= 60000 THEN 1 ELSE 0 END AS near_ceiling,
         CAST(req_date - proc_date AS INTEGER) AS days_to_request
  FROM enriched)"""


def provider_table(claims: str = "claims") -> str:
    return f"""
prov AS (
  SELECT provider_id, count(*) AS prov_claims, count(DISTINCT member_id) AS prov_members,
         {rnd(money("amount") + " / count(*)", 2)} AS prov_mean_amount,
         {rnd("sum(CASE WHEN amount > 51000 AND amount <= 60000 THEN 1 ELSE 0 END) / count(*)", 4)}
           AS prov_near_ceiling_share
  FROM {claims} GROUP BY provider_id)"""


def member_table(claims: str = "claims") -> str:
    return f"""
mem AS (
  SELECT member_id, count(*) AS mem_claims, {money("amount")} AS mem_total_amount,
         count(DISTINCT provider_id) AS mem_providers
  FROM {claims} GROUP BY member_id)"""


ENRICHED, PROVIDER_TABLE, MEMBER_TABLE = enriched(), provider_table(), member_table()

BURST = """
burst AS (
  SELECT claim_id, count(*) OVER (PARTITION BY member_id, provider_id ORDER BY proc_date
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS pair_claims_30d FROM claims)"""

REPEATED = """
repeated AS (SELECT document FROM claims GROUP BY document HAVING count(*) > 1)"""

MARKS = """
marks AS (SELECT DISTINCT member_id, proc_code, coalesce(site, 'NA') AS site_key FROM network)"""

REMOVED = """
removed AS (SELECT member_id, site, min(proc_date) AS removed_on FROM network
  WHERE proc_code = 'ECONOMY' GROUP BY member_id, site)"""

_FEATURES = """,
features AS (
  SELECT o.claim_id, o.member_id, o.provider_id, o.proc_code, o.req_date,
         amount, price_ratio, days_since_enrolment, recent_enrolment, out_of_network,
         region_mismatch, near_ceiling, days_to_request,
         prov_claims, prov_members, prov_mean_amount, prov_near_ceiling_share,
         mem_claims, mem_total_amount, mem_providers, pair_claims_30d,
         CASE WHEN d.document IS NOT NULL THEN 1 ELSE 0 END AS repeated_document,
         CASE WHEN k.member_id IS NOT NULL THEN 1 ELSE 0 END AS in_network_too,
         CASE WHEN o.proc_date > x.removed_on THEN 1 ELSE 0 END AS site_already_removed,
         plan_rate, label
  FROM own o
  LEFT JOIN prov USING (provider_id) LEFT JOIN mem USING (member_id)
  LEFT JOIN burst USING (claim_id)
  LEFT JOIN repeated d ON d.document = o.document
  LEFT JOIN marks k ON k.member_id = o.member_id AND k.proc_code = o.proc_code
    AND k.site_key = coalesce(o.site, 'NA')
  LEFT JOIN removed x ON x.member_id = o.member_id AND x.site = o.site)"""

FEATURES = ",".join(
    [ENRICHED, PROVIDER_TABLE, MEMBER_TABLE, BURST, REPEATED, MARKS, REMOVED]) + _FEATURES


def arriving_features(cut: str) -> str:
    """Features of the claims requested from a day on.

    Entities have the history before that day; pair and document count every claim that was
    requested before, by day and id.
    """
    own_arrival = _FEATURES.replace("d.document IS NOT NULL", "d.claim_id IS NOT NULL").replace(
        "repeated d ON d.document = o.document", "used d ON d.claim_id = o.claim_id")
    return ",".join([
        enriched(f"(SELECT * FROM claims WHERE req_date >= DATE '{cut}')"), f"""
history AS (SELECT * FROM claims WHERE req_date < DATE '{cut}')""",
        provider_table("history"), member_table("history"), """
burst AS (SELECT a.claim_id, 1 + count(h.claim_id) AS pair_claims_30d FROM claims a LEFT JOIN claims h
  ON h.member_id = a.member_id AND h.provider_id = a.provider_id
  AND h.proc_date BETWEEN a.proc_date - 30 AND a.proc_date
  AND (h.req_date < a.req_date OR (h.req_date = a.req_date AND h.claim_id < a.claim_id))
  GROUP BY a.claim_id)""", """
used AS (SELECT claim_id FROM (SELECT claim_id, row_number() OVER (
  PARTITION BY document ORDER BY req_date, claim_id) AS nth FROM claims WHERE document IS NOT NULL) WHERE nth > 1)""",
        MARKS, REMOVED]) + own_arrival


# A fixed score in exact 32nds, so both sides rank alike.
SCORE_SQL = (
    "(8 * repeated_document + 7 * in_network_too + 6 * site_already_removed + 4 * near_ceiling"
    " + 3 * out_of_network + 2 * CAST(pair_claims_30d >= 2 AS INT) + 1 * recent_enrolment"
    " + 1 * region_mismatch) / CAST(32 AS DOUBLE)")

SCORED_FROM = """,
scored AS (SELECT *, """ + SCORE_SQL + """ AS score FROM features)"""
SCORED = FEATURES + SCORED_FROM

QUEUE_FROM = """,
queue AS (
  SELECT * REPLACE (coalesce(price_ratio, -1) AS price_ratio),
         CASE WHEN score >= 0.8 THEN 'CRITICA' WHEN score >= 0.3 THEN 'ALTA'
              WHEN score >= 0.15 THEN 'MEDIA' ELSE 'BAIXA' END AS priority,
         """ + rnd("score * amount", 2) + """ AS value_at_risk
  FROM scored)"""
QUEUE = SCORED + QUEUE_FROM
