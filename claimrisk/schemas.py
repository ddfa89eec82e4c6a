"""Declared schemas, the feature contract and the fixed domain constants."""

from __future__ import annotations

# --- fixed values: domain constants the results depend on --------------------------------
AUDIT_CEILING = 1500.00
NEAR_CEILING_SHARE = 0.85
RECENT_DAYS = 120
BURST_DAYS = 30
REVIEW_COST = 40.00
CRITICAL_SCORE = 0.80
MEDIUM_FACTOR = 0.5
DAILY_REVIEWS = 300
EXTRACTION_CODE = "81000600"
MISSING = -1
PARITY_TOLERANCE = 1e-6
EARTH_KM = 6371
KM_PER_DEGREE = 111.0
RADIUS_TIERS_KM = (15, 50, 200)
NEAREST = 5
SPLIT_QUANTILE = 0.80
THRESHOLD_STEP = 0.05
THRESHOLD_STOP = 0.96

# --- the model input contract: names and order are fixed ---------------------------------
FEATURES = [
    "amount", "price_ratio", "days_since_enrolment", "recent_enrolment",
    "out_of_network", "region_mismatch", "near_ceiling", "days_to_request",
    "prov_claims", "prov_members", "prov_mean_amount", "prov_near_ceiling_share",
    "mem_claims", "mem_total_amount", "mem_providers", "pair_claims_30d",
    "repeated_document", "in_network_too", "site_already_removed", "plan_rate",
]
PROVIDER_FEATURES = ["prov_claims", "prov_members", "prov_mean_amount", "prov_near_ceiling_share"]
MEMBER_FEATURES = ["mem_claims", "mem_total_amount", "mem_providers"]
ENTITY_FEATURES = PROVIDER_FEATURES + MEMBER_FEATURES
OWN_FEATURES = [
    "amount", "price_ratio", "days_to_request", "out_of_network", "region_mismatch",
    "near_ceiling", "plan_rate",
]
# Known only after the decision: never allowed into FEATURES.
AFTER_DECISION = ["status", "approved_amount", "denial_reason", "review_date"]

# --- fixed values: column names of the source tables -> names used here ------------------
SOURCE_NAMES = {
    "pedido_id": "claim_id",
    "beneficiario_id": "member_id",
    "prestador_id": "provider_id",
    "procedimento_id": "procedure_id",
    "plano_id": "plan_id",
    "codigo_tuss": "proc_code",
    "descricao": "description",
    "dente": "site",
    "data_procedimento": "proc_date",
    "data_solicitacao": "req_date",
    "data_realizacao": "proc_date",
    "valor_solicitado": "amount",
    "valor_procedimento": "amount",
    "hash_documento": "document",
    "canal_solicitacao": "channel",
    "status": "status",
    "valor_reembolsado": "approved_amount",
    "motivo_glosa": "denial_reason",
    "data_analise": "review_date",
    "fraude_confirmada": "label",
    "persona_fraude": "scenario",
    "nome": "member_name",
    "cpf": "national_id",
    "data_nascimento": "birth_date",
    "genero": "gender",
    "uf": "region",
    "segmento": "segment",
    "data_adesao": "enrolled_on",
    "nome_plano": "plan_name",
    "mensalidade": "monthly_fee",
    "percentual_reembolso": "plan_rate",
    "nome_prestador": "provider_name",
    "cro": "licence",
    "especialidade": "specialty",
    "credenciado": "in_network",
    "data_credenciamento": "network_since",
    "nota_avaliacao": "rating",
    "plano": "plan_name",
    "endereco": "address",
    "bairro": "district",
    "cidade": "city",
    "latitude": "lat",
    "longitude": "lon",
    "planos_aceitos": "plans",
    "aceita_urgencia": "urgent",
    "telefone": "phone",
}
# Published feature names, in contract order.
CONTRACT_NAMES = {
    "amount": "valor_solicitado",
    "price_ratio": "razao_valor_ref",
    "days_since_enrolment": "dias_desde_adesao",
    "recent_enrolment": "carencia_recente",
    "out_of_network": "fora_da_rede",
    "region_mismatch": "uf_divergente",
    "near_ceiling": "prox_teto",
    "days_to_request": "dias_proc_solic",
    "prov_claims": "prest_n_pedidos",
    "prov_members": "prest_n_benef",
    "prov_mean_amount": "prest_valor_medio",
    "prov_near_ceiling_share": "prest_pct_prox_teto",
    "mem_claims": "benef_n_pedidos",
    "mem_total_amount": "benef_valor_total",
    "mem_providers": "benef_n_prestadores",
    "pair_claims_30d": "pedidos_par_30d",
    "repeated_document": "hash_repetido",
    "in_network_too": "existe_na_rede",
    "site_already_removed": "dente_ja_extraido",
    "plan_rate": "percentual_reembolso",
}


# Tables of the claims domain, under the names used here (DDL, never inferred).
DOMAIN = {
    "plans": (
        "plan_id BIGINT, plan_name STRING, segment STRING, monthly_fee DOUBLE, plan_rate DOUBLE"),
    "members": (
        "member_id BIGINT, member_name STRING, national_id STRING, birth_date DATE, gender STRING, "
        "region STRING, plan_id BIGINT, segment STRING, enrolled_on DATE, status STRING"),
    "providers": (
        "provider_id BIGINT, provider_name STRING, licence STRING, specialty STRING, region STRING, "
        "in_network BOOLEAN, network_since DATE, rating DOUBLE"),
    "network": (
        "procedure_id BIGINT, member_id BIGINT, provider_id BIGINT, proc_code STRING, "
        "description STRING, site STRING, proc_date DATE, amount DOUBLE"),
    "claims": (
        "claim_id BIGINT, member_id BIGINT, provider_id BIGINT, proc_code STRING, "
        "description STRING, site STRING, proc_date DATE, req_date DATE, amount DOUBLE, "
        "document STRING, channel STRING, status STRING, approved_amount DOUBLE, "
        "denial_reason STRING, review_date DATE, label BIGINT"),
    "provider_geo": (
        "provider_id BIGINT, provider_name STRING, licence STRING, specialty STRING, "
        "in_network BOOLEAN, rating DOUBLE, address STRING, district STRING, city STRING, "
        "region STRING, lat DOUBLE, lon DOUBLE, plans ARRAY<STRING>, urgent BOOLEAN, phone STRING"),
    "member_geo": (
        "member_id BIGINT, member_name STRING, national_id STRING, plan_name STRING, "
        "segment STRING, address STRING, district STRING, city STRING, region STRING, "
        "lat DOUBLE, lon DOUBLE, status STRING"),
}

# Parquet tables the registered queries read.
TABLES = {
    "region": ("r_regionkey INT, r_name STRING"),
    "nation": ("n_nationkey INT, n_name STRING, n_regionkey INT"),
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
    "supplier": ("s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"),
    "documents": (
        "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"),
    "embeddings": ("vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"),
    "pages": ("page_id BIGINT, url STRING, html STRING"),
    "benchmark": ("item_id BIGINT, text STRING"),
    "labels": ("doc_id BIGINT, quality INT, toxic INT"),
    "conversations": ("conv_id BIGINT, turn BIGINT, role STRING, text STRING"),
}
