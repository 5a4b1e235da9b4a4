"""Column names of the logical schemas used across the library.

The transaction columns keep the names of the conformed transactions table the
KPI job reads, so that a mart built here has the same column names as before.
"""

# transactions (fact)
CUSTOMER = "idi_counterparty_gr"
TRX_DATE = "dat_date_type_1"
AMOUNT = "cua_amount_type_1"
TXN_ID = "idi_turnover"
BU = "bu"
SOURCE_SYSTEM = "cod_sor_gr"
COUNTRY = "des_country_name"
BRAND = "des_maf_brand_name"

TRANSACTION_COLUMNS = [CUSTOMER, TRX_DATE, AMOUNT, TXN_ID, BU, SOURCE_SYSTEM, COUNTRY, BRAND]

# external id map (dimension)
ORG_CODE = "org_code"
GCR_ID = "gcr_id"
EXTERNAL_ID = "external_id"

# increments and audit tables
INC_DATE = "trx_date"
AUDIT_COLUMNS = [
    "hash", "dag_name", "source_tables", "target_table", "status", "start_ts",
    "end_ts", "source_count", "target_count", "trx_date", "run_date",
]

# profile output
PROFILE_COLUMN = "column_name"
PROFILE_COUNT = "non_null_count"
