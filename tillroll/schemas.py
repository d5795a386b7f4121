"""Declared schemas and fixed business values of the retail warehouse.

The raw layer is all text so ingestion never fails on a bad value; typing
happens once, in staging.  Everything below the "fixed values" marker must
equal the business rules of the original warehouse for results to match.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The eight source columns, in file order.
RAW_COLUMNS = (
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)

RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

RAW_SCHEMA = T.StructType(
    [T.StructField("raw_row_id", T.LongType(), False)]
    + list(RAW_TEXT_SCHEMA.fields)
    + [
        T.StructField("source_file", T.StringType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)

MONEY = T.DecimalType(18, 2)
PRICE = T.DecimalType(18, 4)
AMOUNT = T.DecimalType(20, 4)

# Non-deterministic load stamps: carried in the tables, left out of compared outputs.
LOAD_STAMPS = ("ingested_at", "raw_ingested_at", "staged_at", "created_at", "warehouse_loaded_at")

# ---------------------------------------------------------------------------
# Fixed values (must equal the original warehouse's rules)
# ---------------------------------------------------------------------------

DEFAULT_SOURCE_FILE = "online_retail.csv"

CANCEL_PREFIX = "C"
# Record type of a line: the first rule that holds, in SQL that both engines read.
RECORD_TYPE_RULES = (
    ("CANCELLATION", f"invoice_no LIKE '{CANCEL_PREFIX}%'"),
    ("ACCOUNTING_ADJUSTMENT", "unit_price < 0"),
    ("STOCK_ADJUSTMENT", "quantity < 0"),
    ("ZERO_PRICE", "unit_price = 0"),
    ("SALE", "quantity > 0 AND unit_price > 0"),
)
OTHER_RECORD_TYPE = "OTHER"
RECORD_TYPES = (*(label for label, _ in RECORD_TYPE_RULES), OTHER_RECORD_TYPE)
NET_RECORD_TYPES = ("SALE", "CANCELLATION")

# Product category by normalised stock code.
SHIPPING_FEE_CODES = ("DOT", "POST", "C2")
FINANCIAL_ADJUSTMENT_CODES = ("AMAZONFEE", "B", "BANK CHARGES", "CRUK", "D")
MANUAL_CODES = ("M",)
SAMPLE_CODES = ("S",)
GIFT_VOUCHER_PREFIX = "GIFT_"
# (category, its codes); a voucher is known by its prefix, all else is merchandise.
CATEGORY_CODES = (
    ("SHIPPING_FEE", SHIPPING_FEE_CODES),
    ("FINANCIAL_ADJUSTMENT", FINANCIAL_ADJUSTMENT_CODES),
    ("MANUAL", MANUAL_CODES),
    ("SAMPLE", SAMPLE_CODES),
)
VOUCHER_CATEGORY = "GIFT_VOUCHER"
MERCHANDISE_CATEGORY = "MERCHANDISE"
PRODUCT_CATEGORIES = (*(label for label, _ in CATEGORY_CODES), VOUCHER_CATEGORY, MERCHANDISE_CATEGORY)

# Unknown dimension members (reserved key 0).
UNKNOWN_KEY = 0
UNKNOWN_NAME = "[UNKNOWN]"
UNKNOWN_PRODUCT_DESCRIPTION = "Unknown product"
UNKNOWN_CATEGORY = "UNKNOWN"

MISSING_DESCRIPTION_LABEL = "[missing]"

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
# ISO weekday 1..7
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
WEEKEND_ISO_DAYS = (6, 7)

# Raw-format patterns (anchored at both ends; see functions.text for the Java anchor).
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
DECIMAL_PATTERN = r"^[+-]?[0-9]+(\.[0-9]+)?$"
DIGITS_PATTERN = r"^[0-9]+$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
# What staging takes for a timestamp: a whole date, alone or with a time of day.
TYPED_TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"

# Order-frequency segments: (label, lowest order count, highest order count or None).
FREQUENCY_SEGMENTS = (
    ("ONE_TIME", 1, 1),
    ("REPEAT_2_TO_5", 2, 5),
    ("REPEAT_6_TO_10", 6, 10),
    ("HIGHLY_RECURRENT", 11, None),
)

# RFM segment of a customer: the first rule that holds for the three scores.
RFM_SEGMENT_RULES = (
    ("CHAMPIONS", "recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4"),
    ("LOYAL_CUSTOMERS", "recency_score >= 3 AND frequency_score >= 3"),
    ("PROMISING", "recency_score >= 4 AND frequency_score <= 2"),
    ("AT_RISK", "recency_score <= 2 AND frequency_score >= 3"),
    ("HIBERNATING", "recency_score = 1 AND frequency_score <= 2"),
)
OTHER_RFM_SEGMENT = "NEEDS_ATTENTION"
RFM_SEGMENTS = (*(label for label, _ in RFM_SEGMENT_RULES), OTHER_RFM_SEGMENT)
RFM_TILES = 5

# Validation constants of the original full data set (parameters, not assumptions).
EXPECTED_RAW_ROWS = 541_909
EXPECTED_NORMALIZED_PRODUCTS = 3_958

# Top-k sizes of the reports.
TOP_COUNTRIES_ROWS = 10
TOP_PROFILE_ROWS = 15
TOP_PRODUCTS_ROWS = 10
TOP_CUSTOMERS_ROWS = 10
PARETO_ROWS = 20
MOST_CANCELLED_ROWS = 20

# What the stored tables are.
TABLE_COMMENTS = {
    "raw/online_retail": "Raw layer: invoice lines as text, exactly as read, with their lineage.",
    "staging/transactions": "Staging layer: one typed and classified row per raw line, exact copies marked.",
    "warehouse/dim_customer": "Identified customers and the unknown customer.",
    "warehouse/dim_product": "Products by normalised code, with description and category, and the unknown product.",
    "warehouse/dim_country": "Countries of the invoices and the unknown country.",
    "warehouse/dim_date": "Calendar days from the first to the last invoice and the unknown day.",
    "warehouse/fact_sales": "Warehouse layer: one row per distinct invoice line, keyed to the dimensions.",
}

# Column descriptions stored as field metadata ("comment") when layers are written.
COLUMN_COMMENTS = {
    "raw/online_retail": {
        "raw_row_id": "Position of the line in the ingested source, dense from 1.",
        "source_file": "Name of the file the line was read from.",
        "ingested_at": "Time the raw layer was loaded.",
    },
    "staging/transactions": {
        "raw_row_id": "Lineage key of the raw line this row was typed from.",
        "source_stock_code": "Trimmed product code with its original letter case.",
        "stock_code": "Trimmed, upper-cased product code used by the product dimension.",
        "line_amount": "Quantity times unit price, signed.",
        "record_type": "Business class of the line (sale, cancellation, adjustments, zero price, other).",
        "duplicate_rank": "Position of the line among exact copies of its raw values, by raw_row_id.",
        "duplicate_group_size": "Number of raw lines with exactly the same eight raw values.",
    },
    "warehouse/dim_customer": {
        "customer_key": "Surrogate key, dense in customer_id order; 0 is the unknown customer.",
        "customer_id": "Customer number of the source; null for the unknown customer only.",
    },
    "warehouse/dim_product": {
        "product_key": "Surrogate key, dense in stock_code order; 0 is the unknown product.",
        "product_description": "Most frequent description, then most recent, then alphabetical.",
        "product_category": "Service class of the code, MERCHANDISE for physical products.",
        "is_merchandise": "Whether the category is MERCHANDISE.",
    },
    "warehouse/dim_country": {
        "country_key": "Surrogate key, dense in name order; 0 is the unknown country.",
    },
    "warehouse/dim_date": {
        "date_key": "Day as YYYYMMDD; 0 is the unknown day.",
        "week_of_year": "ISO week number.",
        "day_of_week": "ISO weekday, Monday = 1.",
    },
    "warehouse/fact_sales": {
        "sales_key": "Surrogate key, dense in raw_row_id order.",
        "raw_row_id": "Lineage key of the first occurrence of the line's duplicate group.",
        "invoice_no": "Invoice number; a leading C marks a cancellation.",
        "line_amount": "Quantity times unit price, signed.",
        "source_duplicate_group_size": "Copies of this line in the raw layer.",
    },
}
