"""Declared schemas and fixed values.

Types are declared, never inferred: a CSV whose ids are all digits must not
turn ``prd_id_in_store`` into numbers, and promotion text must stay text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values ---------------------------------------------------------
# These must equal the source system's values for results to match.

# Raw listing columns written by the store-A page extractor, in file order.
RAW_LISTING_COLUMNS = [
    "date",
    "category",
    "sub_category",
    "prd_name",
    "prd_brand",
    "prd_price",
    "prd_per_price",
    "prd_discount",
    "prd_link",
    "prd_img",
]

# Promotion category rules: first line of the promotion text, case-sensitive
# substring test, first rule that matches wins; no match -> null.
PROMO_RULES = [
    ("SAVE", "SAVING"),
    ("MIN", "MULTI"),
    ("Member", "MEMBER"),
    ("Points", "POINT"),
]

# Patterns (Python regex syntax). Product id: last path segment of the link,
# word characters to the end. Price: text after the first dollar sign. Unit
# price: price, base amount and unit word. Pick-up phrase removed from names.
PRODUCT_ID_PATTERN = r"/(\w+)$"
PRICE_PATTERN = r"\$(.*)"
UNIT_PRICE_PATTERN = r"\$(.*?)/(\d+)(\w+)"
PICKUP_PATTERN = r"\(\s*ID required at pick-up\s*\)"

# Words read as missing values by the default pandas CSV reader (pandas 2.x
# list). The source system passed every text column through such a reader,
# so these words become null. Exposed as a parameter of ``null_na_words``.
NA_WORDS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Store -> site root and store -> shard numbers of the weekly work list.
STORE_SITES = [
    ("Loblaws", "https://www.loblaws.ca/"),
    ("HMart", "https://www.hmart.com/"),
    ("Metro", "https://www.metro.ca/en/online-grocery/aisles"),
    ("NoFrills", "https://www.nofrills.ca/"),
]
STORE_SHARDS = [
    ("HMart", [1, 2, 3] + list(range(5, 14))),
    ("Loblaws", list(range(2, 16))),
    ("Metro", list(range(16))),
]

# Root prepended to relative product links of store A.
STORE_A_ROOT = "https://www.loblaws.ca"

# Store-A card selectors: field -> class attribute (a value with a blank
# matches the whole class attribute; one word matches any one class).
STORE_A_CARD_CLASSES = ["chakra-linkbox", "css-wsykbb"]  # all must be present
STORE_A_FIELDS = {
    "prd_name": "chakra-heading css-7nn9tu",
    "prd_brand": "chakra-text css-18dxtfe",
    "prd_price_regular": "chakra-text css-150rkla",
    "prd_price_sale": "chakra-text css-1shm0cj",
    "prd_per_price": "chakra-text css-8jdluo",
    "prd_discount": "chakra-text css-1x7try2",
    "prd_link": "chakra-linkbox__overlay css-1hnz6hu",
    "prd_img": "chakra-image css-112nh",
}
STORE_A_HEADING_CLASS = "chakra-heading css-zmvp7m"
STORE_A_NOTICE_CLASS = "chakra-text css-29j2bl"
STORE_A_EMPTY_NOTICE = "No items are available."
STORE_A_CONTENT_ID = "site-content"
STORE_A_NAV_TESTID = "nav-list-link"
STORE_A_NAV_TEXT = "See All"

# Store-B listing page: product cards and their image.
STORE_B_CARD_CLASS = "item product product-item"
STORE_B_IMG_CLASS = "product-image-photo"
STORE_B_PRICE_CLASS = "price"
STORE_B_SPEC_FIELDS = ["prd_brand", "prd_name", "average_unit", "prd_id_in_store"]

# Batch-job failure notice pattern.
FAILURE_DETAIL_TYPE = "Batch Job State Change"
FAILURE_SOURCE = "aws.batch"
FAILURE_STATUS = "FAILED"

# Scrape-day and processing-time zone; file names use a fixed UTC-5 offset.
STORE_TZ = "America/Toronto"
FILE_NAME_OFFSET = "-05:00"

# Work-list job name prefix.
JOB_PREFIX = "daily_scrapping"

# --- schemas ----------------------------------------------------------------

RAW_LISTING_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RAW_LISTING_COLUMNS]
)

PRICE_TYPE = T.DecimalType(12, 2)
UNIT_PRICE_TYPE = T.DecimalType(12, 4)
UNIT_BASE_TYPE = T.DecimalType(8, 0)

CLEAN_LISTING_SCHEMA = T.StructType(
    [
        T.StructField("scrap_date", T.DateType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("sub_category", T.StringType(), True),
        T.StructField("prd_name", T.StringType(), True),
        T.StructField("prd_brand", T.StringType(), True),
        T.StructField("prd_price", PRICE_TYPE, True),
        T.StructField("prd_discount", T.StringType(), True),
        T.StructField("prd_link", T.StringType(), True),
        T.StructField("prd_img", T.StringType(), True),
        T.StructField("prd_id_in_store", T.StringType(), True),
        T.StructField("store", T.StringType(), True),
        T.StructField("on_sale_cat", T.StringType(), True),
        T.StructField("average_unit", T.StringType(), True),
        T.StructField("price_per_unit_1", T.StringType(), True),
        T.StructField("price_per_unit_2", T.StringType(), True),
    ]
)
CLEAN_COLUMNS = [f.name for f in CLEAN_LISTING_SCHEMA.fields]

# Store-B rows come out of the page extractor already in clean names.
STORE_B_SCHEMA = T.StructType(
    [
        T.StructField("scrap_date", T.DateType(), True),
        T.StructField("prd_url", T.StringType(), True),
        T.StructField("prd_img", T.StringType(), True),
        T.StructField("prd_discount", T.BooleanType(), True),
        T.StructField("sub_category", T.StringType(), True),
        T.StructField("store", T.StringType(), True),
        T.StructField("org_price", T.StringType(), True),
        T.StructField("prd_price", T.StringType(), True),
        T.StructField("on_sale_cat", T.StringType(), True),
        T.StructField("prd_brand", T.StringType(), True),
        T.StructField("prd_name", T.StringType(), True),
        T.StructField("average_unit", T.StringType(), True),
        T.StructField("prd_id_in_store", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
    ]
)

JOB_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("detail_type", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("job_name", T.StringType(), True),
    ]
)

DEFAULT_UPSERT_KEY = ["store", "prd_id_in_store", "scrap_date"]

# reasons of P-23 that the quality figures count one by one
REJECT_REASONS = ("product_id", "date", "price", "parts", "unit_prices", "unit", "columns", "unknown_store")
