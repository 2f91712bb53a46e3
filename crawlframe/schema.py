"""Fixed table schemas of the crawl store."""

from __future__ import annotations

from pyspark.sql import types as T

FRONTIER = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("parent_url", T.StringType(), True),
])

DATA_TYPE = T.StructType([T.StructField("code", T.StringType(), False)])

PAGE_TYPE = T.StructType([T.StructField("code", T.StringType(), False)])

SITE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("domain", T.StringType(), True),
    T.StructField("robots_content", T.StringType(), True),
    T.StructField("sitemap_content", T.StringType(), True),
])

PAGE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("site_id", T.LongType(), True),
    T.StructField("page_type_code", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("html_content", T.StringType(), True),
    T.StructField("http_status_code", T.IntegerType(), True),
    T.StructField("accessed_time", T.TimestampType(), True),
    T.StructField("html_hash", T.StringType(), True),
])

PAGE_DATA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("data_type_code", T.StringType(), True),
    T.StructField("data", T.BinaryType(), True),
])

IMAGE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("page_id", T.LongType(), True),
    T.StructField("filename", T.StringType(), True),
    T.StructField("content_type", T.StringType(), True),
    T.StructField("data", T.BinaryType(), True),
    T.StructField("accessed_time", T.TimestampType(), True),
])

LINK = T.StructType([
    T.StructField("from_page", T.LongType(), False),
    T.StructField("to_page", T.LongType(), False),
])

# The codes of the two code tables.
DATA_TYPE_CODES = ["PDF", "DOC", "DOCX", "PPT", "PPTX"]
PAGE_TYPE_CODES = ["HTML", "BINARY", "DUPLICATE", "FRONTIER"]

# Hosts a crawl starts from and hosts it leaves out, if the caller gives none.
SEED_HOSTS = [
    "www.arso.gov.si",
    "www.gu.gov.si",
    "mop.gov.si",
    "mju.gov.si",
    "www.ess.gov.si",
]
EXCLUDED_HOSTS = [
    "evem.gov.si",
    "e-uprava.gov.si",
    "podatki.gov.si",
    "www.e-prostor.gov.si",
]

# The registered domain a crawl is kept to, as (domain, public suffix).
REGISTERED_DOMAINS = [("gov", "si")]

# Fixed value: seconds between two fetches of a host whose robots text names no limit.
DEFAULT_LIMIT_S = 5.0
