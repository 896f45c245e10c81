"""Table layouts, source column names and the fixed seed rows."""

from __future__ import annotations

from pyspark.sql import types as T

from foliomart.functions import numeric as n


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema_of(text: str) -> T.StructType:
    """A schema from ``name type, name type``; unlike ``fromDDL`` it needs no running session."""
    fields = []
    for column in text.split(", "):
        name, dtype = column.split()
        if dtype.startswith("decimal"):
            precision, scale = dtype[8:-1].split(",")
            kind = T.DecimalType(int(precision), int(scale))
        else:
            kind = _TYPES[dtype]
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


# Source header -> staging column, one map per extract. The headers are the
# contract with whoever delivers the files.
SALES_COLUMNS = {
    "SaleNum": "sale_num",
    "DateStamp": "date_stamp",
    "EdID": "ed_id",
    "Chnl": "chnl",
    "TQty": "tqty",
    "UPrice": "uprice",
    "Curr": "curr",
    "Dscnt": "dscnt",
    "PD": "pd",
    "BC": "bc",
    "VScr": "vscr",
    "Typ": "typ",
}
DAILY_COLUMNS = {
    "DateID": "date_stamp",
    "StnCode": "stn_code",
    "PD": "pd",
    "BC": "bc",
    "US": "us",
    "RV": "rv",
    "Rev": "rev",
    "Tmp": "tmp",
    "Hmd": "hmd",
    "VScr": "vscr",
    "Typ": "typ",
    "Notes": "notes",
}
META_COLUMNS = {
    "station/id": "station_id",
    "station/name": "station_name",
    "station/region": "station_region",
    "station/mgr": "station_mgr",
    "station/address": "station_address",
    "vendor/id": "vendor_id",
    "vendor/name": "vendor_name",
    "vendor/score": "vendor_score",
    "vendor/services/0/type": "vendor_svc_type_1",
    "vendor/services/0/qual": "vendor_svc_qual_1",
    "vendor/services/1/type": "vendor_svc_type_2",
    "vendor/services/1/qual": "vendor_svc_qual_2",
    "publication/ed": "publication_ed",
    "publication/title": "publication_title",
    "publication/cat": "publication_cat",
    "publication/lang": "publication_lang",
    "publication/author": "publication_author",
    "author/id": "author_id",
    "author/first_name": "author_first_name",
    "author/last_name": "author_last_name",
    "author/country": "author_country",
    "author/primary_genre": "author_primary_genre",
}

SOURCE_COLUMNS = {"raw_sales": SALES_COLUMNS, "raw_daily": DAILY_COLUMNS, "raw_meta": META_COLUMNS}
STAGING_ID = {"raw_sales": "stg_sales_id", "raw_daily": "stg_daily_id", "raw_meta": "stg_meta_id"}
NUMERIC_COLUMNS = {
    "raw_sales": ["tqty", "uprice", "dscnt", "pd", "bc", "vscr"],
    "raw_daily": ["pd", "bc", "us", "rv", "rev", "tmp", "hmd", "vscr"],
    "raw_meta": ["vendor_score"],
}

TRACKING = {
    "source_filename": "string",
    "load_date": "timestamp",
    "validation_status": "string",
    "validation_errors": "string",
    "processed_flag": "string",
    "processed_date": "timestamp",
}


def source_schema(source: str) -> T.StructType:
    """Every cell as text: a bad cell is a finding, not a failed read."""
    return T.StructType([T.StructField(c, T.StringType()) for c in SOURCE_COLUMNS[source]])


def staging_schema(source: str) -> T.StructType:
    """Staging id, source columns (numbers typed), parsed date, imputed discount, tracking."""
    fields = [f"{STAGING_ID[source]} bigint"]
    for column in SOURCE_COLUMNS[source].values():
        dtype = n.STAGED if column in NUMERIC_COLUMNS[source] else "string"
        fields.append(f"{column} {dtype}")
        if column == "date_stamp":
            fields.append("date_parsed date")
        if column == "dscnt":
            fields.append(f"discount_imputed {n.STAGED}")
    fields += [f"{name} {dtype}" for name, dtype in TRACKING.items()]
    return schema_of(", ".join(fields))


BATCH_LOG = schema_of(
    "batch_id bigint, batch_name string, start_time timestamp, end_time timestamp, status string,"
    " records_processed bigint, records_failed bigint, error_message string,"
    " created_by string, created_date timestamp"
)
STEP_LOG = schema_of(
    "step_id bigint, batch_id bigint, step_name string, start_time timestamp, end_time timestamp,"
    " status string, records_processed bigint, records_failed bigint, error_message string"
)
QUALITY_LOG = schema_of(
    "source_table string, validation_rule string, severity string, validation_date timestamp,"
    " total_records bigint, valid_records bigint, invalid_records bigint, error_details string,"
    " batch_id bigint"
)
STATUSES = ["STARTED", "RUNNING", "COMPLETED", "FAILED", "CANCELLED"]

FACT_SALES = schema_of(
    "sales_fact_key bigint, time_key int, product_key bigint, author_key bigint, dc_key bigint,"
    " vendor_key bigint, channel_key bigint, product_type_key bigint, currency_key bigint,"
    f" sale_number string, quantity_sold {n.QUANTITY}, unit_price_original {n.MONEY},"
    f" unit_price_gbp {n.MONEY}, discount_rate {n.DISCOUNT}, discount_amount_gbp {n.MONEY},"
    f" gross_amount_gbp {n.MONEY}, net_amount_gbp {n.MONEY}, print_run_qty bigint,"
    f" binding_cost_gbp {n.MONEY}, unit_cost_gbp {n.MONEY}, total_cost_gbp {n.MONEY},"
    f" gross_profit_gbp {n.MONEY}, gross_margin_pct {n.PERCENT}, vendor_score {n.SCORE},"
    " source_system string, source_record_id string, load_date timestamp, load_batch_id bigint,"
    " created_date timestamp, created_by string"
)
FACT_DAILY = schema_of(
    "daily_ops_fact_key bigint, time_key int, product_key bigint, dc_key bigint,"
    " vendor_key bigint, product_type_key bigint, print_run_qty bigint,"
    f" binding_cost_gbp {n.MONEY}, units_sold bigint, returns_qty bigint, net_units bigint,"
    f" revenue_gbp {n.MONEY}, unit_binding_cost {n.UNIT_COST}, cost_of_goods_sold {n.MONEY},"
    f" gross_profit_gbp {n.MONEY}, gross_margin_pct {n.PERCENT},"
    f" print_run_utilization {n.PERCENT}, return_rate_pct {n.PERCENT},"
    f" temperature_celsius {n.TEMPERATURE}, humidity_pct int, vendor_score {n.SCORE},"
    " notes string, source_system string, source_record_id string, load_date timestamp,"
    " load_batch_id bigint, created_date timestamp, created_by string"
)

_VERSION = (
    "effective_date date, expiry_date date, is_current string, record_version int,"
    " created_date timestamp, created_by string, modified_date timestamp, modified_by string"
)
_AUDIT = "created_date timestamp, created_by string, modified_date timestamp, modified_by string"

DIM_AUTHOR = schema_of(
    "author_key bigint, author_id string, first_name string, last_name string, full_name string,"
    f" country string, primary_genre string, {_VERSION}"
)
DIM_VENDOR = schema_of(
    f"vendor_key bigint, vendor_id string, vendor_name string, vendor_score {n.SCORE},"
    " service_type_1 string, service_quality_1 string, service_type_2 string,"
    f" service_quality_2 string, avg_delivery_days {n.PERCENT}, on_time_percentage {n.PERCENT},"
    f" cost_variance_pct {n.PERCENT}, {_VERSION}"
)
DIM_DC = schema_of(
    "dc_key bigint, station_code string, station_name string, station_region string,"
    " station_country string, manager_id string, station_address string, postcode string,"
    f" region_code string, region_name string, {_VERSION}"
)
DIM_PRODUCT = schema_of(
    "product_key bigint, edition_id string, product_title string, product_category string,"
    f" product_language string, author_key bigint, vendor_key bigint, {_VERSION}"
)
DIM_CHANNEL = schema_of(
    "channel_key bigint, channel_code string, channel_name string, channel_type string,"
    f" commission_rate {n.PERCENT}, average_delivery_days int, {_AUDIT}"
)
DIM_PRODUCT_TYPE = schema_of(
    "product_type_key bigint, product_type_code string, product_type_name string,"
    f" is_physical string, weight_kg decimal(5,3), typical_margin_pct {n.PERCENT}, {_AUDIT}"
)
DIM_CURRENCY = schema_of(
    "currency_key bigint, currency_code string, currency_name string, currency_symbol string,"
    f" is_base_currency string, decimal_places int, {_AUDIT}"
)
EXCHANGE_RATE = schema_of(
    "exchange_rate_key bigint, from_currency_key bigint, to_currency_key bigint, time_key int,"
    f" exchange_rate {n.RATE}, rate_date date, rate_source string,"
    " created_date timestamp, created_by string"
)

# First surrogate keys of dimensions and facts, and the unknown member.
FIRST_DIM_KEY = 1000
FIRST_FACT_KEY = 100000
UNKNOWN_KEY = -1

# Seed rows of the three code tables.
CHANNEL_SEED = [
    ("CH001", "Amazon", "Online"),
    ("CH002", "Barnes & Noble", "Online"),
    ("CH003", "In_Store", "Physical"),
]
PRODUCT_TYPE_SEED = [
    ("HRD", "Hardcover", "Y"),
    ("PBK", "Paperback", "Y"),
    ("EBK", "e-Book", "N"),
]
CURRENCY_SEED = [
    ("GBP", "British Pound", "£", "Y", 2),
    ("USD", "US Dollar", "$", "N", 2),
    ("EUR", "Euro", "€", "N", 2),
]
# Rates into the base currency where no dated rate exists; others count as 1.
DEFAULT_RATES = {"USD": "0.79", "EUR": "0.85"}
