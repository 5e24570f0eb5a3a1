"""An access log out of an event table and a page table.

Sample data has no access log, so one is derived: an event is a request, the
page it falls on gives URL and domain. Everything that depends on the page only
is computed on the page side, before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.domains import SuffixLists
from hitledger.functions.times import day_of, five_minutes_of, hour_of
from hitledger.functions.urls import encode

# Dimension lists that go with the derived log.
SUFFIXES = SuffixLists(generic=("com", "net", "org"), area=("js.cn",), country=("cn",))
FOREIGN = ["ru"]
HOUSE_IP_COUNT = 24  # 203.0.113.0 - 203.0.113.23 of the 32 addresses in use


def house_ips(spark: SparkSession) -> DataFrame:
    return spark.range(HOUSE_IP_COUNT).select(F.concat(F.lit("203.0.113."), F.col("id").cast("string")).alias("hip"))


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
PAGES = "page_id bigint, url string"

_HOST = "regexp_extract(url, '^https?://([^/]+)', 1)"
_DOMAIN = f"""case page_id % 8
    when 1 then concat({_HOST}, '.cn') when 2 then concat({_HOST}, '.js.cn') when 3 then concat({_HOST}, ':8080')
    when 4 then concat('203.0.113.', page_id % 250) when 5 then 'bad host!' when 6 then concat({_HOST}, '.ru')
    when 7 then 'site.cn' else {_HOST} end"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``access_log`` rows with their ``event_id``, unix ``second`` and event ``amount``."""
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    pages = spark.read.schema(PAGES).parquet(f"{sf_dir}/pages.parquet")
    n_pages = pages.agg(F.count(F.lit(1))).scalar()
    # Time text is generated, so that it is made once and not again in every filter.
    once = F.explode(F.array(F.col("ts").cast("string").substr(1, 19)))
    event_side = events.select("*", (F.col("event_id") % n_pages).alias("page_id"), once.alias("acctime")).selectExpr(
        "event_id",
        "page_id",
        "acctime",
        "cast(1001 + user_id % 4 as int) as hid",
        "concat('10.0.', user_id div 256, '.', user_id % 256) as srcip",
        "concat('203.0.113.', event_id % 32) as destip",
        "case event_type when 'view' then '1' when 'click' then '2' when 'purchase' then '3'"
        " when 'signup' then '4' else '5' end as proctype",
        "cast(1024 + event_id % 50000 as string) as srcport",
        "case event_id % 3 when 0 then '80' when 1 then '443' else '8080' end as destport",
        "cast(cast(floor(value) as bigint) as string) as duration",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) as second",
        "value as amount",
    )
    page_side = pages.select("page_id", F.expr(_DOMAIN).alias("domain"), encode(F.col("url")).alias("url"))
    return event_side.join(page_side, "page_id").drop("page_id")


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    acctime = F.col("acctime")
    return requests(spark, sf_dir).select(
        "hid", "srcip", "destip", "proctype", "srcport", "destport", "domain", "url", "duration", "acctime",
        day_of(acctime).alias("d"), hour_of(acctime).alias("h"), five_minutes_of(acctime).alias("m5"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as raw text lines, with ``event_id`` and ``acctime`` beside them."""
    fields = ["hid", "srcip", "destip", "proctype", "srcport", "destport", "domain", "url", "duration", "second"]
    line = F.concat_ws("|", *[F.col(f).cast("string") for f in fields])
    return requests(spark, sf_dir).select("event_id", "acctime", line.alias("value"))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, some with every kind of damage a parser has to survive."""
    kind, value = F.col("event_id") % 16, F.col("value")
    damaged = (
        F.when(kind == 1, F.regexp_replace(value, r"\|[^|]*$", ""))                 # nine fields
        .when(kind == 2, F.concat(value, F.lit("|extra")))                         # eleven fields
        .when(kind == 3, F.regexp_replace(value, r"\|[^|]*$", "|"))                 # no time
        .when(kind == 4, F.regexp_replace(value, r"\|[^|]*$", "|abc"))              # unreadable time
        .when(kind == 5, F.concat(F.lit("x"), value))                              # unreadable house
        .when(kind == 6, F.concat(F.lit(" "), value))                              # blank before the house
        .when(kind == 7, F.regexp_replace(value, r"^(([^|]*\|){6})([^|]*)", "$1 \t$3 "))  # blanks around the domain
        .when(kind == 8, F.concat(value, F.lit("||")))                             # empty fields at the end
        .otherwise(value)
    )
    return raw_lines(spark, sf_dir).select("event_id", "acctime", damaged.alias("value"))
