"""Named queries over the sample tables, one per operator.

Each takes (spark, sf_dir) and returns a DataFrame over the whole derived log.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.functions.domains import add_top_domain
from hitledger.functions.net import ip_to_long
from hitledger.functions.sql_names import register_sql_functions
from hitledger.functions.urls import decode
from hitledger.operators import compaction, layout, legality, lookup, rollup
from hitledger.operators.cells import to_cells
from hitledger.operators.ingest import drop_late, ingest_rows
from hitledger.operators.search import search, search_both, search_lines
from hitledger.plans.compact import merge_files
from hitledger.plans.day import MERGES, run_day_stats
from hitledger.plans.hour import run_hour_stats, run_legal_hour_stats
from hitledger.plans.lookup import run_domain_count
from hitledger.plans.search import run_search
from hitledger.plans.ingest import run_ingest
from hitledger.schema import ADDRESS_NUMBERS
from hitledger.sinks.cells import compact_cells, read_cells, start_cells
from hitledger.sinks.delimited import answer_lines, house_lines, read_answers, write_delimited
from hitledger.sinks.log_table import append, create_log_table, publish, register_batch
from hitledger.sinks.stat_tables import write_day_tsv
from hitledger.sources import demo, dimensions, lines
from hitledger.sources.tables import read_access_log, read_day_domains, read_hour_stats, read_log_table
from hitledger.streaming import hourly, intake
from hitledger.workspace import Files, stage_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ASKED_AT = "2024-01-15 12:00:00"
LOAD_TIME = "202401151200"
SEARCH_BEGIN, SEARCH_END = "2024-01-05 10:17:00", "2024-01-22 21:40:30"
# A thin log gets day directories, or days by house.
BY_DAY = ["d"]
BY_HOUSE_DAY = ["hid", "d"]
MONTH = ("2024-01-01 00:00:00", "2024-01-30 23:59:59")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hits(demo.access_log(spark, sf_dir))


# ---- hourly statistics ----------------------------------------------------


@query
def stat_hour_ipportdomain(spark, sf_dir):
    return rollup.hour_ipportdomain(_hits(spark, sf_dir))


@query
def stat_hour_ipport(spark, sf_dir):
    return rollup.hour_ipport(_hits(spark, sf_dir))


@query
def stat_hour_domainip(spark, sf_dir):
    return rollup.hour_domainip(_hits(spark, sf_dir), demo.SUFFIXES)


@query
def stat_hour_domain(spark, sf_dir):
    return rollup.hour_domain(_hits(spark, sf_dir), demo.SUFFIXES, demo.FOREIGN)


@query
def stat_hour_tree(spark, sf_dir):
    """domain from domainip from ipportdomain, as the staged job does it."""
    base = rollup.stored(stat_hour_ipportdomain(spark, sf_dir))
    per_ip = rollup.stored(rollup.hour_domainip(base, demo.SUFFIXES))
    return rollup.hour_domain(per_ip, demo.SUFFIXES, demo.FOREIGN)


@query
def stat_hour_foreign_split(spark, sf_dir):
    return rollup.split_foreign(stat_hour_domain(spark, sf_dir))[1]


@query
def stat_hour_domestic(spark, sf_dir):
    return rollup.split_foreign(stat_hour_domain(spark, sf_dir))[0]


@query
def stat_hour_legal_ipport(spark, sf_dir):
    return legality.legal_hour_ipport(_hits(spark, sf_dir), demo.house_ips(spark))


@query
def stat_hour_legal_domainip(spark, sf_dir):
    return legality.legal_hour_domainip(_hits(spark, sf_dir), demo.house_ips(spark), demo.SUFFIXES)


@query
def stat_hour_legal_domain(spark, sf_dir):
    legal = legality.legal_only(_hits(spark, sf_dir), demo.house_ips(spark))
    return legality.legal_hour_domain(legal, demo.SUFFIXES)


@query
def stat_hour_illegal(spark, sf_dir):
    return legality.hour_illegal(demo.access_log(spark, sf_dir), demo.house_ips(spark))


@query
def legality_flag(spark, sf_dir):
    """Counted by address first, so that the list meets aggregated rows."""
    counted = demo.access_log(spark, sf_dir).groupBy("hid", "domain", "destip").agg(F.count(F.lit(1)).alias("times"))
    flagged = legality.flag_legal(counted, demo.house_ips(spark), demo.SUFFIXES)
    return flagged.groupBy("hid", "topdomain", "iflegal").agg(F.sum("times").alias("times"))


# ---- daily statistics -----------------------------------------------------


@query
def stat_day_ipportdomain(spark, sf_dir):
    return rollup.day_ipportdomain(stat_hour_ipportdomain(spark, sf_dir))


@query
def stat_day_ipport(spark, sf_dir):
    return rollup.day_ipport(stat_hour_ipport(spark, sf_dir))


@query
def stat_day_domainip(spark, sf_dir):
    return rollup.day_domainip(stat_hour_domainip(spark, sf_dir))


@query
def stat_day_domain(spark, sf_dir):
    return rollup.day_domain(stat_hour_domestic(spark, sf_dir))


@query
def stat_day_topdomain(spark, sf_dir):
    return rollup.day_topdomain(stat_hour_domestic(spark, sf_dir))


@query
def stat_day_legal_domain(spark, sf_dir):
    return rollup.day_domain(stat_hour_legal_domain(spark, sf_dir), drop_no_topdomain=False)


@query
def stat_day_legal_topdomain(spark, sf_dir):
    return rollup.day_topdomain(stat_hour_legal_domain(spark, sf_dir), drop_no_topdomain=False)


@query
def stat_day_illegal(spark, sf_dir):
    return rollup.day_illegal(stat_hour_illegal(spark, sf_dir))


# ---- search ---------------------------------------------------------------


def _search(spark, sf_dir, begin=SEARCH_BEGIN, **filters):
    return search(demo.access_log(spark, sf_dir), begin, SEARCH_END, **filters)


@query
def search_time_range(spark, sf_dir):
    return _search(spark, sf_dir)


@query
def search_time_ip_range(spark, sf_dir):
    return _search(
        spark, sf_dir, srcip_begin="10.0.0.9", srcip_end="10.0.0.200",
        destip_begin="203.0.113.4", destip_end="203.0.113.20",
    )


@query
def search_ip_upper_only(spark, sf_dir):
    return _search(spark, sf_dir, srcip_end="10.0.0.40", destip_begin="NI", domain="#", url="")


@query
def search_domain_port_proto(spark, sf_dir):
    return _search(spark, sf_dir, domain="site.cn", destport="443", proctype="1")


@query
def search_srcport(spark, sf_dir):
    return _search(spark, sf_dir, begin=MONTH[0], srcport="1524")


@query
def search_url_exact(spark, sf_dir):
    url = "http://ththre.example.com/fr/825?page=2&ref=x"
    return _search(spark, sf_dir, url=url)


@query
def search_url_encoded(spark, sf_dir):
    encoded = "aHR0cDovL3RodGhyZS5leGFtcGxlLmNvbS9mci84MjU/cGFnZT0yJnJlZj14"
    return _search(spark, sf_dir, url=encoded, url_mode="encoded")


@query
def search_url_prefix(spark, sf_dir):
    return _search(spark, sf_dir, url="http://", url_mode="prefix")


@query
def search_url_encoded_prefix(spark, sf_dir):
    return _search(spark, sf_dir, url="https://m", url_mode="encoded_prefix")


@query
def search_lookback(spark, sf_dir):
    return _search(spark, sf_dir, max_lookback_hours=36)


@query
def search_orc_and_text(spark, sf_dir):
    both = {"domain": "site.cn", "srcip_begin": "10.0.0.3"}
    second = 1704067200  # 2024-01-01 00:00:00
    strict = lines.parse_strict(demo.raw_lines(spark, sf_dir))
    text_hits = search_lines(strict, second + 4 * 86400, second + 21 * 86400, hid=1002, **both)
    return search_both(_search(spark, sf_dir, **both), text_hits)


# ---- raw lines and ingest -------------------------------------------------


@query
def parse_tolerant(spark, sf_dir):
    return lines.parse_tolerant(demo.damaged_lines(spark, sf_dir), zone="UTC")


@query
def parse_strict(spark, sf_dir):
    return lines.parse_strict(demo.damaged_lines(spark, sf_dir))


@query
def parse_rejects(spark, sf_dir):
    return lines.rejects(parse_tolerant(spark, sf_dir))


@query
def scan_domains(spark, sf_dir):
    """Hits per domain among lines of nine fields."""
    domains = lines.domains_of(demo.damaged_lines(spark, sf_dir), n_fields=9)
    return domains.groupBy("domain").agg(F.count(F.lit(1)).alias("times"))


@query
def ingest_lateness(spark, sf_dir):
    return drop_late(parse_tolerant(spark, sf_dir), LOAD_TIME)


@query
def ingest_layout_counts(spark, sf_dir):
    rows = ingest_rows(demo.damaged_lines(spark, sf_dir), LOAD_TIME, "b1", "UTC")
    return rows.groupBy("hid", "d", "h", "m5", "batch").agg(F.count(F.lit(1)).alias("row_count"))


def _day_counts(spark, root):
    return read_access_log(spark, root).groupBy("hid", "d", "batch").agg(F.count(F.lit(1)).alias("row_count"))


@query
def ingest_idempotent(spark, sf_dir):
    """Two batches published, the first one twice."""
    root = stage_dir(spark, "idempotent")
    first = ingest_rows(demo.raw_lines(spark, sf_dir), "202401010200", "b1", "UTC")
    second = ingest_rows(demo.raw_lines(spark, sf_dir), LOAD_TIME, "b2", "UTC")
    for rows in (first, second, first):
        publish(rows, root, BY_DAY)
    return _day_counts(spark, root)


@query
def ingest_append(spark, sf_dir):
    """Appended twice, so every row is there twice; late and unreadable rows too."""
    root = stage_dir(spark, "append")
    rows = parse_tolerant(spark, sf_dir).withColumn("batch", F.lit("b1"))
    for _ in range(2):
        append(rows, root, BY_DAY)
    return _day_counts(spark, root)


def _house_files(spark, sf_dir):
    """Damaged lines as files of a minute, by house."""
    root = stage_dir(spark, "houses")
    rows = demo.damaged_lines(spark, sf_dir).select("value", (F.lit(1001) + F.col("event_id") % 4).alias("hid"))
    rows.write.partitionBy("hid").text(f"{root}/{LOAD_TIME}")
    return f"{root}/{LOAD_TIME}"


@query
def ingest_sized(spark, sf_dir):
    """Published by write tasks that the bytes of each house's files ask for."""
    root = stage_dir(spark, "sized")
    run_ingest(spark, _house_files(spark, sf_dir), root, LOAD_TIME, LOAD_TIME, "UTC", by=BY_DAY, task_mb=0.5)
    return read_access_log(spark, root).drop("batch", *ADDRESS_NUMBERS)


# ---- domain counts --------------------------------------------------------

ASKED = {"batch_id": "q1", "asked_at": ASKED_AT}


@query
def domain_count(spark, sf_dir):
    return lookup.count_in_stats(stat_hour_domain(spark, sf_dir), "site.cn", **ASKED)


@query
def topdomain_count(spark, sf_dir):
    return lookup.count_in_stats(stat_hour_domain(spark, sf_dir), "example.com", by_top_domain=True, **ASKED)


@query
def domain_count_day(spark, sf_dir):
    """From day statistics written as TSV and read back."""
    root = stage_dir(spark, "day")
    write_day_tsv(stat_day_domain(spark, sf_dir), f"{root}/domain", "domain")
    return lookup.count_in_stats(read_day_domains(spark, root), "site.cn", by_top_domain=True, **ASKED)


@query
def domain_count_lines(spark, sf_dir):
    domains = lines.domains_of(demo.damaged_lines(spark, sf_dir))
    return lookup.count_in_lines(domains, "example.org", suffixes=demo.SUFFIXES, **ASKED)


@query
def domain_count_hybrid(spark, sf_dir):
    return lookup.count_domain(
        stat_hour_domain(spark, sf_dir), lines.domains_of(demo.raw_lines(spark, sf_dir)), "site.cn",
        query_day="20240115", **ASKED,
    )


@query
def answer_log_lines(spark, sf_dir):
    return answer_lines(domain_count_hybrid(spark, sf_dir))


# ---- jobs over the stored log ---------------------------------------------


def _stored_log(spark, sf_dir):
    root = stage_dir(spark, "log")
    publish(demo.access_log(spark, sf_dir).withColumn("batch", F.lit("b1")), root, BY_HOUSE_DAY)
    return root


def _hour_tables(spark, sf_dir, foreign=demo.FOREIGN):
    root = stage_dir(spark, "hours")
    run_hour_stats(spark, _stored_log(spark, sf_dir), root, *MONTH, demo.SUFFIXES, foreign, by=BY_HOUSE_DAY)
    return root


@query
def job_hour_domain(spark, sf_dir):
    return read_hour_stats(spark, _hour_tables(spark, sf_dir), "domain", *MONTH)


@query
def job_hour_foreign(spark, sf_dir):
    return read_hour_stats(spark, _hour_tables(spark, sf_dir), "foreigndomain", *MONTH)


@query
def job_hour_legal(spark, sf_dir):
    root = stage_dir(spark, "legal")
    run_legal_hour_stats(spark, _stored_log(spark, sf_dir), root, *MONTH, demo.SUFFIXES, demo.house_ips(spark), by=BY_HOUSE_DAY)
    return read_hour_stats(spark, root, "domainip", *MONTH)


@query
def stat_hour_rerun(spark, sf_dir):
    """The hour job twice, with a foreign list the second time: no domestic row of the first run stays."""
    root, log = stage_dir(spark, "rerun"), _stored_log(spark, sf_dir)
    for foreign in ((), demo.FOREIGN):
        run_hour_stats(spark, log, root, *MONTH, demo.SUFFIXES, foreign, by=BY_HOUSE_DAY)
    return read_hour_stats(spark, root, "domain")


@query
def job_day_domain(spark, sf_dir):
    root = stage_dir(spark, "days")
    merges = {"domain": MERGES["domain"]}
    run_day_stats(spark, _hour_tables(spark, sf_dir), root, MONTH[0], last_day=MONTH[1], merges=merges)
    return read_day_domains(spark, root)


@query
def job_search(spark, sf_dir):
    """Houses and buckets chosen by directory, the rest by pushed filters; written as CSV and read back."""
    out = stage_dir(spark, "found")
    run_search(
        spark, _stored_log(spark, sf_dir), out, SEARCH_BEGIN, SEARCH_END, hids=[1001, 1003],
        destport="443", srcip_begin="10.0.0.9",
    )
    schema = search_time_range(spark, sf_dir).schema
    return spark.read.schema(schema).option("emptyValue", "").csv(out)


@query
def stored_ip_range(spark, sf_dir):
    """Address ranges over the stored log, asked of the stored numbers."""
    log = read_access_log(spark, _stored_log(spark, sf_dir), SEARCH_BEGIN, SEARCH_END)
    return search(
        log, SEARCH_BEGIN, SEARCH_END, srcip_begin="10.0.0.9", srcip_end="10.0.0.200",
        destip_begin="203.0.113.4", destip_end="203.0.113.20",
    )


@query
def stored_lookup(spark, sf_dir):
    """One domain and one URL in the stored log, by Bloom filters."""
    log = read_access_log(spark, _stored_log(spark, sf_dir), *MONTH)
    by_url = search(log, *MONTH, url="http://ththre.example.com/fr/825?page=2&ref=x")
    return search(log, *MONTH, domain="site.cn", destport="443").unionByName(by_url)


@query
def catalog_search(spark, sf_dir):
    """Searches through the catalog after two batches, and again after a merge."""
    root, table = stage_dir(spark, "catalog"), f"log_{uuid.uuid4().hex[:12]}"
    create_log_table(spark, table, root, BY_DAY)
    for part, batch in enumerate(("b1", "b2")):
        rows = demo.access_log(spark, sf_dir).where(F.pmod(F.xxhash64("srcip", "acctime"), F.lit(2)) == part)
        publish(rows.withColumn("batch", F.lit(batch)), root, BY_DAY)
        register_batch(spark, table, root, batch)
    find = lambda state: search(
        read_log_table(spark, table, root, SEARCH_BEGIN, SEARCH_END), SEARCH_BEGIN, SEARCH_END, destport="443",
    ).withColumn("state", F.lit(state))
    stages = stage_dir(spark, "catalog-found")
    find("published").write.parquet(stages)
    merge_files(spark, root, "m1", compaction.plan_bin_packing, by=BY_DAY, table=table)
    return spark.read.parquet(stages).unionByName(find("merged"))


def _asked(spark, sf_dir, questions):
    """Questions put to stored hours and to finished minute directories, with a result log."""
    root, hours = stage_dir(spark, "asked"), _hour_tables(spark, sf_dir)
    day = F.translate(F.col("acctime").substr(1, 10), "-", "")
    rows = demo.damaged_lines(spark, sf_dir).select("value", F.concat(day, F.lit("1130")).alias("minute"))
    rows.hint("rebalance", "minute").write.partitionBy("minute").text(f"{root}/in")
    files = Files(spark, root)
    for folder in files.folders(f"{root}/in"):
        files.move(f"{root}/in/{folder}", f"{root}/lines/{folder[7:]}done/1001")
    now = datetime.strptime(ASKED_AT, "%Y-%m-%d %H:%M:%S")
    answers = [
        run_domain_count(spark, hours, f"{root}/lines", f"{root}/log", domain, now=now, batch_id=number, suffixes=suffixes)
        for number, domain, suffixes in questions
    ]
    return answers, read_answers(spark, f"{root}/log")


@query
def domain_count_job(spark, sf_dir):
    return _asked(spark, sf_dir, [("q1", "site.cn", None)])[0][0]


@query
def answer_log_rerun(spark, sf_dir):
    """Two questions, the first one twice: its lines are in the log once."""
    return _asked(spark, sf_dir, [("q1", "site.cn", None), ("q2", "example.com", demo.SUFFIXES), ("q1", "site.cn", None)])[1]


# ---- layout, files, cells -------------------------------------------------


def _house_days(spark, sf_dir):
    return demo.access_log(spark, sf_dir).select("hid", "d").distinct()


@query
def partition_expected(spark, sf_dir):
    return layout.expected_partitions(_house_days(spark, sf_dir))


@query
def partition_missing(spark, sf_dir):
    present = layout.present_partitions(demo.access_log(spark, sf_dir))
    return layout.missing_partitions(partition_expected(spark, sf_dir), present)


@query
def partition_paths(spark, sf_dir):
    return layout.partition_paths(layout.present_partitions(demo.access_log(spark, sf_dir)))


@query
def house_list_lines(spark, sf_dir):
    houses = demo.access_log(spark, sf_dir).select(F.col("hid").alias("houseid")).distinct()
    return house_lines(houses.withColumn("housename", F.concat(F.lit("house "), F.col("houseid").cast("string"))))


@query
def result_count(spark, sf_dir):
    """Row count of a written search result, taken by the write itself."""
    written = write_delimited(search_time_ip_range(spark, sf_dir), stage_dir(spark, "result"))
    return written.select("row_count")


@query
def cells_unpivot(spark, sf_dir):
    parsed = lines.parse_tolerant(demo.damaged_lines(spark, sf_dir), "event_id", zone="UTC")
    return to_cells(parsed, "event_id", ["domain", "duration", "d"])


def _files(spark, sf_dir):
    """A file listing: every event is a file of ``value`` MB in its house and half day."""
    acctime = F.col("acctime")
    half = F.when(acctime.substr(12, 2) < "12", "00").otherwise("12")
    return demo.requests(spark, sf_dir).select(
        F.col("hid").cast("string").alias("hid"),
        F.concat(acctime.substr(3, 2), acctime.substr(6, 2), acctime.substr(9, 2)).alias("d"),
        half.alias("h"), F.lit("00").alias("m5"),
        F.concat(F.lit("part-"), F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(".orc")).alias("file_path"),
        F.floor(F.col("amount") * compaction.MB).cast("bigint").alias("file_size"),
    )


@query
def compaction_plan(spark, sf_dir):
    return compaction.plan_bin_packing(_files(spark, sf_dir))


@query
def compaction_size_classes(spark, sf_dir):
    return compaction.class_outputs(_files(spark, sf_dir))


@query
def compaction_class_plan(spark, sf_dir):
    return compaction.plan_size_classes(_files(spark, sf_dir))


@query
def compaction_small_files(spark, sf_dir):
    return compaction.plan_small_files(_files(spark, sf_dir))


@query
def compaction_rewrite(spark, sf_dir):
    return compaction.total_outputs(_files(spark, sf_dir), compaction.REWRITE_OUTPUT_MB)


@query
def ingest_parallelism(spark, sf_dir):
    return compaction.ingest_parallelism(_files(spark, sf_dir), 100)


@query
def url_text(spark, sf_dir):
    """Decoded URLs and numeric addresses of the log."""
    return demo.access_log(spark, sf_dir).select(
        decode(F.col("url")).alias("url"), ip_to_long("srcip").alias("src"), ip_to_long("destip").alias("dest")
    )


@query
def sql_functions(spark, sf_dir):
    register_sql_functions(spark, demo.SUFFIXES, demo.FOREIGN)
    return spark.sql(
        "select topDomain(domain) as topdomain, foreignDomain(domain) as isforeign,"
        " max(ip2long(srcip)) as top_source, count(*) as times from {log} group by all",
        log=demo.access_log(spark, sf_dir),
    )


@query
def suffix_join(spark, sf_dir):
    """Registrable domains through a suffix table instead of literals."""
    rows = [(k, v) for k, vs in (("in", demo.SUFFIXES.generic), ("area", demo.SUFFIXES.area),
                                 ("country", demo.SUFFIXES.country)) for v in vs]
    table = spark.createDataFrame(rows, "kind string, value string")
    domains = demo.access_log(spark, sf_dir).groupBy("domain").agg(F.count(F.lit(1)).alias("times"))
    return add_top_domain(domains, table)


# ---- dimension lists from files ---


def _dimension_files(spark, sf_dir):
    """Lists of thousands of lines made out of ``pages``, among them those of the literals, with lines to be left out."""
    root = stage_dir(spark, "dimensions")
    pages = spark.read.schema(demo.PAGES).parquet(f"{sf_dir}/pages.parquet")
    made = pages.select("page_id", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("k")).select(
        F.concat(F.lit("z"), F.col("page_id").cast("string"), F.lit("x"), F.col("k").cast("string")).alias("name")
    )
    real = [("in", v) for v in demo.SUFFIXES.generic] + [("area", v) for v in demo.SUFFIXES.area] + [("country", v) for v in demo.SUFFIXES.country]
    suffixes = spark.createDataFrame(real, "kind string, name string").unionByName(made.withColumn("kind", F.lit("in")))
    line = lambda *parts: F.concat_ws("\t", *parts).alias("value")
    suffixes.select(line("kind", "name", F.lit("x"))).unionByName(made.select(line(F.lit("in"), "name"))).write.text(f"{root}/suffixes")
    foreign = spark.createDataFrame([(v,) for v in demo.FOREIGN], "name string").unionByName(made)
    dashed = F.concat_ws("-", "name", F.lit("somewhere"), F.lit("x")).alias("value")
    foreign.select(dashed).unionByName(spark.createDataFrame([("com-only",)], "value string")).write.text(f"{root}/foreign")
    demo.house_ips(spark).select(F.col("hip").alias("value")).write.text(f"{root}/ips")
    return root


@query
def dimension_files(spark, sf_dir):
    """Registrable domains, foreign flag and house addresses by lists that are read from files."""
    root = _dimension_files(spark, sf_dir)
    suffixes = dimensions.as_suffix_lists(dimensions.read_suffixes(spark, f"{root}/suffixes"))
    foreign = dimensions.read_foreign_suffixes(spark, f"{root}/foreign")
    log = legality.legal_only(_hits(spark, sf_dir), dimensions.read_house_ips(spark, f"{root}/ips"))
    return rollup.hour_domain(log, suffixes, foreign)


@query
def foreign_join(spark, sf_dir):
    """The foreign split by a list of thousands of suffixes."""
    root = _dimension_files(spark, sf_dir)
    foreign = dimensions.read_foreign_suffixes(spark, f"{root}/foreign")
    return rollup.split_foreign(rollup.hour_domain(_hits(spark, sf_dir), demo.SUFFIXES, foreign))[1]


# ---- streams --------------------------------------------------------------


def _line_files(spark, sf_dir):
    """Raw lines as files, one directory per day, named after the minute of arrival (noon)."""
    root = stage_dir(spark, "lines")
    day = F.translate(F.col("acctime").substr(1, 10), "-", "")
    arrived = demo.damaged_lines(spark, sf_dir).select("value", F.concat(day, F.lit("1200")).alias("minute"))
    arrived.hint("rebalance", "minute").write.partitionBy("minute").text(root)
    return f"{root}/*"


@query
def stream_intake(spark, sf_dir):
    work = stage_dir(spark, "intake")
    intake.start_intake(
        spark, _line_files(spark, sf_dir), f"{work}/log", f"{work}/checkpoint", zone="UTC",
        max_files=16, by=BY_DAY,
    ).awaitTermination()
    return read_access_log(spark, f"{work}/log").drop("batch", *ADDRESS_NUMBERS)


@query
def stream_intake_old_files(spark, sf_dir):
    """The same with every third file restored from years ago."""
    glob, work = _line_files(spark, sf_dir), stage_dir(spark, "intake-old")
    files = Files(spark, glob)
    for number, file in enumerate(files.glob(f"{glob}/*.txt")):
        if number % 3 == 0:
            files.set_time(file, datetime(2001, 2, 3))
    intake.start_intake(
        spark, glob, f"{work}/log", f"{work}/checkpoint", zone="UTC", max_files=16, by=BY_DAY,
    ).awaitTermination()
    return read_access_log(spark, f"{work}/log").drop("batch", *ADDRESS_NUMBERS)


@query
def stream_then_reprocess(spark, sf_dir):
    """A stream takes half of the files, a batch job takes one minute directory again with files that came late, the stream the rest."""
    work, root = stage_dir(spark, "reprocess"), stage_dir(spark, "lines")
    day = F.translate(F.col("acctime").substr(1, 10), "-", "")
    rows = demo.damaged_lines(spark, sf_dir).select("event_id", "value", F.concat(day, F.lit("1200")).alias("minute"))
    for part in range(2):
        own = rows.where(F.col("event_id") % 2 == part).select("value", "minute")
        own.hint("rebalance", "minute").write.mode("append").partitionBy("minute").text(root)
        if part:
            run_ingest(spark, f"{root}/minute=202401101200", f"{work}/log", "202401101200", "202401101200", "UTC", by=BY_DAY)
        intake.start_intake(
            spark, f"{root}/*", f"{work}/log", f"{work}/checkpoint", zone="UTC", max_files=16, by=BY_DAY,
        ).awaitTermination()
    return read_access_log(spark, f"{work}/log").drop("batch", *ADDRESS_NUMBERS)


@query
def stream_hour_ipportdomain(spark, sf_dir):
    work = stage_dir(spark, "hourly")
    stream = intake.line_stream(spark, _line_files(spark, sf_dir), max_files=16)
    log = lines.parse_tolerant(stream, zone="UTC")
    hourly.start_hour_partials(log, f"{work}/partials", f"{work}/checkpoint", BY_DAY).awaitTermination()
    return hourly.read_hour_partials(spark, f"{work}/partials")


@query
def stream_hour_folded(spark, sf_dir):
    """Partials of all hours of the month folded into the hour table."""
    work = stage_dir(spark, "folded")
    stream = intake.line_stream(spark, _line_files(spark, sf_dir), max_files=16)
    log = lines.parse_tolerant(stream, zone="UTC")
    hourly.start_hour_partials(log, f"{work}/partials", f"{work}/checkpoint", BY_DAY).awaitTermination()
    hourly.fold_hours(spark, f"{work}/partials", f"{work}/hours", *MONTH, by=BY_HOUSE_DAY)
    return read_hour_stats(spark, f"{work}/hours", "ipportdomain", *MONTH)


@query
def stream_closed_hours(spark, sf_dir):
    """Hours that the watermark has closed, half of the days taken before a restart and half after it."""
    work = stage_dir(spark, "closed")
    day = F.translate(F.col("acctime").substr(1, 10), "-", "")
    rows = demo.damaged_lines(spark, sf_dir).select("value", F.concat(day, F.lit("1200")).alias("minute"))
    for part, days in enumerate((F.col("minute") < "202401160000", F.col("minute") >= "202401160000")):
        # One file a day, older days in older files, so that no line is late.
        rows.where(days).repartition("minute").write.mode("append").partitionBy("minute").text(f"{work}/in")
        files = Files(spark, work)
        for file in files.glob(f"{work}/in/*/*.txt"):
            files.set_time(file, datetime.strptime(file.split("minute=")[1][:12], "%Y%m%d%H%M"))
        log = lines.parse_tolerant(intake.line_stream(spark, f"{work}/in/*", max_files=4), zone="UTC")
        hourly.start_closed_hours(log, f"{work}/hours", f"{work}/checkpoint", by=BY_HOUSE_DAY).awaitTermination()
    return read_hour_stats(spark, f"{work}/hours", "ipportdomain")


@query
def stream_cells_upsert(spark, sf_dir):
    """The newest domain and duration of every source address; later batches bring newer ones, and batches are merged."""
    work = stage_dir(spark, "cells")
    stream = lines.parse_strict(intake.line_stream(spark, _line_files(spark, sf_dir), max_files=8).select("value"))
    rows = stream.where(F.col("acctime").rlike(r"^\d+\z"))
    cells = to_cells(rows, "srcip", ["domain", "duration"], version="acctime")
    start_cells(cells, f"{work}/cells", f"{work}/checkpoint").awaitTermination()
    compact_cells(spark, f"{work}/cells")
    return read_cells(spark, f"{work}/cells")


@query
def merge_size_classes(spark, sf_dir):
    """Three batches published, files of like size merged; the rows as they are then."""
    root = stage_dir(spark, "classes")
    log = demo.access_log(spark, sf_dir)
    for part in range(3):
        own = log.where(F.pmod(F.xxhash64("srcip", "acctime"), F.lit(3)) == part)
        publish(own.withColumn("batch", F.lit(f"b{part}")), root, BY_DAY)
    merge_files(spark, root, "m1", compaction.plan_size_classes, by=BY_DAY)
    merge_files(spark, root, "m2", compaction.plan_rewrite, by=BY_DAY)
    return read_access_log(spark, root).drop("batch", *ADDRESS_NUMBERS)


@query
def compaction_merge(spark, sf_dir):
    """Three batches published, their small files merged: same rows, fewer files."""
    root = stage_dir(spark, "merge")
    for batch, load_time in (("b1", "202401010200"), ("b2", LOAD_TIME), ("b3", "202401250000")):
        publish(ingest_rows(demo.raw_lines(spark, sf_dir), load_time, batch, "UTC"), root, BY_DAY)
    merge_files(spark, root, "m1", compaction.plan_bin_packing, by=BY_DAY)
    return read_access_log(spark, root).groupBy("hid", "d").agg(F.count(F.lit(1)).alias("row_count"))
