"""The named queries in plain SQL, written independently, to check them against."""

from hitledger.workbook import ASKED_AT, SEARCH_BEGIN, SEARCH_END

_BASE = r"""
with pg as (
  select page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) as host, (select count(*) from pages) as n
  from pages
), requests as (
  select e.event_id, e.value as mb,
    cast(1001 + e.user_id % 4 as int) as hid,
    concat('10.0.', cast(e.user_id // 256 as varchar), '.', cast(e.user_id % 256 as varchar)) as srcip,
    concat('203.0.113.', cast(e.event_id % 32 as varchar)) as destip,
    case e.event_type when 'view' then '1' when 'click' then '2' when 'purchase' then '3'
      when 'signup' then '4' else '5' end as proctype,
    cast(1024 + e.event_id % 50000 as varchar) as srcport,
    case e.event_id % 3 when 0 then '80' when 1 then '443' else '8080' end as destport,
    case pg.page_id % 8 when 1 then concat(host, '.cn') when 2 then concat(host, '.js.cn')
      when 3 then concat(host, ':8080') when 4 then concat('203.0.113.', cast(pg.page_id % 250 as varchar))
      when 5 then 'bad host!' when 6 then concat(host, '.ru') when 7 then 'site.cn' else host end as domain,
    base64(encode(pg.url)) as url, pg.url as plain_url,
    cast(cast(floor(e.value) as bigint) as varchar) as duration,
    strftime(e.ts, '%Y-%m-%d %H:%M:%S') as acctime,
    cast(floor(epoch(e.ts)) as bigint) as second
  from events e join pg on pg.page_id = e.event_id % pg.n
), log as (
  select *, strftime(cast(acctime as timestamp), '%y%m%d') as d, substr(acctime, 12, 2) as h,
    lpad(cast(cast(substr(acctime, 15, 2) as int) // 5 * 5 as varchar), 2, '0') as m5
  from requests
), house_ips as (select concat('203.0.113.', cast(i as varchar)) as hip from range(24) r(i))
"""


def _top(domain: str) -> str:
    p = f"string_split(rtrim({domain}, '.'), '.')"
    return rf"""case when not regexp_full_match(trim({domain}), '[\w\-:.]+') then '-1'
      when len({p}) < 2 then ''
      when {p}[-1] in ('com', 'net', 'org') then concat({p}[-2], '.', {p}[-1])
      when {p}[-1] = 'cn' and ({p}[-2] in ('com', 'net', 'org') or concat({p}[-2], '.', {p}[-1]) = 'js.cn')
        then concat(case when len({p}) > 2 then {p}[-3] else '-1' end, '.', {p}[-2], '.', {p}[-1])
      when {p}[-1] = 'cn' then concat({p}[-2], '.', {p}[-1])
      else '' end"""


def _foreign(domain: str) -> str:
    return rf"case when regexp_full_match({domain}, '.*\.ru(:\d+)?') then 1 else 0 end"


_TOP = _top("domain")
_MEASURES = "min(acctime) as firsttime, max(acctime) as activetime, count(*) as times"
_HID = "cast(hid as varchar) as hid"
_LEGAL = "destip in (select hip from house_ips)"


def _hour(keys: str, extra: str = "", where: str = "true", measures: str = _MEASURES) -> str:
    return f"select {_HID}, d, h, {keys}, {measures}{extra} from log where {where} group by hid, d, h, {keys}"


def _day(keys: str, extra: str = "", where: str = "true") -> str:
    return f"select {_HID}, d as day, {keys}, {_MEASURES}{extra} from log where {where} group by hid, d, {keys}"


_CLEAN = f"{_TOP} <> '-1'"
_DOMESTIC = f"{_foreign('domain')} = 0"
_HOUR_DOMAIN = (
    f"select *, cast({_foreign('domain')} as int) as isforeign, {_TOP} as topdomain from ("
    + _hour("domain", ", max(destip) as destip", _CLEAN) + ")"
)
_LEGAL_HOUR_DOMAIN = (
    f"select *, {_TOP} as topdomain from (" + _hour("domain", ", max(destip) as destip", f"{_CLEAN} and {_LEGAL}") + ")"
)


def _top_day(hour_domains: str, where: str) -> str:
    # The address of a domain's hour row is the largest one seen in that hour.
    return (
        "select hid, d as day, topdomain, destip, min(firsttime) as firsttime, max(activetime) as activetime,"
        f" cast(sum(times) as bigint) as times from ({hour_domains}) where {where} group by all"
    )


# ---- search

_SHOWN = "hid, srcip, destip, proctype, srcport, destport, domain, url, duration, acctime"


def _ip(ip: str) -> str:
    p = f"string_split({ip}, '.')"
    return " + ".join(f"cast({p}[{i + 1}] as bigint) * {256 ** (3 - i)}" for i in range(4))


def _search(where: str, begin: str = SEARCH_BEGIN, end: str = SEARCH_END) -> str:
    return f"select {_SHOWN} from log where acctime >= '{begin}' and acctime <= '{end}' and {where}"


# ---- raw lines

_LINES = r"""
, lines as (
  select event_id, acctime as true_time,
    concat_ws('|', hid, srcip, destip, proctype, srcport, destport, domain, url, duration, second) as good
  from requests
), damaged as (
  select event_id, good, true_time, case event_id % 16
    when 1 then regexp_replace(good, '\|[^|]*$', '')
    when 2 then concat(good, '|extra')
    when 3 then regexp_replace(good, '\|[^|]*$', '|')
    when 4 then regexp_replace(good, '\|[^|]*$', '|abc')
    when 5 then concat('x', good)
    when 6 then concat(' ', good)
    when 7 then regexp_replace(good, '^(([^|]*\|){6})([^|]*)', concat('\1 ', chr(9), '\3 '))
    when 8 then concat(good, '||')
    else good end as value
  from lines
), raw as (select *, string_split(value, '|') as f from damaged
), parsed as (
  select event_id, true_time,
    cast(case when len(f) < 10 then -1 when regexp_full_match(f[1], '[+-]?\d+') then cast(f[1] as int) else 0 end as int) as hid,
    case when len(f) < 10 then value else f[2] end as srcip,
    case when len(f) < 10 then '-1' else f[3] end as destip,
    case when len(f) < 10 then '-1' else f[4] end as proctype,
    case when len(f) < 10 then '-1' else f[5] end as srcport,
    case when len(f) < 10 then '-1' else f[6] end as destport,
    case when len(f) < 10 then '-1' else trim(f[7], concat(' ', chr(9))) end as domain,
    case when len(f) < 10 then '-1' else f[8] end as url,
    case when len(f) < 10 then '-1' else f[9] end as duration,
    case when len(f) < 10 then '-1' when len(f) > 10 or not regexp_full_match(f[10], '\d+') then '0'
      else strftime(make_timestamp(cast(f[10] as bigint) * 1000000), '%Y-%m-%d %H:%M:%S') end as acctime
  from raw
), rows as (
  select *, case when acctime in ('0', '-1') then acctime else strftime(cast(acctime as timestamp), '%y%m%d') end as d,
    case when acctime in ('0', '-1') then acctime else substr(acctime, 12, 2) end as h,
    case when acctime in ('0', '-1') then acctime else
      lpad(cast(cast(substr(acctime, 15, 2) as int) // 5 * 5 as varchar), 2, '0') end as m5
  from parsed
), trimmed as (select string_split(rtrim(value, '|'), '|') as f from damaged
), good_rows as (select string_split(good, '|') as f from damaged)
"""
_ROW = "hid, srcip, destip, proctype, srcport, destport, domain, url, duration, acctime, d, h, m5"
_STRICT = ", ".join(
    f"f[{i + 1}] as {n}"
    for i, n in enumerate(["hid", "srcip", "destip", "proctype", "srcport", "destport", "domain", "url", "duration", "acctime"])
)


def _answer(times: str, source: str, domain: str) -> str:
    return (
        f"select 'q1' as \"batchID\", '{domain}' as domain, '{ASKED_AT}' as \"curSec\","
        f" cast({times} as bigint) as times from {source}"
    )


_STATS_ANSWER = _answer("case when count(*) > 0 then count(*) end", "log where domain = 'site.cn'", "site.cn")
_LINES_ANSWER = _answer("count(*)", "good_rows where f[7] = 'site.cn'", "site.cn")
_HYBRID = (
    f"select *, 'stats' as source from ({_STATS_ANSWER}) union all select *, 'lines' as source from ({_LINES_ANSWER})"
)
_EXPECTED = """
select cast(hid as varchar) as hid, d, lpad(cast(x as varchar), 2, '0') as h, lpad(cast(y as varchar), 2, '0') as m5
from (select distinct hid, d from log), range(24) a(x), range(0, 60, 5) b(y)
"""
_PRESENT = f"select distinct {_HID}, d, h, m5 from log"

# ---- files

_FILES = """
, files as (
  select cast(hid as varchar) as hid, d, case when h < '12' then '00' else '12' end as h, '00' as m5,
    concat('part-', lpad(cast(event_id as varchar), 12, '0'), '.orc') as file_path,
    cast(floor(mb * 1048576) as bigint) as file_size
  from log
), classed as (
  select *, case when file_size <= 25 * 1048576 then 'le25' when file_size <= 42 * 1048576 then 'le42'
    when file_size <= 64 * 1048576 then 'le64' end as size_class
  from files
), counted as (
  select hid, d, h, m5, size_class, count(*) as files, cast(sum(file_size) as bigint) as bytes
  from classed where size_class is not null group by all
), classes as (
  select *, cast(case when files < 2 then 0 when size_class = 'le64' then ceil(files / 2.0)
    when size_class = 'le42' and files > 3 then files // 3 + 1 else 1 end as int) as outputs
  from counted
)
"""


def _log(sql: str) -> str:
    return _BASE + sql


def _raw(sql: str) -> str:
    return _BASE + _LINES + sql


def _files(sql: str) -> str:
    return _BASE + _FILES + sql


SQL: dict[str, str] = {
    "stat_hour_ipportdomain": _log(_hour("destip, destport, domain, proctype")),
    "stat_hour_ipport": _log(_hour("destip, destport, proctype")),
    "stat_hour_domainip": _log(
        f"select *, {_TOP} as topdomain from (" + _hour("domain, destip", ", max(proctype) as proctype", _CLEAN) + ")"
    ),
    "stat_hour_domain": _log(_HOUR_DOMAIN),
    "stat_hour_tree": _log(_HOUR_DOMAIN),
    "stat_hour_foreign_split": _log(f"select * from ({_HOUR_DOMAIN}) where isforeign = 1"),
    "stat_hour_domestic": _log(f"select * from ({_HOUR_DOMAIN}) where isforeign = 0"),
    "stat_hour_legal_ipport": _log(_hour("destip, destport, proctype", where=_LEGAL)),
    "stat_hour_legal_domainip": _log(
        f"select *, {_TOP} as topdomain from ("
        + _hour("domain, destip", ", max(proctype) as proctype", f"{_CLEAN} and {_LEGAL}") + ")"
    ),
    "stat_hour_legal_domain": _log(_LEGAL_HOUR_DOMAIN),
    "stat_hour_illegal": _log(f"select distinct {_HID}, d, h, domain, destip from log where {_CLEAN} and not {_LEGAL}"),
    "legality_flag": _log(
        f"select hid, {_TOP} as topdomain, cast(case when {_LEGAL} then 1 else 0 end as int) as iflegal,"
        " count(*) as times from log group by all"
    ),
    "stat_day_ipportdomain": _log(_day("destip, destport, domain, proctype")),
    "stat_day_ipport": _log(_day("destip, destport, proctype")),
    "stat_day_domainip": _log(
        f"select *, {_TOP} as topdomain from (" + _day("domain, destip", ", max(proctype) as proctype", _CLEAN) + ")"
    ),
    "stat_day_domain": _log(
        f"select *, {_TOP} as topdomain from ("
        + _day("domain", ", max(destip) as destip", f"{_CLEAN} and {_DOMESTIC} and {_TOP} <> ''") + ")"
    ),
    "stat_day_topdomain": _log(_top_day(_HOUR_DOMAIN, "topdomain <> '' and isforeign = 0")),
    "stat_day_legal_domain": _log(
        f"select *, {_TOP} as topdomain from ("
        + _day("domain", ", max(destip) as destip", f"{_CLEAN} and {_LEGAL}") + ")"
    ),
    "stat_day_legal_topdomain": _log(_top_day(_LEGAL_HOUR_DOMAIN, "true")),
    "stat_day_illegal": _log(f"select distinct {_HID}, d as day, domain, destip from log where {_CLEAN} and not {_LEGAL}"),
    "search_time_range": _log(_search("true")),
    "search_time_ip_range": _log(_search(
        f"{_ip('srcip')} between 167772169 and 167772360 and {_ip('destip')} between 3405803780 and 3405803796"
    )),
    "search_ip_upper_only": _log(_search(f"{_ip('srcip')} <= 167772200")),
    "search_domain_port_proto": _log(_search("domain = 'site.cn' and destport = '443' and proctype = '1'")),
    "search_srcport": _log(_search("srcport = '1524'", "2024-01-01 00:00:00")),
    "search_url_exact": _log(_search("plain_url = 'http://ththre.example.com/fr/825?page=2&ref=x'")),
    "search_url_encoded": _log(_search("plain_url = 'http://ththre.example.com/fr/825?page=2&ref=x'")),
    "search_url_prefix": _log(_search("starts_with(plain_url, 'http://')")),
    "search_url_encoded_prefix": _log(_search("starts_with(plain_url, 'https://m')")),
    "search_lookback": _log(_search("true", begin="2024-01-21 09:40:30")),
    "search_orc_and_text": _raw(
        f"select 'orc' as source, * replace (cast(hid as varchar) as hid)"
        f" from ({_search(f'{_ip('srcip')} >= 167772163' + " and domain = 'site.cn'")})"
        f" union all select 'text' as source, {_STRICT} from good_rows where len(f) = 10 and f[10] between '1704412800' and '1705881600'"
        f" and f[1] = '1002' and f[7] = 'site.cn' and {_ip('f[2]')} >= 167772163"
    ),
    "parse_tolerant": _raw(f"select {_ROW} from rows"),
    "parse_strict": _raw(f"select {_STRICT} from trimmed where len(f) = 10"),
    "parse_rejects": _raw("select value as line from raw where len(f) < 10"),
    "scan_domains": _raw("select f[7] as domain, count(*) as times from trimmed where len(f) = 9 group by 1"),
    "ingest_lateness": _raw(f"select {_ROW} from rows where acctime > '2024-01-15 10:00:00'"),
    "ingest_layout_counts": _raw(
        "select hid, d, h, m5, 'b1' as batch, count(*) as row_count from rows"
        " where acctime > '2024-01-15 10:00:00' group by all"
    ),
    "ingest_idempotent": _log(
        "select hid, d, 'b1' as batch, count(*) as row_count from log where acctime > '2024-01-01 00:00:00' group by all"
        " union all select hid, d, 'b2', count(*) from log where acctime > '2024-01-15 10:00:00' group by all"
    ),
    "ingest_append": _raw("select hid, d, 'b1' as batch, 2 * count(*) as row_count from rows group by all"),
    "domain_count": _log(_STATS_ANSWER),
    "topdomain_count": _log(_answer("case when count(*) > 0 then count(*) end", f"log where {_TOP} = 'example.com'", "example.com")),
    "domain_count_day": _log(_answer(
        "case when count(*) > 0 then count(*) end", f"log where {_TOP} = 'site.cn'", "site.cn")),
    "domain_count_lines": _raw(_answer(
        "count(*)", f"trimmed where len(f) = 10 and {_top('f[7]')} = 'example.org'", "example.org")),
    "domain_count_hybrid": _raw(_HYBRID),
    "answer_log_lines": _raw(
        "select concat_ws(chr(9), \"batchID\", domain, \"curSec\", coalesce(cast(times as varchar), 'null')) as value"
        f" from ({_HYBRID})"
    ),
    "partition_expected": _log(_EXPECTED),
    "partition_missing": _log(f"select * from ({_EXPECTED}) except select * from ({_PRESENT})"),
    "partition_paths": _log(f"select concat('/hid=', hid, '/d=', d, '/h=', h, '/m5=', m5) as path from ({_PRESENT})"),
    "house_list_lines": _log("select distinct concat(hid, ',house ', hid) as value from log"),
    "result_count": _log(
        "select count(*) as row_count from (" + _search(
            f"{_ip('srcip')} between 167772169 and 167772360 and {_ip('destip')} between 3405803780 and 3405803796"
        ) + ")"
    ),
    "cells_unpivot": _raw(
        " union all ".join(
            f"select cast(event_id as varchar) as rowkey, 'info' as family, '{q}' as qualifier, {q} as value from rows"
            for q in ("domain", "duration", "d")
        )
    ),
    "compaction_size_classes": _files("select * from classes"),
    "compaction_class_plan": _files(
        "select hid, d, h, m5, file_path, file_size, size_class as target, outputs"
        " from classed join classes using (hid, d, h, m5, size_class) where outputs > 0"
    ),
    "compaction_small_files": _files(
        "select hid, d, h, m5, file_path, file_size, 'all' as target, outputs from files join ("
        "select hid, d, h, m5, cast(ceil(sum(file_size) / (50 * 1048576.0)) as int) as outputs, count(*) as n"
        " from files where file_size < 50 * 1048576 group by all) using (hid, d, h, m5)"
        " where n >= 2 and file_size < 50 * 1048576"
    ),
    "compaction_rewrite": _files(
        "select hid, d, h, m5, count(*) as files, cast(sum(file_size) as bigint) as bytes,"
        " cast(ceil(sum(file_size) / (100 * 1048576.0)) as int) as outputs from files group by all"
    ),
    "ingest_parallelism": _files(
        "select hid, bytes, current_hour, cast(greatest(1, current_hour // 2) as int) as previous_hour from ("
        "select hid, cast(sum(file_size) as bigint) as bytes,"
        " cast(ceil(sum(file_size) / (100 * 1048576.0)) as int) as current_hour from files group by hid)"
    ),
    "url_text": _log(f"select plain_url as url, {_ip('srcip')} as src, {_ip('destip')} as dest from log"),
    "sql_functions": _log(
        f"select {_TOP} as topdomain, cast({_foreign('domain')} as int) as isforeign,"
        f" max({_ip('srcip')}) as top_source, count(*) as times from log group by all"
    ),
    "suffix_join": _log(f"select *, {_TOP} as topdomain from (select domain, count(*) as times from log group by domain)"),
    "stream_intake": _raw(f"select {_ROW} from rows where acctime > concat(substr(true_time, 1, 10), ' 10:00:00')"),
    "stream_hour_ipportdomain": _raw(
        f"select {_HID}, d, h, destip, destport, domain, proctype, {_MEASURES} from rows"
        " group by hid, d, h, destip, destport, domain, proctype"
    ),
    "compaction_merge": _log(
        "select hid, d, cast(sum(n) as bigint) as row_count from ("
        + " union all ".join(
            f"select hid, d, count(*) as n from log where acctime > '{cut}' group by all"
            for cut in ("2024-01-01 00:00:00", "2024-01-15 10:00:00", "2024-01-24 22:00:00")
        ) + ") group by all"
    ),
}

# Files of a partition one after the other, largest first, each into the fullest bin that takes it.
SQL["compaction_plan"] = _files("""
, numbered as (
  select *, row_number() over (partition by hid, d, h, m5 order by file_size desc, file_path desc) as no
  from files where file_size < 80 * 1048576
), packed as (
  select distinct hid, d, h, m5, cast(0 as bigint) as no, cast([] as struct(size bigint, last varchar, names varchar[])[]) as bins
  from numbered
  union all
  select hid, d, h, m5, next, case when fit is null
      then list_append(bins, {'size': file_size, 'last': file_path, 'names': [file_path]})
      else list_append(list_filter(bins, lambda b: b <> fit),
        {'size': fit.size + file_size, 'last': file_path, 'names': list_append(fit.names, file_path)}) end
  from (
    select p.hid, p.d, p.h, p.m5, p.bins, n.no as next, n.file_size, n.file_path,
      list_max(list_filter(p.bins, lambda b: b.size + n.file_size < 120 * 1048576)) as fit
    from packed p join numbered n on p.hid = n.hid and p.d = n.d and p.h = n.h and p.m5 = n.m5 and n.no = p.no + 1
  )
), placed as (
  select hid, d, h, m5, unnest(b.names) as file_path, list_min(b.names) as target from (
    select hid, d, h, m5, unnest(bins) as b from (
      select *, max(no) over (partition by hid, d, h, m5) as last_no from packed) where no = last_no)
  where len(b.names) > 1
)
select hid, d, h, m5, file_path, file_size, target, cast(1 as int) as outputs
from placed join files using (hid, d, h, m5, file_path)""").replace("with pg as", "with recursive pg as", 1)

SQL["job_hour_domain"] = SQL["stat_hour_rerun"] = SQL["stat_hour_domestic"]
SQL["job_hour_foreign"] = SQL["stat_hour_foreign_split"]
SQL["job_hour_legal"] = SQL["stat_hour_legal_domainip"]
SQL["job_day_domain"] = f"select domain, sum(times)::bigint as times, topdomain from ({SQL['stat_day_domain']}) group by hid, day, domain, topdomain"
SQL["job_search"] = _log(_search(f"hid in (1001, 1003) and destport = '443' and {_ip('srcip')} >= 167772169"))
SQL["stream_intake_old_files"] = SQL["stream_intake"]
SQL["stream_hour_folded"] = f"select * from ({SQL['stream_hour_ipportdomain']}) where d > '1'"
SQL["ingest_sized"] = SQL["ingest_lateness"]
SQL["stored_ip_range"] = SQL["search_time_ip_range"]
SQL["stored_lookup"] = _log(
    f"select {_SHOWN} from log where domain = 'site.cn' and destport = '443' union all"
    f" select {_SHOWN} from log where plain_url = 'http://ththre.example.com/fr/825?page=2&ref=x'"
)
SQL["catalog_search"] = (
    f"select *, unnest(['published', 'merged']) as state from ({_log(_search('destport = ' + repr('443')))})"
)
SQL["stream_closed_hours"] = _raw(
    f"select {_HID}, d, h, destip, destport, domain, proctype, {_MEASURES} from rows where acctime > '1'"
    " and date_trunc('hour', cast(acctime as timestamp)) + interval 1 hour"
    " <= (select max(cast(acctime as timestamp)) - interval 2 hour from rows where acctime > '1')"
    " group by hid, d, h, destip, destport, domain, proctype"
)
SQL["stream_cells_upsert"] = _raw(
    "select f[2] as rowkey, 'info' as family, unnest(['domain', 'duration']) as qualifier, unnest(["
    "max({'v': cast(f[10] as bigint), 'x': f[7]}).x, max({'v': cast(f[10] as bigint), 'x': f[9]}).x]) as value"
    " from trimmed where len(f) = 10 and regexp_full_match(f[10], '\\d+') group by f[2]"
)
SQL["stream_then_reprocess"] = SQL["stream_intake"]
SQL["merge_size_classes"] = _log(f"select {_ROW} from log")
SQL["foreign_join"] = SQL["stat_hour_foreign_split"]
SQL["dimension_files"] = _log(
    f"select *, cast({_foreign('domain')} as int) as isforeign, {_TOP} as topdomain from ("
    + _hour("domain", ", max(destip) as destip", f"{_CLEAN} and {_LEGAL}") + ")"
)


def _asked(number: str, domain: str, top: bool) -> str:
    """Hits of the day in statistics (those of foreign domains are elsewhere), and lines that came that day."""
    key = _TOP if top else "domain"
    line_key = _top("f[7]") if top else "f[7]"
    stats = f"select cast(case when count(*) > 0 then count(*) end as bigint) as times, 'stats' as source from log where {key} = '{domain}' and d = '240115' and {_CLEAN} and {_DOMESTIC}"
    lines = f"select count(*) as times, 'lines' as source from (select string_split(rtrim(value, '|'), '|') as f, true_time from damaged) where len(f) = 10 and {line_key} = '{domain}' and substr(true_time, 1, 10) = '2024-01-15'"
    return f"select '{number}' as \"batchID\", '{domain}' as domain, '{ASKED_AT}' as \"curSec\", times, source from ({stats} union all {lines})"


SQL["domain_count_job"] = _raw(_asked("q1", "site.cn", False))
SQL["answer_log_rerun"] = _raw(
    "select concat_ws(chr(9), \"batchID\", domain, \"curSec\", coalesce(cast(times as varchar), 'null')) as value"
    f" from ({_asked('q1', 'site.cn', False)} union all {_asked('q2', 'example.com', True)})"
)
