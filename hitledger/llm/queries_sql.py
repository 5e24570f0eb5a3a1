"""DuckDB SQL for the named queries that SQL can express on whole tables.

Tokenizer, random mixing, network and hashed search have none; their tests
compare with plain Python.
"""

from hitledger.llm.log_templates import Parse
from hitledger.llm.queries import URL_RULES
from hitledger.llm.secret_scan import ALLOWED, Entropy
from hitledger.llm.url_filter import DEPTH, Tree

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _url_templates() -> str:
    tree = Tree()
    verdict = "null"
    for rule in sorted(URL_RULES, key=lambda r: (len(r.text), r.text)):
        fits = f"(host = '{rule.host}' or ends_with(host, '.{rule.host}')) and starts_with(path, '{rule.path}')"
        verdict = f"case when {fits} then {{'rule': '{rule.text}', 'verdict': '{rule.verdict}'}} else {verdict} end"
    form = "[0-9]+|[0-9a-fA-F-]{16,}"
    sql = f"""with cut as (
        select page_id, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    read as (select page_id, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
    ruled as (select *, {verdict} as r, array_to_string(list_transform(string_split(path, '/'), lambda s, i: case
        when i > 1 and regexp_full_match(s, '{form}') then '*'
        when i > 1 and i = len(string_split(path, '/')) and regexp_full_match(s, '({form})\\.[A-Za-z0-9]{{1,5}}')
            then '*' || regexp_extract(s, '\\.[A-Za-z0-9]{{1,5}}$') else s end), '/') as shape from read),
    rows0 as (select host, shape, count(*) as n, count(*) filter (where r.verdict = 'block') as blocked,
        count(*) filter (where r.verdict = 'allow') as allowed, '' as template from ruled group by host, shape)"""
    apart = """case when labelled = 0 then false when {to}_labelled = labelled then true
        else pow(blocked / labelled - ({to}_blocked - blocked) / ({to}_labelled - labelled), 2)
            > ({to}_blocked / {to}_labelled) * (1 - {to}_blocked / {to}_labelled) * (1 / labelled + 1 / ({to}_labelled - labelled)) * """
    apart += f"{tree.similar ** 2}::double end"
    for level in range(1, DEPTH + 1):
        segment = f"string_split(shape, '/')[{level + 1}]" if level < DEPTH else f"array_to_string(string_split(shape, '/')[{level + 1}:], '/')"
        sql += f""",
    seg{level} as (select *, case when len(string_split(shape, '/')) > {level} then {segment} end as segment from rows{level - 1}),
    branch{level} as (select host, template, segment, sum(n) as n, sum(blocked)::double as blocked, sum(blocked + allowed)::double as labelled
        from seg{level} where segment is not null group by all),
    all{level} as (select *, sum(blocked) over (partition by host, template) as all_blocked,
        sum(labelled) over (partition by host, template) as all_labelled from branch{level}),
    kept{level} as (select *, case when blocked * all_labelled >= all_blocked * labelled then '*+' else '*-' end as side
        from all{level} where {apart.format(to='all')}),
    sides{level} as (select *, sum(blocked) over (partition by host, template, side) as side_blocked,
        sum(labelled) over (partition by host, template, side) as side_labelled from kept{level}),
    named{level} as (select host, template, segment, case when {apart.format(to='side')} then segment else side end as name from sides{level}),
    rows{level} as (select s.host, s.shape, s.n, s.blocked, s.allowed,
        s.template || case when s.segment is null then '' else '/' || coalesce(k.name, '*') end as template
        from seg{level} s left join named{level} k on s.host = k.host and s.template = k.template and s.segment = k.segment)"""
    return sql + f""",
    purities as (select host, template, (sum(blocked) + {tree.prior}::double) / (sum(blocked) + sum(allowed) + 2 * {tree.prior}::double) as purity
        from rows{DEPTH} group by all)
    select u.page_id, u.host, u.path, u.r.rule as rule,
        coalesce(u.r.verdict, case when p.purity >= {tree.purity}::double then 'block' else 'allow' end) as verdict,
        t.template, case when u.r is null then p.purity end as purity
    from ruled u join rows{DEPTH} t on u.host = t.host and u.shape = t.shape join purities p on p.host = t.host and p.template = t.template"""


def _fixity() -> str:
    def side(name: str, html: str, where: str) -> str:
        record = (
            f"concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),"
            f" 'Content-Length: ', strlen(coalesce({html}, '')), chr(13), chr(10), chr(13), chr(10), coalesce({html}, ''), chr(13), chr(10), chr(13), chr(10))"
        )
        node = "select archive, place // 16 as place, min(start) as start, max(\"end\") as \"end\", sha256(string_agg(sha, '' order by place)) as sha from {} group by 1, 2"
        return f"""{name}_rec as (select page_id, page_id // 256 as archive, {record} as record from pages where {where}),
        {name}0 as (select archive, row_number() over w - 1 as place, (sum(strlen(record)) over w - strlen(record))::bigint as start,
            (sum(strlen(record)) over w)::bigint as "end", sha256(record) as sha from {name}_rec window w as (partition by archive order by page_id)),
        {name}1 as ({node.format(name + '0')}), {name}2 as ({node.format(name + '1')})"""

    rotten = "case when page_id % 97 = 13 then replace(html, 'article', 'artIcle') else html end"
    first, second = side("a", "html", "true"), side("b", rotten, "not (page_id // 256 % 5 = 3 and page_id % 256 >= 250)")
    compare = """select coalesce(a.archive, b.archive) as archive, '{}' as level, coalesce(a.place, b.place) as place,
        coalesce(a.start, b.start) as start, coalesce(a."end", b."end") as "end", a.sha as first_sha256, b.sha as second_sha256,
        case when b.sha is null then 'missing' when a.sha is null then 'extra' when a.sha <> b.sha then 'changed' else 'same' end as status
        from a{} a full join b{} b on a.archive = b.archive and a.place = b.place"""
    return f"""with {first}, {second}
        {compare.format('archive', 2, 2)} union all select * from ({compare.format('record', 0, 0)}) where status <> 'same'"""


def _line_templates() -> str:
    p = Parse()
    tokens = "list_transform(list_filter(regexp_split_to_array(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''), lambda w: case when regexp_matches(w, '[0-9]') then '*' else w end)"
    return f"""with split as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
    lines as (select doc_id, pos, toks, {{'n': len(toks), 'lead': toks[1:{p.leading}]}} as leaf from (select doc_id, pos, {tokens} as toks from split) where len(toks) > 0),
    leaves as (select leaf, count(*) as lines from lines group by 1 having count(distinct doc_id) >= {p.min_docs}),
    shared as (select l.*, v.lines from lines l join leaves v using (leaf)),
    forms as (select leaf, toks, lines, count(*) as n from shared group by all),
    fields as (select leaf, toks, lines, n, unnest(toks) as token, generate_subscripts(toks, 1) as place from forms),
    constants as (select leaf, place, token from fields group by all having sum(n) >= {p.min_docs} and sum(n) >= any_value(lines) * {p.frequent}::double),
    marked as (select f.leaf, f.toks, f.n, f.place, c.token as token from fields f left join constants c on f.leaf = c.leaf and f.place = c.place and f.token = c.token),
    whole as (select leaf, toks, any_value(n) as n, list(token order by place) as fields, count(token) >= count(*) * {p.fixed}::double as enough from marked group by all),
    known as (select leaf, toks, case when enough then {{'fields': fields, 'words': null}} else {{'fields': null, 'words': toks}} end as template
        from whole where enough or n >= {p.min_docs}),
    tagged as (select s.doc_id, s.pos, s.leaf, k.template from shared s join known k using (leaf, toks)),
    recurring as (select leaf, template from tagged group by all having count(distinct doc_id) >= {p.min_docs}),
    gone as (select doc_id, list(t.pos) as gone from tagged t join recurring r on t.leaf = r.leaf and t.template is not distinct from r.template group by 1)
    select doc_id, case when text is null then 0 else len(string_split(text, chr(10))) end as n_lines,
        case when text is null then 0 else coalesce(len(gone), 0) end as n_dropped,
        sha256(case when gone is null then text
            else array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: not list_contains(gone, i)), chr(10)) end) as text_sha256
    from documents left join gone using (doc_id)"""


def _decontaminate() -> str:
    words = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""with dw as (select doc_id, coalesce({words}, []) as ws from documents),
    iw as (select item_id, ws, least(len(ws), 10) as n from (select item_id, {words} as ws from benchmark where text is not null) where len(ws) > 0),
    win as (select distinct item_id, n, array_to_string(ws[i:i + n - 1], ' ') as k from (select *, unnest(range(1, len(ws) - n + 2)) as i from iw)),
    spread as (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from dw, (select distinct n from win) where len(ws) >= n),
    hit as (select doc_id, i, n, item_id from (select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') as k from spread) join win using (n, k)),
    places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
    items as (select doc_id, list_sort(list(distinct cast(item_id as varchar))) as ids from hit group by 1)
    select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(ids), 0) as n_items,
        sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from dw left join places using (doc_id) left join items using (doc_id)"""


def _secrets() -> str:
    e = Entropy()
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    names = "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
    patterns = {
        "assign": f"""({names})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+",
        "entropy": f"[A-Za-z0-9+/_-]{{{e.window},}}",
    }
    least = {"assign": ("grp", 8), "access": ("hit", 16), "hex": ("hit", 32), "entropy": ("hit", e.window)}
    terms = f"[{', '.join(map(str, e.terms))}]"
    best = (
        f"list_min(list_transform(range(1, len(hit) - {e.window} + 2), lambda i: list_sum(list_transform("
        f"map_values(list_histogram(string_split(substr(hit, i, {e.window}), ''))), lambda c: {terms}[c::bigint + 1]))))"
    )
    allowed = " or ".join(f"regexp_matches(hit, {_quoted(p)})" for p in ALLOWED)
    is_hex = "regexp_full_match(hit, '[0-9a-f]+|[0-9A-F]+')"
    secret = f"case when {allowed} then false else {best} <= case when {is_hex} then {e.most(e.hex_bits)} else {e.most(e.mixed_bits)} end end"
    found = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        column, n = least[kind]
        test = f"len({column}) >= {n}" + (f" and {secret}" if kind == "entropy" else "")
        group = 2 if kind == "assign" else 0
        found.append(f"""select doc_id, {k} as k, '{kind}' as kind, s as start, s + len(hit) as stop from (
            select doc_id, hits[i] as hit, grps[i] as grp,
                (coalesce(list_sum(list_transform(gaps[1:i], lambda x: len(x))), 0) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: len(x))), 0))::bigint as s
            from (select *, unnest(range(1, len(hits) + 1)) as i from (
                select doc_id, string_split_regex(text, {_quoted(pattern)}) as gaps, regexp_extract_all(text, {_quoted(pattern)}, 0) as hits,
                    regexp_extract_all(text, {_quoted(pattern)}, {group}) as grps from documents where regexp_matches(text, {_quoted(pattern if kind != 'hex' else '[0-9a-f]{32,}')})
            ))) where {test}""")
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, k){}, '')"
    return f"""with found as ({' union all '.join(found)}),
    spans as (select * from found f where k < 3 or not exists (
        select 1 from found b where b.k < 3 and b.doc_id = f.doc_id and b.start < f.stop and f.start < b.stop))
    select d.doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
        sha256({joined.format(' filter (where k < 3)')}) as base_sha256, {joined.format(' filter (where k is not null)')} as spans
    from documents d left join spans s on d.doc_id = s.doc_id group by d.doc_id"""


def _near_duplicates() -> str:
    words = f"coalesce(regexp_extract_all({LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), [])"
    return f"""with recursive sets as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
            else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as s from (select doc_id, {words} as ws from documents)),
    items as (select doc_id, len(s) as n, unnest(s) as item from sets),
    links as (select a.doc_id as x, b.doc_id as y from items a join items b on a.item = b.item and a.doc_id <> b.doc_id
        group by 1, 2 having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
    reach as (select doc_id, doc_id as other from sets union select r.doc_id, l.y from reach r join links l on r.other = l.x),
    lowest as (select doc_id, min(other) as component_id from reach group by 1)
    select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept from sets join lowest using (doc_id)"""


def _fill_in_middle() -> str:
    drawn = ", ".join(f"cast('0x' || substr(x, {8 * i + 1}, 8) as bigint) as h{i + 1}" for i in range(4))
    marked = " or ".join(f"contains(t, '{mark}')" for mark in ("<P>", "<S>", "<M>"))
    return f"""with texts as (
      select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256(concat('1:', doc_id)) as x from documents),
    drawn as (select doc_id, t, n, {drawn} from texts),
    cuts as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when n = 0 or {marked} or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from drawn),
    parts as (select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from cuts)
    select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
      sha256(case form when 'plain' then t when 'psm' then concat('<P>', p, '<S>', s, '<M>', m)
        else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
      sha256(t) as restored_sha256 from parts"""


SQL: dict[str, str] = {
    "op3_url_templates": _url_templates(),
    "op5_warc_fixity": _fixity(),
    "op7_log_template_lines": _line_templates(),
    "op8_decontaminate": _decontaminate(),
    "op9_secret_entropy": _secrets(),
    "op10_minhash_odd_sketch": _near_duplicates(),
    "op12_fill_in_middle": _fill_in_middle(),
}
