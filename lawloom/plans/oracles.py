"""DuckDB SQL for the queries over the driver's tables."""

SQL = {}


_LINES = r"""
lines as (
  select doc_id, source, i as line_no, line from (
    select doc_id, source, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents
  ) where trim(line, ' ' || chr(9) || chr(13) || chr(160)) <> ''
)"""

SQL["segment_lines"] = f"""
with {_LINES}, firsts as (
  select * from (select *, row_number() over (partition by doc_id, line order by line_no) as n from lines) where n = 1
), hashes as (
  select doc_id, sha256(string_agg(line, '' order by line)) as content_hash from firsts group by doc_id
), numbered as (
  select f.doc_id, source, line_no, row_number() over (partition by f.doc_id order by line_no) as original_order, content_hash,
    (case when f.doc_id < 1000 then lpad(cast(f.doc_id as varchar), 3, '0') else cast(f.doc_id as varchar) end) || '-' || left(md5(left(line, 3)), 2) as k, length(line) as n_chars
  from firsts f join hashes h on f.doc_id = h.doc_id
), counted as (select *, row_number() over (partition by k order by original_order) - 1 as c from numbered)
select doc_id, source, line_no, original_order, case when c > 0 then k || '-' || c else k end as unique_key, content_hash, n_chars from counted
"""

SQL["dedup_keep_first"] = """
select doc_id, source, lang, text_sha256 from (
  select doc_id, source, lang, sha256(text) as text_sha256, row_number() over (partition by text, lang order by doc_id) as n from documents
) where n = 1
"""

SQL["union_tagged"] = """
select doc_id as id, length(text) as n_chars, lang, 'Section' as entry_type from documents
union all select item_id, length(text), null, 'Division' from benchmark
"""

SQL["union_terms"] = "select lower(c_mktsegment) as term from customer union select lower(o_orderpriority) from orders"

_SAMPLE = """
with e as (select doc_id, lang, lower(trim(string_split(text, chr(10))[1])) as name from documents),
r as (select *, row_number() over (partition by lang order by md5('42:' || doc_id), doc_id) as n from e
  where name not in ('sense of congress.', 'sunset.', 'severability.', 'short title.', 'table of contents.', 'short title; table of contents.')),
s as (select doc_id, lang, row_number() over (partition by lang order by md5('order:42:' || doc_id), doc_id) as o from r where n <= 50)
"""

SQL["selection_sample"] = f"{_SAMPLE} select e.doc_id, e.lang, case when s.o is null then 0 else 1 end as selection, cast(s.o as integer) as order_no from e left join s on e.doc_id = s.doc_id"
SQL["sme_view"] = f"{_SAMPLE} select lang, cast(o as integer) as order_no, doc_id from s order by lang, o"

SQL["volume_order"] = f"""
with {_LINES}, firsts as (
  select * from (select *, row_number() over (partition by source, doc_id, line, line_no % 3 = 0 order by line_no) as n from lines) where n = 1
)
select source as vol, 'Public Law 1-' || doc_id as law, line_no as xml_index,
  row_number() over (partition by source order by doc_id, line_no % 7, line_no % 3 = 0, line_no) as original_order from firsts
"""

SQL["content_hash"] = "select conv_id, sha256(string_agg(text, '' order by text)) as content_hash from conversations where trim(coalesce(text, '')) <> '' group by conv_id"

SQL["law_flag_semi"] = "select o_orderkey, exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R') as is_appropriation from orders"
SQL["group_flag"] = "select l_orderkey, l_linenumber, l_returnflag, bool_or(l_returnflag = 'R') over (partition by l_orderkey) as is_appropriation from lineitem"
SQL["existence_semi"] = "select doc_id, lang from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id)"
SQL["missing_anti"] = "select doc_id from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)"

_TERMS = "(values ('all rights reserved'), ('apache license'), ('gnu'), ('license'), ('thtion'), ('keit'), ('mente'), ('eaux'), ('idiot')) t(term)"
SQL["agency_tags_row"] = f"""
select d.doc_id, d.source, x.tags from documents d
left join (select doc_id, string_agg(term, '|' order by term) as tags from documents join {_TERMS} on contains(lower(text), term) group by doc_id) x on d.doc_id = x.doc_id
"""
SQL["agency_tags_law"] = f"""
select d.doc_id, d.source, coalesce(x.tags, '') as law_tags from documents d
left join (select source, string_agg(distinct term, '|' order by term) as tags from documents join {_TERMS} on contains(lower(text), term) group by source) x on d.source = x.source
"""

SQL["dictionary_ids"] = """
with known as (select term, row_number() over (order by term) as id from (select distinct lower(p_type) as term from part where p_partkey <= 20)),
new as (select distinct lower(p_type) as term from part where lower(p_type) not in (select term from known))
select term, id from known union all select term, row_number() over (order by term) + (select count(*) from known) from new
"""
SQL["dictionary_lookup"] = "select n_nationkey, n_name, lpad(cast(coalesce(r_regionkey, 0) as varchar), 5, '0') as heading_code, coalesce(r_name, '(blank)') as region from nation left join (select * from region where r_regionkey <> 3) on n_regionkey = r_regionkey"

_PAD3 = "case when length({0}) < 3 then lpad({0}, 3, '0') else {0} end"
SQL["normalize_ids"] = f"""
with o as (select o_orderkey, case o_orderkey % 5
    when 0 then 'Public Law ' || (o_custkey % 120) || '–' || o_orderkey
    when 1 then (o_custkey % 120) || ' - ' || o_orderkey
    when 2 then '75 Stat. ' || o_orderkey
    when 3 then 'Pub. L. ' || (o_custkey % 120) || '—' || o_orderkey || ' note' end as law_id, o_custkey % 120 as c from orders),
x as (select *, case when o_orderkey % 5 = 0 then cast(c as varchar) else '0' end as cong, case when o_orderkey % 5 = 0 then cast(o_orderkey as varchar) else '0' end as num from o)
select o_orderkey, case when o_orderkey % 5 in (0, 1, 3) then c || '-' || o_orderkey else coalesce(law_id, '') end as plain,
  regexp_replace(law_id, '^(?:Public Law\\s+)?(\\d+)\\s*[-–—]\\s*(\\d+)$', 'Public Law \\1–\\2') as published,
  try_cast(nullif(regexp_extract(law_id, '(\\d+)$', 1), '') as bigint) as number,
  {_PAD3.format('cong')} as congress, {_PAD3.format('num')} as law
from x
"""

SQL["derive_ids"] = """
with o as (select o_orderkey, o_orderkey % 40 + 50 as vol, cast(o_orderkey % 90 + 30 as varchar) as congress, cast(o_custkey as varchar) as number, o_orderkey % 4 as k from orders),
d as (select o_orderkey, congress, number, case
    when vol > 63 then case
      when vol = 70 then 'Public Law ' || congress || '-' || number
      when k = 0 then 'Public Law ' || congress || '-' || number
      when k = 2 then 'Public Law ' || number
      else 'Public Law ' || congress || '-' || number end
    when k in (0, 1) then congress || '-' || number
    when k = 2 then null else '' end as law_id from o)
select o_orderkey, law_id, case when not regexp_matches(coalesce(law_id, ''), 'Public Law \\d+[-–—]\\d+') then 'Public Law ' || congress || '-' || number else law_id end as repaired from d
"""

_VALUE = "list_reduce(list_prepend(0, list_transform(string_split({0}, ''), lambda c: cast(ascii(c) - 64 as bigint))), lambda a, c: a * 26 + c)"
SQL["alpha_code"] = f"""
with p as (select p_partkey, upper(left(regexp_replace(p_name, '[^A-Za-z]', '', 'g'), 2)) as l from part),
v as (select p_partkey, case when p_partkey % 3 < 2 and l <> '' then cast({_VALUE.format('l')} as varchar) else '000' end as s from p)
select p_partkey, {_PAD3.format('s')} as code from v
"""
SQL["alpha_markers"] = """
with p as (select p_partkey, p_partkey % 1500 + 1 as n from part)
select p_partkey, case when n < 26 then chr(cast(65 + n as integer)) when n < 702 then chr(cast(65 + (n - 26) // 26 as integer)) || chr(cast(65 + (n - 26) % 26 as integer))
  else chr(cast(65 + (n - 702) // 676 as integer)) || chr(cast(65 + ((n - 702) // 26) % 26 as integer)) || chr(cast(65 + (n - 702) % 26 as integer)) end as marker from p
"""

_ROMAN = "(['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'XC', 'IX'])[l_partkey % 10 + 1] || (['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'IIII'])[(l_suppkey + l_linenumber) % 10 + 1]"
_ROMAN_SUM = f"list_sum(list_transform(regexp_extract_all({_ROMAN}, '(CM|CD|XC|XL|IX|IV|[MDCLXVI])'), lambda x: case x when 'XC' then 90 when 'XL' then 40 when 'IX' then 9 when 'IV' then 4 when 'L' then 50 when 'X' then 10 when 'V' then 5 when 'I' then 1 when 'C' then 100 when 'D' then 500 else 1000 end))"
_ROMAN_CODE = f"lpad(cast({_ROMAN_SUM} as varchar), 3, '0')"
SQL["roman_code"] = f"select l_orderkey, l_linenumber, {_ROMAN_CODE} as roman, {_PAD3.format('cast(l_partkey as varchar)')} as numeric from lineitem"

_SECTION = "case when l_linenumber = 1 then null when l_partkey % 4 = 0 then 'Sec. ' || l_partkey || '.' when l_partkey % 4 = 1 then 'SECTION ' || l_partkey || '-ab' when l_partkey % 4 = 2 then 'U' || l_partkey else '(blank)' end"
_SECTION_CODE = "case when l_linenumber = 1 or l_partkey % 4 = 3 then '000000000000001' when l_partkey % 4 = 0 then lpad(cast(l_partkey as varchar), 15, '0') when l_partkey % 4 = 1 then lpad(cast(l_partkey as varchar), 13, '0') || 'AB' else lpad(left('U' || l_partkey, 6), 6, '0') end"
SQL["section_code"] = f"select l_orderkey, l_linenumber, {_SECTION_CODE} as code, l_linenumber = 1 or (l_partkey % 4 = 0 and l_partkey = 1) as is_first from lineitem"

SQL["unique_key"] = f"""
select l_orderkey, l_linenumber, {_PAD3.format('cast(l_orderkey % 117 as varchar)')} || '-' || {_PAD3.format('cast(l_orderkey as varchar)')} || '-' ||
  lpad(cast(ascii(l_returnflag) - 64 as varchar), 3, '0') || '-' || {_ROMAN_CODE} || '-000-' || lpad(cast(l_linenumber as varchar), 3, '0') || '-000-' ||
  case when l_linestatus = 'O' then 'S-' || {_SECTION_CODE} else 'D-' || lpad(cast(l_suppkey as varchar), 5, '0') || '-00001-00001' end as unique_key
from lineitem
"""

_KEY = "(select l_orderkey, l_linenumber, l_returnflag, row_number() over (partition by l_orderkey, l_returnflag order by l_linenumber) - 1 as c from lineitem)"
SQL["key_suffix"] = f"select l_orderkey, l_linenumber, l_orderkey || '-1-2-3-4-5-6-' || l_returnflag || '-9' || case when c > 0 then '-' || c else '' end as unique_key from {_KEY}"
SQL["key_suffix_legacy"] = f"select l_orderkey, l_linenumber, l_orderkey || '-1-2-3-4-5-6-' || l_returnflag || case when c > 0 then cast(c as varchar) else '' end || '-9' as unique_key from {_KEY}"

SQL["duplicate_keys"] = "select md5(text) as text_md5, count(*) as n, min(doc_id) as first_doc from documents group by 1 having count(*) > 1"
SQL["duplicate_groups_top6"] = """
select o_custkey, n, string_agg(o_orderkey || ':' || o_orderpriority, '|' order by o_orderkey) as rows, n > 6 as truncated
from (select *, count(*) over (partition by o_custkey) as n, row_number() over (partition by o_custkey order by o_orderkey) as r from orders) where n > 1 and r <= 6 group by o_custkey, n
"""

_ANOMALIES = """
with e as (select user_id, event_id, case when event_id % 11 = 0 then null else event_id // 40 + case when event_id % 5 = 0 then 2 else 0 end end as number from events),
s as (select *, count(*) over (partition by user_id) as size, row_number() over (partition by user_id, number order by event_id) as rn, first_value(event_id) over (partition by user_id, number order by event_id) as f from e),
f as (select user_id, event_id, number, lag(number, 1) over w as p, lag(number, 2) over w as pp, lead(number, 1) over w as nx, lead(number, 2) over w as nn from s where size >= 2 and number is not null and rn = 1 window w as (partition by user_id order by event_id)),
k as (select *, case when p is null then case when nx - number <> 1 and nn - nx = 1 then 'suspect_endpoint' end
  when nx is null then case when number - p <> 1 and p - pp = 1 then 'suspect_endpoint' end
  when number - p <> 1 or nx - number <> 1 then case when nx - p = 2 then 'out_of_place' when number - p <> 1 then 'gap' end end as kind from f),
a as (
  select user_id, event_id, number, case when number is null then 'unparseable' else 'duplicate' end as kind, case when number is not null then f end as duplicate_of from s where size >= 2 and (number is null or rn > 1)
  union all select user_id, event_id, number, kind, null from k where kind is not null)
"""
SQL["sequence_anomalies"] = f"{_ANOMALIES} select * from a"
SQL["anomaly_report"] = f"{_ANOMALIES} select user_id, event_id, kind from a order by user_id, event_id, kind limit 80"

SQL["neighbour_context"] = """
with e as (select user_id, event_id, event_type, row_number() over (partition by user_id order by event_id) as n from events)
select a.user_id, a.event_id, coalesce(string_agg(b.event_id || ':' || b.event_type, '|' order by b.event_id), '') as near
from e a left join e b on a.user_id = b.user_id and b.n between a.n - 3 and a.n + 3 and b.n <> a.n group by a.user_id, a.event_id
"""

SQL["null_ordinals"] = """
with x as (select l_orderkey, l_linenumber, case when l_returnflag <> 'N' then 'Sec. ' || l_linenumber || '.' end as number from lineitem),
y as (select *, count(*) filter (number is null) over (partition by l_orderkey) as missing, bool_or(number is not null and l_linenumber = 1) over (partition by l_orderkey) as taken,
  row_number() over (partition by l_orderkey, number is null order by l_linenumber) as n from x)
select l_orderkey, l_linenumber, case when number is null and (missing >= 2 or taken) then 'U' || n else number end as number from y
"""

SQL["heading_ordinals"] = """
with x as (select p_brand, p_partkey, p_type as level1, case when p_size % 3 > 0 then case when p_partkey % 2 = 0 then upper(left(p_name, 4)) else lower(left(p_name, 4)) end end as level2 from part),
y as (select *, row_number() over (partition by p_brand, lower(level1), lower(coalesce(level2, '')) order by p_partkey) as n from x)
select p_brand, p_partkey, case when n > 1 and level2 is null then level1 || ' ' || n else level1 end as level1, case when n > 1 and level2 is not null then level2 || ' ' || n else level2 end as level2, cast(null as varchar) as level3 from y
"""

SQL["sibling_blocks"] = """
with recursive x as (select l_orderkey, l_linenumber, l_returnflag, row_number() over (partition by l_orderkey order by l_linenumber, l_returnflag) as n from lineitem),
f as (
  select l_orderkey, l_linenumber, n, [l_returnflag] as seen, 0 as block from x where n = 1
  union all
  select x.l_orderkey, x.l_linenumber, x.n, case when list_contains(f.seen, x.l_returnflag) then [x.l_returnflag] else list_append(f.seen, x.l_returnflag) end,
    case when list_contains(f.seen, x.l_returnflag) then f.block + 1 else f.block end
  from f join x on x.l_orderkey = f.l_orderkey and x.n = f.n + 1)
select l_orderkey, l_linenumber, cast(block as integer) as block from f
"""

SQL["rules_law_id"] = """
with o as (select o_orderkey, (o_custkey % 20) || '-' || o_orderkey as id, lower(case when o_orderpriority = '2-HIGH' then '2 (High)' else o_orderpriority end) as t from orders),
a as (select *, case when contains(id, '7-') and contains(t, 'urgent') then '8-1' else id end as id1 from o),
b as (select *, case when contains(id1, '8-1') and contains(t, 'urgent') then '9-9' else id1 end as id2 from a)
select o_orderkey, case when contains(id2, '11-') and contains(t, '(high)') then '12-0' else id2 end as law_id from b
"""
_HITS = ("contains(cast(p_partkey as varchar), '1') and contains(lower(p_name), 'bolt')", "contains(cast(p_partkey as varchar), '2') and contains(lower(p_name), 'o')", "contains(cast(p_partkey as varchar), '1') and contains(lower(p_name), 'a') and contains(lower(p_type), 'steel')")
_LAST = f"case when {_HITS[2]} then 'SEC. 3.' when {_HITS[1]} then 'SEC. 2.' when {_HITS[0]} then 'SEC. 1.' else p_brand end"
SQL["rules_section"] = f"select p_partkey, {_LAST} as number from part"
SQL["rules_first_match"] = f"select p_partkey, case when {_HITS[0]} then 'SEC. 1.' when {_HITS[1]} then 'SEC. 2.' when {_HITS[2]} then 'SEC. 3.' else p_brand end as number from part"
SQL["rule_mutations"] = f"select count(*) filter (p_brand is distinct from {_LAST}) as n_changed from part"

SQL["validate_report"] = """
with t as (select cast(l_orderkey % 7 + 110 as integer) as vol, case when l_orderkey % 97 = 0 then '81-175' when l_orderkey % 89 = 0 then 'none' else (l_orderkey % 60 + 60) || '-' || (l_orderkey % 500) end as law,
  case when l_linestatus = 'O' then 'Section' when l_orderkey % 301 = 0 then 'Chapter' else 'Division' end as kind, l_orderkey % 194 = 0 as social, l_partkey from lineitem),
k as (select vol, sum(c) filter (c > 1) as d from (select vol, law || '-' || l_partkey as u, count(*) as c from t group by all) group by vol),
m as (select t.vol, count(*) as row_count, count(distinct law) as law_count, count(*) filter (law = 'none') as bad_ids, count(*) filter (l_partkey % 4 > 0) as with_text, count(*) filter (l_partkey % 50 = 0) as selected,
  count(*) filter (social and law = '81-175') as law_rule_0, count(distinct kind) filter (kind = 'Chapter') as n_bad_types from t group by t.vol),
r as (select m.*, cast(coalesce(d, 0) as bigint) as duplicate_keys, (n_bad_types > 0)::bigint + (bad_ids > 0)::bigint + (law_rule_0 > 0)::bigint as n_failed,
  (coalesce(d, 0) > 0)::bigint + (with_text / row_count < 0.8)::bigint + (selected <> 600)::bigint as n_warnings from m join k on m.vol = k.vol)
select vol, row_count, law_count, duplicate_keys, bad_ids, with_text, selected, law_rule_0, n_bad_types, n_failed, n_warnings, case when n_failed > 0 then 'failed' when n_warnings > 0 then 'warning' else 'passed' end as status from r
"""

SQL["law_count_diff"] = """
select o_orderpriority, count(*) as laws, count(*) filter (hit) as with_rows, count(*) filter (not hit) as missing
from (select o_orderpriority, o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') as hit from orders) group by o_orderpriority
"""
SQL["report_status"] = "select event_id, case when value > 80 then 'failed' when value > 40 then 'warning' else 'passed' end as status from events"
SQL["classify_family"] = "select p_partkey, case p_partkey % 6 when 0 then 'null-num' when 1 then 'top-level-container' when 2 then 'sibling-appropriations' when 3 then 'null-num' else 'none' end as family from part"
SQL["registry_dedupe_seen_again"] = "select user_id, event_type, min(event_id) as id, count(*) - 1 as seen_again_count from events group by user_id, event_type"
SQL["issue_append"] = "select c_name as name, lower(c_mktsegment) as kind from customer where c_custkey % 3 <> 0"
SQL["run_summary"] = "select o_orderstatus, count(*) as n, string_agg(distinct o_orderpriority, '|' order by o_orderpriority) as priorities from orders group by o_orderstatus"
SQL["active_over_pending"] = """
select s_suppkey as id, s_name as name, 'active' as status from supplier
union all select c_custkey, c_name, 'pending' from customer where c_custkey not in (select s_suppkey from supplier)
"""
_NULLS = ", ".join(f'cast(null as varchar) as "{c}"' for c in ("KeyVersion", "LawType", "LawTitle", "approvedDate", "Division", "Title", "SubTitle", "Chapter", "SubChapter", "SectionNumber", "SectionName", "DivisionHeadingLevel1", "DivisionHeadingLevel2", "DivisionHeadingLevel3", "Text", "Agencies_Row", "Agencies_Law"))
SQL["publish_columns"] = f"""
select cast(doc_id % 5 as integer) as vol, cast(doc_id as varchar) as "UniqueKey", 'Public Law 106–' || doc_id as "LawIdentifier", sha256(text) as "ContentHash", (doc_id % 3 = 0)::integer as "Selection", 'Section' as "EntryType",
  case when doc_id % 3 = 0 then 'Pending' else 'N/A' end as "ReviewStatus", cast(null as bigint) as "OriginalOrder", cast(null as integer) as "Order", cast(null as boolean) as "IsAppropriation", {_NULLS} from documents
"""
SQL["blank_fill"] = "select doc_id, case when quality = 1 then 'fine' else '(blank)' end as verdict from labels"
SQL["review_merge"] = "select d.doc_id, lang, case quality when 1 then 'Approved' when 0 then 'Rejected' else 'Pending' end as review_status from documents d left join labels l on d.doc_id = l.doc_id"

SQL["markup_walk"] = r"""
with x as (select doc_id, list_filter(list_transform(string_split(replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), chr(13), ''), chr(10)), lambda l: regexp_replace(l, '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g')), lambda l: l <> '') as l from documents)
select doc_id, unnest(range(1, len(l) + 1)) as line_no, cast(unnest(range(1, len(l) + 1)) as varchar) as number, md5(unnest(l)) as text_md5 from x
"""
SQL["json_extract"] = "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events"
SQL["incremental_skip"] = "select o_orderkey, md5(o_orderstatus || '|' || o_orderpriority || '|' || o_custkey) as digest from orders where o_orderkey % 2 <> 0 or o_orderkey % 10 = 0"
SQL["incremental_state"] = "select o_orderkey, case when o_orderkey % 4 = 0 then 'new' when o_orderkey % 4 = 1 then case when o_orderkey % 3 = 0 then 'new' else 'skip' end else 'stale' end as state from orders"

# The registry and the workflow around it.
_ENTRY_KIND = "case s_suppkey % 3 when 0 then 'law_id' when 1 then 'section_number' else 'other' end"
_IMPL = "case when s_suppkey % 7 = 0 then 'failed' when s_suppkey % 7 = 1 then 'implemented' end"
SQL["registry_append"] = f"""
with old as (
  select {_ENTRY_KIND} as type, cast(s_nationkey as varchar) as pattern, cast(s_suppkey % 4 as varchar) as description, count(*) - 1 as c from supplier group by all
), new as (
  select case c_custkey % 4 when 0 then 'law_id' when 1 then 'other' else 'section_number' end as type, cast(c_nationkey as varchar) as pattern, cast(c_custkey % 8 as varchar) as description, count(*) as k
  from customer where c_custkey % 4 <> 3 group by all
)
select type, pattern, description, 'pending' as status, c + coalesce(k, 0) as seen_again_count, false as is_new from old left join new using (type, pattern, description)
union all select type, pattern, description, 'pending', k - 1, true from new where not exists (select 1 from old where old.type = new.type and old.pattern = new.pattern and old.description = new.description)
"""
SQL["registry_review"] = f"""
with e as (
  select s_suppkey as id, case when s_suppkey % 5 = 0 or s_suppkey <= 6 then 'approved' when s_suppkey <= 8 then 'rejected' else 'pending' end as status,
    case when s_suppkey % 5 = 0 then null when s_suppkey <= 6 then 'r' when s_suppkey <= 8 then 's' end as reviewer, case when s_suppkey % 5 = 0 then null when s_suppkey <= 6 then '' when s_suppkey <= 8 then 'no' end as review_note,
    case when s_suppkey in (2, 3) then 'in_progress' else coalesce({_IMPL}, case when s_suppkey % 3 = 2 then 'pending' else 'not_required' end) end as implementation_status from supplier
)
select *, status = 'approved' and implementation_status in ('not_required', 'implemented', 'manual_override') as applied from e
"""
SQL["status_fan_out"] = f"""
select case when s_suppkey % 5 = 0 then 'active' else 'pending' end as file, s_suppkey as id, case when s_suppkey in (5, 6, 7) then 'implemented' else {_IMPL} end as implementation_status,
  case when s_suppkey in (5, 6, 7) then 'abc' end as implementation_commit_sha from supplier
"""
SQL["proposals_to_entries"] = """
select case when event_id % 4 = 0 then 'law_id' else 'other' end as type, event_type as pattern, 0::bigint as n_correction, user_id::integer as discovered_in_vol, 'v' as agent_version, 0.5::double as confidence,
  'pending' as status, user_id::integer as run_vol, 0::bigint as seen_again_count from events where event_id % 4 <> 2
"""
_ISSUES = """
issues as (
  select source as citable_as, case when doc_id % 2 = 0 then 7 else doc_id % 9 end::integer as volume, lang as issue, cast(doc_id % 50 as varchar) as line_numbers,
    case when length(coalesce(text, '')) > 32000 then left(text, 32000) || '…<TRUNCATED>' else coalesce(text, '') end as says from documents
)"""
SQL["issue_rows"] = f"with {_ISSUES} select citable_as, volume, '' as congress, issue, length(says)::bigint as n_chars, md5(says) as text_md5, line_numbers from issues"
SQL["issue_log"] = f"with {_ISSUES} select distinct lower(citable_as) as citable_as, volume, issue, line_numbers from issues where volume >= 4"
SQL["issue_coverage"] = """
with e as (select (event_id % 40)::integer as vol, event_type from events),
a as (select vol, count(*) as expected from e where event_type = 'view' or vol < 20 group by vol),
b as (select vol, count(*) as returned from e where vol % 3 > 0 and event_type <> 'view' group by vol)
select vol, expected, coalesce(returned, 0) as returned, coalesce(returned, 0) < expected as under from a left join b using (vol)
"""
SQL["coder_gates"] = """
select p_partkey, case when p_partkey % 5 = 0 then 'status: failed' when p_partkey % 5 = 4 then 'status: none' when p_partkey % 3 = 0 then 'out-of-scope file: ' || p_brand
  when p_partkey % 3 = 1 then 'forbidden file modified: pipeline/corrections_registry.py' when p_partkey % 2 = 1 then 'no new tests' end as why from part
"""
SQL["family_batches"] = """
select case s_suppkey % 4 when 0 then 'sibling-level' else 'null-num' end as family, max(s_suppkey) as task_id, string_agg(s_suppkey, '|' order by s_suppkey) as entry_ids
from supplier where s_suppkey % 4 < 2 and s_suppkey % 7 > 1 group by family
"""
SQL["affected_volumes"] = "select (o_orderkey % 5000)::integer as vol from orders where o_custkey % 3 = 0 union select s_nationkey::integer from supplier where s_suppkey = 1"
SQL["last_runs"] = "select o_custkey, array_to_string(list(o_orderkey order by o_orderkey)[-5:], '|') as runs from orders group by o_custkey"
SQL["duplicate_context"] = """
with o as (select o_custkey as k, case when o_orderkey % 9 > 0 then o_orderpriority end as law from orders),
g as (select k, count(*) as n from o group by k having count(*) > 1),
laws as (select distinct k, law, case law when '1-URGENT' then (select n_name from nation where n_nationkey = 0) when '2-HIGH' then (select n_name from nation where n_nationkey = 1) end as cited from o where law is not null),
told as (select k, string_agg(law, '|' order by law) as ids, string_agg(law || ':' || coalesce(cited, law) || ':' || case when cited is null then '' else 'a/b' end, '|' order by law) as context from laws group by k)
select g.k as "UniqueKey", n, least(n, 6)::bigint as n_rows, n > 6 as truncated, coalesce(ids, '') as law_identifiers, coalesce(context, '') as context from g left join told using (k)
"""

_TABLE = """
t as (
  select (l_orderkey % 7 + 110)::integer as vol, case when l_orderkey % 97 = 0 then '81-175' when l_orderkey % 89 = 0 then 'none' else (l_orderkey % 60 + 60) || '-' || (l_orderkey % 500) end as law,
    case when l_orderkey % 194 = 0 then 'Social Security Amendments' else 'An Act' end as title, case when l_linestatus = 'O' then 'Section' when l_orderkey % 301 = 0 then 'Chapter' else 'Division' end as kind from lineitem
)"""
SQL["schema_diff"] = """
select distinct (l_orderkey % 7 + 110)::integer as vol,
  'missing columns: KeyVersion, ContentHash, OriginalOrder, Order, LawType, approvedDate, IsAppropriation, Division, Title, SubTitle, Chapter, SubChapter, DivisionHeadingLevel1, DivisionHeadingLevel2, DivisionHeadingLevel3, Agencies_Row, Agencies_Law' as missing,
  'extra columns: more' as extra, 'failed' as status from lineitem
"""
SQL["law_count_check"] = f"""
with {_TABLE}, c as (select vol, count(distinct law) as here, coalesce(count(distinct law) filter (kind = 'Section'), 0) as there, count(*) filter (law = 'none') as bad from t group by vol)
select vol, case when here <> there then here || ' laws in the table, ' || there || ' in the source' else '' end as said, case when bad > 0 then bad || ' rows with a malformed LawIdentifier, such as none' else '' end as malformed from c
"""
SQL["appropriation_laws"] = f"""
with {_TABLE}
select distinct vol, law as "LawIdentifier", title as "LawTitle", exists (select 1 from t d where d.vol = t.vol and d.law = t.law and d.kind = 'Division') as is_appropriation from t where kind = 'Section'
"""
SQL["dictionary_volumes"] = """
with n as (select lower(p_type) as term, min(p_partkey % 5) as vol from part group by 1)
select lower(r_name) as term, r_regionkey + 1 as id from region
union all select term, (select count(*) from region) + row_number() over (order by vol, term) from n
"""
SQL["older_codes"] = "select p_partkey, case when p_partkey % 3 < 2 then lpad(cast(ascii(upper(left(p_name, 1))) - 64 as varchar), 3, '0') else '000' end as code from part"
SQL["files_to_fetch"] = "select o_orderkey as vol, o_orderstatus from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')"

# Markup along every path of containers.
_PATHS = "['', 'level', 'title/level', 'title', 'title/chapter/level', 'title/chapter', 'title/part/chapter/level', 'title/part/chapter', 'title/subtitle/level', 'title/subtitle', 'division', 'division/title/subtitle/level', 'division/title/subtitle', 'division/title/level', 'division/title', 'title/part', 'division/title/chapter', 'division/title/part/chapter', 'title/chapter/subchapter']"
_BLOCK_PATHS = "['', 'title/chapter', 'title/part/chapter', 'title', 'division/title', 'division']"


def _labels(parts: str) -> str:
    return ", ".join(f"case when list_contains({parts}, '{c.lower()}') then '{c.upper()} 1' end as \"{c}\"" for c in ("Division", "Title", "SubTitle", "Chapter", "SubChapter"))


def _walk(n: int) -> str:
    return f"""
with p as (select *, string_split({_PATHS}[p_partkey % {n} + 1], '/') as path from part)
select p_partkey, 'Section' as "EntryType", {_labels("path")}, 'SEC. ' || p_size || '.' as "SectionNumber", p_name as "SectionName", null::varchar as "DivisionHeadingLevel1", null::varchar as "DivisionHeadingLevel2", p_type as "Text" from p
"""


SQL["walk_paths"] = _walk(19)
SQL["walk_paths_strict"] = f"""
with p as (select *, {_PATHS}[p_partkey % 19 + 1] as way from part),
w as (select *, string_split(way, '/') as steps, way in ('title/part', 'title/chapter/subchapter', 'division/title/chapter', 'division/title/part/chapter') as closed from p),
o as (select *, case when not closed then steps end as path from w)
select p_partkey, 'Section' as "EntryType", {_labels("path")}, 'SEC. ' || p_size || '.' as "SectionNumber", p_name as "SectionName",
  case when closed then upper(steps[1]) || ' 1' end as "DivisionHeadingLevel1", case when closed then upper(steps[2]) || ' 1' end as "DivisionHeadingLevel2", p_type as "Text" from o where not (closed and steps[1] = 'division')
"""
SQL["walk_blocks"] = f"""
with p as (select *, string_split({_BLOCK_PATHS}[p_partkey % 6 + 1], '/') as path from part)
select p_partkey, 'Division' as "EntryType", {_labels("path")}, null::varchar as "SectionNumber", null::varchar as "SectionName", p_brand as "DivisionHeadingLevel1", p_name as "DivisionHeadingLevel2", p_type as "Text" from p
"""
SQL["walk_compat"] = """
with c as (select unnest([null, 'CHAPTER 1', 'CHAPTER 2']) as chapter), r as (select unnest([1, 2, 3]) as n)
select p_partkey, case when n = 3 then 'Division' else 'Section' end as "EntryType", 'D' as "Division", 'T' as "Title", null::varchar as "SubTitle", chapter as "Chapter", null::varchar as "SubChapter",
  case when n < 3 then n::varchar end as "SectionNumber", null::varchar as "SectionName", case when n = 3 then 'H' end as "DivisionHeadingLevel1", null::varchar as "DivisionHeadingLevel2",
  case n when 1 then p_type when 2 then p_name else p_brand end as "Text" from part, c, r
"""
SQL["walk_recovery"] = """
select p_partkey, 'Section' as "EntryType", null::varchar as "Division", null::varchar as "Title", null::varchar as "SubTitle", null::varchar as "Chapter", null::varchar as "SubChapter",
  case p_partkey % 5 when 0 then '9' when 1 then null else '1' end as "SectionNumber", null::varchar as "SectionName", case when p_partkey % 5 < 2 then 'PART I-X' end as "DivisionHeadingLevel1",
  case when p_partkey % 5 = 1 then p_brand end as "DivisionHeadingLevel2",
  case p_partkey % 5 when 0 then p_type when 2 then '(a) ' || p_name || chr(10) || '(b) y' when 4 then p_name || chr(10) || 'two' else p_name end as "Text" from part
"""
SQL["law_sequence"] = """
with s as (select (s_nationkey + 100)::integer as vol, s_suppkey as k, row_number() over (partition by s_nationkey order by s_suppkey) - 1 as i from supplier)
select vol, i::integer as xml_index, 'Public Law 99-' || k as citable_as, k as law_number, k % 4 <> 0 as is_public, (2 + 3 * i)::integer as sourceline, (4 + 3 * i)::integer as line_end, 'uslm/pLaw' as tag_path from s
"""
