"""DuckDB SQL for the queries that SQL can express."""

_OP1 = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from benchmark where item_id is not null and text is not null
), windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from (select *, least(10, len(w)) as n from item_words where len(w) > 0))
), grams as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from words, (select distinct n from windows) where len(w) >= n)
), found as (
  select doc_id, g.n, i, item_id from grams g join windows v on g.g = v.g and g.n = v.n
), hit as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from words left join hit on words.doc_id = hit.doc_id left join items on words.doc_id = items.doc_id
"""

_OP2 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as double)) as v
  from embeddings where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as n from scored
)
select query_id, cast(n as integer) as rank, vec_id, score from ranked where n <= 10
"""

_OP4 = """
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped as (
  select *, regexp_replace(text, '(<\\\\*)(\\||/?s>|</?SYS>>)', '\\1\\\\\\2', 'g') as a from rows
), twice as (
  select *, regexp_replace(regexp_replace(a, '(\\|\\\\*)>', '\\1\\\\>', 'g'), '(\\[\\\\*)(/?INST\\])', '\\1\\\\\\2', 'g') as e from escaped
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(role) + length(e) + 13) as bigint) as formatted_chars
from twice group by conv_id
"""

_OP8 = r"""
with split as (
  select doc_id, text, string_split(text, chr(10)) as own from documents
), flat as (
  select doc_id, pos, trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line
  from (select doc_id, unnest(own) as x, unnest(range(1, len(own) + 1)) as pos from split where doc_id is not null)
), placed as (
  select *, row_number() over (partition by doc_id order by pos) as p, len(regexp_extract_all(line, '[^ \x09-\x0D]+')) as w
  from flat where line <> ''
), lists as (
  select doc_id, list(line order by p) as lines, list(w order by p) as w from placed group by doc_id
), spans as (
  select doc_id, lines, i, list_filter(range(i, least(i + 8, len(w) + 1)), lambda j: list_sum(w[i:j]) >= 8)[1] as j
  from (select *, unnest(range(1, len(w) + 1)) as i from lists)
  union all
  select doc_id, lines, list_filter(range(greatest(j - 7, 1), j + 1), lambda i: list_sum(w[i:j]) >= 8)[-1] as i, j
  from (select *, unnest(range(1, len(w) + 1)) as j from lists)
), runs as (
  select doc_id, i, j, array_to_string(lines[i:j], chr(10)) as run from spans where i is not null and j is not null
), gone as (
  select distinct doc_id, unnest(range(i, j + 1)) as p
  from runs join (select run, min(doc_id) as first from runs group by run having min(doc_id) <> max(doc_id)) using (run) where doc_id > first
), lost as (
  select doc_id, list(pos) as ats, count(*) as n from placed join gone using (doc_id, p) group by doc_id
), kept as (
  select doc_id, text, own, ats, case when n = len(w) then [] else list_filter(own, lambda x, pos: not list_contains(ats, pos)) end as kept
  from split left join lost using (doc_id) left join lists using (doc_id)
), made as (
  select doc_id, coalesce(len(own), 0) as n_lines, coalesce(len(own), 0) - coalesce(len(case when ats is null then own else kept end), 0) as n_deleted,
    coalesce(case when ats is null then text else coalesce(array_to_string(kept, chr(10)), '') end, '') as clean
  from kept
)
select doc_id, cast(n_lines as bigint) as n_lines, cast(n_deleted as bigint) as n_deleted, cast(length(clean) as bigint) as n_chars, sha256(clean) as text_sha256 from made
"""

#: Enough for pages that keep their text in one article of headings, paragraphs and line breaks, with few references.
_OP10 = r"""
with a as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) as body from pages
), blocks as (
  select page_id, url, string_split(regexp_replace(body, '</?(article|h[1-6]|p|div|ul|ol|li|section|blockquote)(\s[^>]*)?>', chr(1), 'g'), chr(1)) as b from a
), plain as (
  select page_id, url, list_transform(b, lambda x: regexp_replace(regexp_replace(x, '<br\s*/?>', ' ', 'g'), '<[a-zA-Z/!?][^>]*>', '', 'g')) as b from blocks
), decoded as (
  select page_id, url, list_transform(b, lambda x: replace(replace(replace(replace(regexp_replace(x, '&amp;?', '&amp;', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) as b from plain
), tidy as (
  select page_id, url, array_to_string(list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text from decoded
)
select page_id, url, text, length(text)::bigint as n_chars from tidy
"""

_OP13 = r"""
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), ranks as (
  select *, len(u) as n, list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(h, i, 8) as bigint)) as k from units
), cuts as (
  select *, least(k[1] % (n + 1), k[2] % (n + 1)) as a, greatest(k[1] % (n + 1), k[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or k[3] % 100 >= 90 then 'plain' when k[4] % 100 < 20 then 'spm' else 'psm' end as form
  from ranks
), parts as (
  select *, coalesce(array_to_string(u[:a], ''), '') as p, coalesce(array_to_string(u[a + 1:b], ''), '') as m, coalesce(array_to_string(u[b + 1:], ''), '') as s from cuts
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars, case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(p || m || s) as restored_sha256
from parts
"""

_OP12 = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null
), lengths as (
  select conv_id, max(i) as own_n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, step: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::bigint) % 6 as h
  from turns group by conv_id
), convs as (
  select c.*, least(h, coalesce(b.n, 0)) as kept from lengths c left join (select conv_id as base, max(i) as n from turns group by conv_id) b on b.base = c.conv_id - c.conv_id % 100
), rebuilt as (
  select c.conv_id, t.i as depth, role, text from convs c join turns t on t.conv_id = c.conv_id - c.conv_id % 100 and t.i <= c.h
  union all
  select c.conv_id, t.i - c.h + c.kept as depth, role, text from convs c join turns t on t.conv_id = c.conv_id and t.i > c.h
), paths as (
  select conv_id, depth, length(text) as chars, string_agg(length(role) || ':' || role || length(text) || ':' || text, '' order by depth) over (partition by conv_id order by depth) as node from rebuilt
  union all
  select conv_id, 0, 0, '' from convs
), occ as (
  select conv_id, depth, chars, sha256(node) as node, max(depth) over (partition by conv_id) as n from paths
), own as (
  select node, depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * min(chars) as saved, max(n) = depth as leaf,
    sha256(coalesce(string_agg(case when depth = n then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256
  from occ group by node, depth
), below as (
  select distinct a.node, b.node as under from occ a join occ b on b.conv_id = a.conv_id and b.depth >= a.depth
), totals as (
  select b.node, sum(saved) as saved_tokens, sum(leaf::int) as n_leaves from below b join own o on o.node = b.under group by b.node
), edges as (
  select distinct b.node, a.node as parent from occ a join occ b on b.conv_id = a.conv_id and b.depth = a.depth + 1
), children as (
  select parent as node, count(*) as n from edges group by parent
)
select o.conv_id, o.depth, p.conv_id as parent_conv_id, o.n_convs::bigint as n_convs, coalesce(c.n, 0)::bigint as n_children, t.n_leaves::bigint as n_leaves, t.saved_tokens::bigint as saved_tokens, o.ends_sha256
from own o join totals t on t.node = o.node left join edges e on e.node = o.node left join own p on p.node = e.parent left join children c on c.node = o.node
"""

SQL = {"op1_decontamination": _OP1, "op2_topk": _OP2, "op4_chat": _OP4, "op8_linededup": _OP8, "op10_html": _OP10, "op12_prefixtrie": _OP12, "op13_fim": _OP13}
