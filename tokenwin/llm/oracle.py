"""The same results in plain SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

_SHINGLES = """
  select {key}, list_distinct([w[i:i + 4] for i in range(1, len(w) - 3)]) as s
  from (select {key}, [x for x in regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+') if x <> ''] as w from {table})"""

_OP1 = f"""
with items as ({_SHINGLES.format(key="item_id", table="benchmark")}),
docs as ({_SHINGLES.format(key="doc_id", table="documents")}),
item as (select item_id, len(s) as size, unnest(s) as shingle from items),
doc as (select doc_id, unnest(s) as shingle from docs)
select doc_id, item_id, count(distinct shingle) as matched, any_value(size) as size,
  count(distinct shingle)::double / any_value(size) as containment
from doc join item using (shingle) group by doc_id, item_id
having count(distinct shingle) >= 0.8 * any_value(size)"""

_WEIGHT = "(1.0 - length(regexp_replace(text, '[A-Za-z \\n]+', '', 'g'))::double / greatest(length(text), 1))"

def _pass(n: int) -> str:
    """Take what fits the gap together, in the order of keys, of the documents that fit it alone."""
    return f"""
gap{n} as (
  select *, rest - coalesce(sum(case when inside then size end) over (partition by source), 0) as gap from pass{n - 1}),
own{n} as (select *, case when not inside and epochs < 3 and size <= gap then size else 0 end as own from gap{n}),
pass{n} as (
  select * exclude (inside, gap, own), inside or (own > 0 and sum(own) over (
    partition by source order by key, doc_id, size rows unbounded preceding) <= gap) as inside
  from own{n})"""


# The level of the targets: sources by limit / weight, and the first whose share stays within its limit.
_OP5 = f"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    -ln((('0x' || substr(md5(doc_id::varchar), 1, 13))::bigint + 0.5) / 4503599627370496.0)
      / greatest(0.05, {_WEIGHT}) as key
  from documents),
sizes as (select source, sum(size)::bigint as s from docs group by source),
weighed as (
  select source, s, list_extract([5.0::double, 2.0, 1.0], ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int) as w
  from sizes),
rests as (
  select *, (sum(s) over () - coalesce(sum(3 * s) over before, 0))::double / (sum(w) over () - coalesce(sum(w) over before, 0)) as level
  from weighed
  window before as (order by 3 * s / w, source rows between unbounded preceding and 1 preceding)),
levels as (select *, max(case when level * w <= 3 * s then level end) over () as fair from rests),
targets as (select source, s, least(3.0 * s, coalesce(fair * w, 3.0 * s)) as target from levels),
pass0 as (
  select d.*, t.s, t.target, least(3, floor(t.target / t.s)) as epochs, t.target - floor(t.target / t.s) * t.s as rest, false as inside
  from docs d join targets t on d.source is not distinct from t.source),
{_pass(1)}, {_pass(2)}, {_pass(3)},
gaps as (
  select *, rest - coalesce(sum(case when inside then size end) over (partition by source), 0) as gap from pass3),
closing as (
  select *, case when not inside and epochs < 3 and size > 0 and abs(gap - size) < gap then
    row_number() over (partition by source, not inside and epochs < 3 and size > 0 and abs(gap - size) < gap
      order by abs(gap - size), key, doc_id) end as nth
  from gaps)
select doc_id, size, s as source_size, target,
  ((epochs + case when inside or nth = 1 then 1 else 0 end) * size)::bigint as taken
from closing"""

_OP7 = """
with bodies as (select page_id, encode(coalesce(html, '')) as body from pages),
hashed as (select page_id, octet_length(body)::bigint as n, sha1(body) as h from bodies),
named as (
  select *, min(page_id) over (partition by h) as first,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(h, 5 * (i // 4) + 1, 5))::int >> (5 * (3 - i % 4))) % 32 + 1, 1) for i in range(0, 32)], '') as digest
  from hashed)
select page_id, n as payload_bytes, digest as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from named"""

_OP10 = """
with lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i
  from documents),
pages as (select source, count(*) as pages from documents group by source),
often as (
  select l.source, trim(line, ' ') as line
  from lines l join pages p on l.source is not distinct from p.source
  where trim(line, ' ') <> ''
  group by l.source, trim(line, ' ')
  having count(distinct doc_id) >= 5 and count(distinct doc_id) > 0.02 * any_value(pages)),
marked as (
  select l.*, o.line is not null as drop
  from lines l left join often o on l.source is not distinct from o.source and trim(l.line, ' ') = o.line)
select doc_id, count(*)::int as n_lines, (count(*) filter (drop))::int as n_dropped,
  md5(coalesce(string_agg(line, chr(10) order by i) filter (not drop), '')) as text_md5
from marked group by doc_id"""

# Unsigned crc32, bit by bit: a byte joins the register, and eight times -1 shifts it.
_CRC = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(length({0})),
  lambda i: list_concat([ascii(substr({0}, i + 1, 1))::bigint], list_transform(range(8), lambda k: -1::bigint))))),
  lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295)"""

_OP11 = f"""
with own as (
  select conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first, coalesce(role, '')) as w
  from conversations where conv_id is not null group by conv_id),
heads as (select conv_id, w, ({_CRC.format("conv_id::varchar")} % 4)::bigint as h from own),
rebuilt as (
  select o.conv_id, list_concat(coalesce(b.w[1:o.h], []), o.w[o.h + 1:]) as w
  from heads o left join own b on b.conv_id = o.conv_id - o.conv_id % 20),
paths as (select conv_id, d, w[1:d] as p, d = len(w) as ends from (select *, unnest(range(len(w) + 1)) as d from rebuilt)),
nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
  from paths group by p, d),
kids as (select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by 1),
marked as (
  select n.*, coalesce(k.n_children, 0) as n_children,
    case when d = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(n.p[d].t, '[^\\x20\\x09-\\x0D]+')) end as saved
  from nodes n left join kids k using (p)),
below as (
  select p[1:up] as p, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved_tokens
  from (select *, unnest(range(d + 1)) as up from marked) group by 1)
select m.conv_id, m.d as depth, a.conv_id as parent_conv_id, m.n_convs, m.n_children,
  b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens, m.ends_sha256
from marked m join below b on b.p = m.p left join nodes a on m.d > 0 and a.p = m.p[1:m.d - 1]"""

SQL = {"op1_decontamination": _OP1, "op5_mix": _OP5, "op7_warc": _OP7, "op10_lines": _OP10, "op11_prefix_tree": _OP11}
