"""DuckDB SQL of this subpackage's queries, where SQL can express them.

The secret spans, sketches, forests, packings, shards, suffix orders, learned
scores and chat windows have no form in SQL; ``tests/llm`` holds them against
brute force.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
with d as (select doc_id, {_WORDS.format("text")} as w from documents),
i as (select item_id::varchar as item, {_WORDS.format("text")} as w from benchmark),
iw as (select item, array_to_string(w[s : s + m - 1], ' ') as k, m from (select item, w, least(10, len(w)) as m, unnest(range(1, len(w) - least(10, len(w)) + 2)) as s from i where len(w) > 0)),
dw as (select doc_id, p, m, array_to_string(w[p : p + m - 1], ' ') as k from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as p from d, (select distinct m from iw))),
h as (select dw.doc_id, iw.item, dw.p, dw.m from dw join iw on dw.k = iw.k and dw.m = iw.m),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(p, p + m)) as p from h) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item from h) group by 1)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""


_CRC = "xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c::varchar, ''), lambda x: ord(x)::bigint)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x // 2, 3988292384 * (x % 2)))), 4294967295)"

_BLANK_WORDS = r"len(regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+'))::bigint"

OP11 = f"""
with t as (select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p from conversations where conv_id is not null),
k as (select c, p, md5(length(role) || ':' || role || text) as k, {_BLANK_WORDS.format("text")} as words from t),
i as (select c, c - c % 20 as base, {_CRC} % 4 as h from (select distinct c from t)),
f as (select i.c, p, k, words from i join k on k.c = i.base and p <= h),
n as (select i.c, i.h, count(f.p) as n from i left join f using (c) group by 1, 2),
r as (select c, p as d, k, words from f union all select n.c, p - h + n, k, words from n join k on k.c = n.c and p > h),
l as (select i.c, list(k order by d) filter (k is not null) as ks from i left join r using (c) group by 1),
pre as (select c, coalesce(len(ks), 0) as len, d, md5(array_to_string(ks[1:d], ' ')) as node, case when d > 0 then md5(array_to_string(ks[1:d - 1], ' ')) end as parent from l, unnest(range(0, coalesce(len(ks), 0) + 1)) as u(d)),
m as (select coalesce(pre.node, md5('')) as node, pre.d, pre.c, coalesce(parent, case when pre.d > 0 then md5('') end) as parent, len, coalesce(words, 0) as words from pre left join r on r.c = pre.c and r.d = pre.d),
nodes as (select node, d, min(c) as conv_id, any_value(parent) as parent, count(*) as n_convs, max(words) as words, string_agg(c::varchar, ',' order by c) filter (len = d) as ends from m group by 1, 2),
kids as (select parent as node, count(*) as n_children from nodes where d > 0 group by 1),
w as (select conv_id, d, coalesce(n_children, 0) as n_children, case when n_children is null then 1 else 0 end as leaf, (n_convs - 1) * words as saved from nodes left join kids using (node)),
s as (select m.node, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from w join m on m.c = w.conv_id and m.d <= w.d group by 1)
select nodes.conv_id, nodes.d as depth, p.conv_id as parent_conv_id, nodes.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, sha256(coalesce(nodes.ends, '')) as ends_sha256
from nodes join s using (node) left join kids using (node) left join nodes p on p.node = nodes.parent
"""

OP12 = f"""
with recursive d as (select doc_id, source, {_BLANK_WORDS.format("text")} as size, ('0x' || md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, ''))[1:15])::bigint as h from documents),
s as (select source, sum(size)::bigint as source_size, 2 * sum(size)::bigint as cap, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from d group by source),
b as (select 1.5::double * sum(source_size)::double as budget, sum(w)::double as weights from s),
r(k, level, closed) as (select 0, budget / weights, 0::bigint from b
  union all select k + 1, (budget - sum(cap) filter (level * w > cap)::double) / sum(w) filter (not level * w > cap)::double, count(*) filter (level * w > cap) from r, s, b group by k, level, closed, budget having count(*) filter (level * w > cap) > closed),
t as (select source, source_size, case when level * w > cap then cap::double else level * w end as target from s, (select arg_max(level, k) as level from r)),
q as (select *, floor(target + 0.5)::bigint as budget, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as times from t),
c as (select *, sum(size) over (partition by source order by h)::bigint as upto, sum(size) over (partition by source, h)::bigint as tied from d)
select doc_id, size, source_size, target, (times * size + case when budget - times * source_size >= upto then size when budget - times * source_size <= upto - tied then 0 else (budget - times * source_size - upto + tied) * size // tied end)::bigint as taken
from c join q on c.source is not distinct from q.source
"""

_DRAWN = "('0x' || sha256('1:' || coalesce(doc_id::varchar, ''))[{0}:{1}])::bigint"

OP13 = f"""
with d as (select doc_id, coalesce(text, '') as t, {", ".join(f"{_DRAWN.format(8 * k + 1, 8 * k + 8)} as h{k + 1}" for k in range(4))} from documents),
u as (select *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as us, case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from d),
c as (select *, len(us) as n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) as a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) as b from u),
p as (select *, coalesce(array_to_string(us[1:a], ''), '') as p, coalesce(array_to_string(us[a + 1:b], ''), '') as m, coalesce(array_to_string(us[b + 1:], ''), '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from p
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2, "op11_prefix_trie": OP11, "op12_mixing": OP12, "op13_fill_middle": OP13}
