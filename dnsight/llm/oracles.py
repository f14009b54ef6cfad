"""DuckDB SQL for the rows of the queries on conversations and phrases."""

from __future__ import annotations

MARKS = "\\### Assistant: </turn> ok"

#: Turns in order, with null role and text as empty.
_TURNS = (
    "select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,"
    " row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place"
)

CHAT = rf"""
with turns as (
  {_TURNS} from (
    select conv_id, turn, role, text from conversations
    union all select -7, 0, 'user', '{MARKS}' union all select -7, 1, 'assistant', '{MARKS}')
), sized as (
  select *, role = 'assistant' as reply,
    length('<turn ' || replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A') || '>')
      + length(regexp_replace(text, '(\\*)(</?turn)', '\1\1\\\2', 'g')) + 10 as size
  from turns
), ended as (
  select *, sum(size) over (partition by conv_id order by place) as text_end,
    place = max(place) over (partition by conv_id) as last
  from sized
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (reply), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (reply), '')) as loss_sha256,
  sum(text_end) filter (reply or last)::bigint as formatted_chars,
  count(*) filter (reply or last)::bigint as n_examples, sum(size)::bigint as stored_chars
from ended group by conv_id
"""

PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc, unnest(range(1, len(parts) + 1)) as piece, unnest(parts) as words
  from (
    select lang, row_number() over () as doc,
      string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]') as parts
    from documents)
), words as (
  select lang, doc, piece, unnest(range(1, len(w) + 1)) as place, unnest(w) as w1
  from (select lang, doc, piece, regexp_extract_all(words, '[^ \t]+') as w from pieces)
), runs as (
  select lang, w1, lead(w1) over p as w2, lead(w1, 2) over p as w3 from words
  window p as (partition by lang, doc, piece order by place)
), f1 as (select lang, w1, count(*) as a from runs group by all),
f2 as (select lang, w1, w2, count(*) as a from runs where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) as a from runs where w3 is not null group by all having count(*) >= 10),
n as (select lang, sum(a) as n from f1 group by lang),
inner2 as (
  select f2.lang, f2.w1, f2.w2 from f2 join f3 on f3.lang = f2.lang and f3.w1 = f2.w1 and f3.w2 = f2.w2 where 100 * f3.a >= 50 * f2.a
  union select f2.lang, f2.w1, f2.w2 from f2 join f3 on f3.lang = f2.lang and f3.w2 = f2.w1 and f3.w3 = f2.w2 where 100 * f3.a >= 50 * f2.a
), cuts as (
  select f2.lang, f2.w1 || ' ' || f2.w2 as phrase, 1 as cut, f2.a, p.a as l, q.a as r
  from f2 join f1 p on p.lang = f2.lang and p.w1 = f2.w1 join f1 q on q.lang = f2.lang and q.w1 = f2.w2
  where f2.a >= 10 and not exists (select 1 from inner2 i where i.lang = f2.lang and i.w1 = f2.w1 and i.w2 = f2.w2)
  union all select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.a, p.a, q.a
  from f3 join f1 p on p.lang = f3.lang and p.w1 = f3.w1 join f2 q on q.lang = f3.lang and q.w1 = f3.w2 and q.w2 = f3.w3
  union all select f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.a, p.a, q.a
  from f3 join f2 p on p.lang = f3.lang and p.w1 = f3.w1 and p.w2 = f3.w2 join f1 q on q.lang = f3.lang and q.w1 = f3.w3
), scored as (
  select *, 1000000::hugeint * a * a // (l::hugeint * r) as score from cuts
), lowest as (
  select *, row_number() over (partition by lang, phrase order by score, cut) as k from scored
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest where k = 1
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score,
  cut::bigint as cut
from ranked join n using (lang) where rank <= 2000
"""

#: crc32 of a short ASCII text: the table of the remainders of all bytes, then one step per character.
_CRC = (
    "xor(list_reduce([4294967295] || list_transform(string_split(conv_id::varchar, ''), lambda s: ascii(s)::bigint),"
    " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
)

TRIE = rf"""
with tab as (
  select list(list_reduce([i] || range(8), lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
  from range(256) r(i)
), turns as ({_TURNS} from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 5 as base, {_CRC} % 9 as h
  from (select distinct conv_id from turns), tab
), made as (
  select c.conv_id, 0 as part, t.place, role, text from convs c join turns t on t.conv_id = c.base where t.place < c.h
  union all select c.conv_id, 1, t.place, role, text from convs c join turns t on t.conv_id = c.conv_id where t.place >= c.h
), ordered as (
  select conv_id, row_number() over p as depth, text, sha256(role || chr(0) || text) as own from made
  window p as (partition by conv_id order by part, place)
), chained as (
  select conv_id, depth, text, string_agg(own, '') over (partition by conv_id order by depth) as path from ordered
  union all select conv_id, 0, '', '' from convs
), sized as (select *, max(depth) over (partition by conv_id) as length from chained),
members as (select *, min(conv_id) over (partition by depth, path) as node from sized),
nodes as (
  select node, depth, count(*) as n_convs, max(octet_length(encode(text))) as size,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = depth), '')) as ends_sha256
  from members group by node, depth
), parents as (
  select n.*, m.node as parent from nodes n left join members m on m.conv_id = n.node and m.depth = n.depth - 1
), counted as (
  select p.*, (select count(*) from parents k where k.parent = p.node and k.depth = p.depth + 1) as n_children from parents p
), totals as (
  select m.node, m.depth, sum((c.n_children = 0)::int) as n_leaves, sum(c.size * (c.n_convs - 1)) as saved_tokens
  from counted c join members m on m.conv_id = c.node and m.depth <= c.depth group by m.node, m.depth
)
select node::bigint as conv_id, depth::bigint as depth, parent::bigint as parent_conv_id, n_convs::bigint as n_convs,
  n_children::bigint as n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
from counted join totals using (node, depth)
"""
