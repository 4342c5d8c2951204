"""SQL (DuckDB's) for the rows of corpus queries that SQL can express."""

from __future__ import annotations

CHAT = r"""
with recursive turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized as (
    select *, row_number() over own - 1 as i, (strlen(text) + 3) // 4 + 4 as tokens,
        32 + length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|\|[a-z_]+\|>)', '\1\\\2\3', 'g'))
           + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|\|[a-z_]+\|>)', '\1\\\2\3', 'g')) as chars
    from turns window own as (partition by conv_id order by turn nulls first, role, text)
), t as (
    select *, coalesce(sum(tokens) over (partition by conv_id order by i rows between unbounded preceding and 1 preceding), 0) as pre,
        first_value(role) over (partition by conv_id order by i) = 'system' as lead,
        case when first_value(role) over (partition by conv_id order by i) = 'system' then first_value(tokens) over (partition by conv_id order by i) else 0 end as lead_tokens
    from sized
), spans as (
    select conv_id, i, i as a, pre as pre_a, 1 as k from t where i = 0
    union all
    select conv_id, i, case when cut then i else a end, case when cut then pre else pre_a end, case when cut then k + 1 else k end
    from (
        select t.conv_id, t.i, t.pre, s.a, s.pre_a, s.k, t.pre + t.tokens - s.pre_a > case when s.k = 1 then 2048 else greatest(1, 1536 - t.lead_tokens) end as cut
        from spans s join t on t.conv_id is not distinct from s.conv_id and t.i = s.i + 1
    )
), windows as (
    select s.conv_id, s.k, s.a, s.pre_a, max(t.i) as last, t.lead, s.k = 1 or sum(t.tokens) > 1536 - t.lead_tokens as alone
    from spans s join t on t.conv_id is not distinct from s.conv_id and t.i = s.i
    group by s.conv_id, s.k, s.a, s.pre_a, t.lead, t.lead_tokens
), shown as (
    select w.conv_id, w.k, sum(t.chars) as chars
    from windows w join t on t.conv_id is not distinct from w.conv_id and (
        t.i between w.a and w.last
        or w.k > 1 and w.lead and t.i = 0
        or not w.alone and t.i < w.a and t.i >= w.lead::int and w.pre_a - t.pre <= 512)
    group by w.conv_id, w.k
), formatted as (
    select conv_id, sum(chars)::bigint as formatted_chars, count(*) as n_windows from shown group by conv_id
), said as (
    select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by i) as turns,
        coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '') as loss
    from t group by conv_id
)
select s.conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256, formatted_chars, n_windows
from said s join formatted f on f.conv_id is not distinct from s.conv_id
"""

TRIE = r"""
with t as (
    select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i, {'role': coalesce(role, ''), 'text': coalesce(text, '')} as x
    from conversations where conv_id is not null
), c as (
    -- CRC-32 of the decimal id, bit by bit: each character's byte, then eight shifts
    select conv_id, list(x order by i) as xs, conv_id - conv_id % 20 as head, xor(4294967295::bigint, list_reduce(
        list_concat([4294967295::bigint], flatten([[ord(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1] for ch in string_split(conv_id::varchar, '')])),
        lambda crc, b: case when b >= 0 then xor(crc, b) else xor(crc >> 1, 3988292384::bigint * (crc & 1)) end)) % 4 as h
    from t group by conv_id
), p as (
    select c.conv_id, case when g.conv_id is null then list_slice(c.xs, c.h + 1, len(c.xs)) else list_concat(list_slice(g.xs, 1, c.h), list_slice(c.xs, c.h + 1, len(c.xs))) end as turns
    from c left join c g on g.conv_id = c.head
), m as (
    select conv_id, len(turns) as n, d, list_slice(turns, 1, d) as pre from (select *, unnest(range(len(turns) + 1)) as d from p)
), nodes as (
    select pre, d, min(conv_id) as conv_id, count(*) as n_convs, coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '') as ends from m group by pre, d
), k as (
    select list_slice(pre, 1, d - 1) as up, d - 1 as up_d, count(*) as n_children from nodes where d > 0 group by 1, 2
), w as (
    select nodes.*, coalesce(n_children, 0) as n_children, case when d = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(pre[d].text, '[^\x20\x09-\x0D]+')) end as gain
    from nodes left join k on up_d = d and up = pre
), s as (
    select a.pre, a.d, count(*) filter (b.n_children = 0) as n_leaves, sum(b.gain) as saved from w a join w b on b.d >= a.d and list_slice(b.pre, 1, a.d) = a.pre group by 1, 2
)
select w.conv_id, w.d as depth, u.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved::bigint as saved_tokens, sha256(w.ends) as ends_sha256
from w join s on s.d = w.d and s.pre = w.pre left join w u on u.d = w.d - 1 and u.pre = list_slice(w.pre, 1, w.d - 1)
"""

ORACLES: dict[str, str] = {"op6_chat": CHAT, "op12_trie": TRIE}
