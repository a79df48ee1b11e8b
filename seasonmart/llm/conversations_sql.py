"""DuckDB SQL for the queries on conversations."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The unsigned crc32 of an ASCII text: eight steps a byte by the polynomial's bits."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: cast(ascii(ch) as bigint))"
    byte = (
        "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    )
    return f"xor(list_reduce(list_concat([cast(4294967295 as bigint)], {codes}), lambda c, b: {byte}), 4294967295)"


#: What may come next by state (0 nothing yet, 1 system, 2 user, 3 assistant): role due, state after.
_DUE = ("user", "user", "assistant", "user")
_NEXT = (2, 2, 3, 2)


def _after_insertions(state: int, times: int) -> tuple[int, list[str]]:
    roles = []
    for _ in range(times):
        roles.append(_DUE[state])
        state = _NEXT[state]
    return state, roles


def _way(state: int, times: int, cost: str, letter: str, line: str | None, holds: str | None = None) -> str:
    """What becomes of the best way to ``state`` by some insertions and one edit."""
    inserted = [f"'{role}:'" for role in _after_insertions(state, times)[1]]
    lines = ", ".join(inserted + ([line] if line else []))
    made = (
        f"{{'c': b[{state + 1}].c + {5 * times} + {cost}, 'a': b[{state + 1}].a || '{'I' * times + letter}', "
        f"'l': list_concat(b[{state + 1}].l, cast([{lines}] as varchar[]))}}"
    )
    return f"case when {holds} then {made} end" if holds else made


def _steps(end: int) -> str:
    """The best of all ways that lead to ``end`` in one row."""
    ways = []
    for state in range(4):
        for times in range(3):
            at, _ = _after_insertions(state, times)
            if at == end:
                ways.append(_way(state, times, "2", "D", None))
            sound = "fault not in ('blank', 'duplicate')"
            extra = "case when fault = 'truncated' then 5 else 0 end"
            if _NEXT[at] == end:
                role = _DUE[at]
                ways.append(_way(state, times, f"1 + {extra}", "R", f"'{role}:' || text", sound))
                ways.append(_way(state, times, extra, "K", "role || ':' || text", f"{sound} and initial = '{role[0]}'"))
            if at == 0 and end == 1:
                ways.append(_way(state, times, extra, "K", "role || ':' || text", f"{sound} and initial = 's'"))
    return f"list_min([{', '.join(ways)}])"


_FAR = "{'c': cast(1000000000000 as bigint), 'a': '', 'l': cast([] as varchar[])}"
_COMPLETE = ", ".join(_way(s, n, "0", "", None) for s, n in ((0, 0), (1, 2), (2, 1), (3, 0)))

REPAIR = rf"""
with recursive given as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as draw
    from conversations
),
damaged as (
    select conv_id, turn, case when draw = 4 then 'user' else role end as role,
        case when draw = 1 then '' when draw = 2 then translate(text, '.!?', '') else text end as text
    from (select *, unnest(case when draw = 3 then [0, 1] else [0] end) as copy from given where draw <> 0)
),
placed as (
    select *, substr(role, 1, 1) as initial,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
    from damaged
),
marked as (
    select *, lead(initial) over (partition by conv_id order by place) as following,
        case when body = '' then 'blank'
            when row_number() over (partition by conv_id, role, text order by place) > 1 then 'duplicate'
            when body[-1] not in ('.', '!', '?') then 'truncated' else 'none' end as fault
    from placed
),
counts as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (following is not null and initial || following not in ('su', 'ua', 'au')) as illegal,
        count(*) as n
    from marked group by conv_id
),
ways as (
    select conv_id, n, cast(0 as bigint) as place,
        [{{'c': cast(0 as bigint), 'a': '', 'l': cast([] as varchar[])}}, {_FAR}, {_FAR}, {_FAR}] as b
    from counts
    union all
    select w.conv_id, n, m.place, [{', '.join(_steps(end) for end in range(4))}]
    from ways w join marked m on m.conv_id is not distinct from w.conv_id and m.place = w.place + 1
),
best as (select conv_id, list_min([{_COMPLETE}]) as way from ways where place = n)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(way.c, 0) as cost,
    coalesce(way.a, '') as audit, sha256(coalesce(array_to_string(way.l, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id"""

TRIE = rf"""
with given as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as depth
    from conversations where conv_id is not null
),
convs as (
    select conv_id, conv_id - conv_id % 20 as first, {crc32("cast(conv_id as varchar)")} % 4 as h
    from (select distinct conv_id from given)
),
taken as (
    select c.conv_id, g.depth, g.role, g.text from convs c join given g on g.conv_id = c.first and g.depth <= h
),
rebuilt as (
    select * from taken
    union all
    select conv_id, depth - h + (select count(*) from taken t where t.conv_id = c.conv_id), role, text
    from given join convs c using (conv_id) where depth > h
),
turns as (
    select conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
        list({{'role': role, 'text': text}}) over (
            partition by conv_id order by depth rows between unbounded preceding and current row) as path
    from rebuilt
    union all
    select conv_id, 0, 0, cast([] as struct(role varchar, text varchar)[]) from convs
),
members as (select *, depth = max(depth) over (partition by conv_id) as ends from turns),
nodes as (
    select path, depth, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words,
        sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
    from members group by path, depth
),
below as (select path[1:depth - 1] as path, count(*) as n_children from nodes where depth > 0 group by all),
within as (
    select path[1:d] as path, sum((n_convs - 1) * words) as saved_tokens, count(*) filter (n_children is null) as n_leaves
    from (select *, unnest(range(0, depth + 1)) as d from nodes left join below using (path)) group by 1
)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs,
    coalesce(n_children, 0) as n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
from nodes n left join below using (path) join within using (path)
left join nodes p on n.depth > 0 and p.path = n.path[1:n.depth - 1]"""
