"""SQL of the signature queries: brute force over hexadecimal lanes, for tables of test size."""

from __future__ import annotations

_WORD = "('0x' || h[{a}+6:{a}+7] || h[{a}+4:{a}+5] || h[{a}+2:{a}+3] || h[{a}:{a}+1])::bigint"
_OK = f"l >= 24 and l = 16 + 8 * {_WORD.format(a=1)} and {_WORD.format(a=25)} > 0"


def usable(source: str, columns: str) -> str:
    """Usable signatures: columns, h (hexadecimal), n lanes, seed."""
    return f"select *, (l - 16) // 8 as n, h[9:16] as seed from (select distinct {columns}, hex(kmer_signature) as h, octet_length(kmer_signature) as l from {source}) where {_OK}"


def equal(a: str, b: str) -> str:
    """The number of equal lanes of two rows."""
    return f"list_sum(list_transform(range({a}.n), lambda i: ({a}.h[33+16*i:48+16*i] = {b}.h[33+16*i:48+16*i])::int))"


_REC = f"rec as ({usable('(select * from segment_kmers where sequence_id is not null and segment_name is not null)', 'segment_name, sequence_id')})"
_PAIR = "a.segment_name = b.segment_name and a.n = b.n and a.seed = b.seed"

#: Numbers of equal lanes of the pairs of records that have any, by a join on single lanes.
_EQ = f"""{_REC}, lane as (select segment_name, sequence_id, h, n, seed, i, h[33+16*i:48+16*i] as v from rec cross join unnest(range(n)) as u(i)),
eq as (select a.segment_name, a.sequence_id as x, b.sequence_id as y, a.h as hx, b.h as hy, a.n, count(*) as m from lane a join lane b on {_PAIR} and a.i = b.i and a.v = b.v and a.sequence_id < b.sequence_id group by all)"""

P2 = f"""with {_EQ}, e as (select segment_name, x, y, m / n as s from eq where m >= 0.75 * n),
d as (select segment_name, x, y, s from e union all select segment_name, y, x, s from e),
t as (select * from d qualify row_number() over (partition by segment_name, x order by s desc, y) <= 5)
select distinct segment_name, least(x, y) as sequence_a, greatest(x, y) as sequence_b from t"""

P3 = f"with {_EQ} select segment_name, x as sequence_a, y as sequence_b from eq where m >= 0.85 * n"

_PLAIN = "lower(regexp_replace(sequence_id, '\\s+', '', 'g'))"
P6 = f"""with old as ({usable('(select * from segment_kmers where segment_name is not null)', 'segment_name')}), new as ({usable('(select * from incoming_segments where segment_name is not null)', 'submission_id, segment_name')}),
ids as (select submission_id, segment_name, {_PLAIN} as p from incoming_segments where sequence_id is not null and segment_name is not null),
known as (select distinct segment_name, {_PLAIN} as p from segment_kmers where sequence_id is not null and segment_name is not null)
select submission_id from ids where exists (select 1 from known k where k.segment_name = ids.segment_name and k.p = ids.p) or exists (select 1 from ids i where i.segment_name = ids.segment_name and i.p = ids.p and i.submission_id < ids.submission_id)
union select a.submission_id from new a join old b on {_PAIR} where {equal('a', 'b')} >= 0.85 * a.n
union select a.submission_id from new a join new b on {_PAIR} and b.submission_id < a.submission_id where {equal('a', 'b')} >= 0.85 * a.n"""

_PROV = f"rec as ({usable('''(select * from segment_kmers where cluster_version = 'provisional' and sequence_id is not null and segment_name is not null)''', 'segment_name, sequence_id')})"
P7 = f"""with recursive {_PROV}, link as (select a.segment_name as g, a.sequence_id as x, b.sequence_id as y from rec a join rec b on {_PAIR} where {equal('a', 'b')} >= 0.25 * a.n),
reach as (select segment_name as g, sequence_id as x, sequence_id as y from rec union select r.g, r.x, l.y from reach r join link l on l.g = r.g and l.x = r.y),
comp as (select g, x, min(y) as c, count(*) as k from reach group by 1, 2),
d as (select segment_name as g, sequence_id as x, min(distance_to_centroid) as d from segment_kmers where cluster_version = 'provisional' and distance_to_centroid between 0 and 1 and not isnan(distance_to_centroid) group by 1, 2),
top as (select comp.g, c, arg_min(comp.x, {{'d': d.d, 'x': comp.x}}) as typical_id from comp join d on d.g = comp.g and d.x = comp.x where k >= 3 group by 1, 2)
select comp.g as segment_name, comp.x as sequence_id, typical_id from comp left join top using (g, c) where k >= 3"""

_TOP = P7.rsplit("\nselect", 1)[0]
P7_CLUSTERS = f"""{_TOP}, cell as (select comp.g, comp.c, comp.x, rec.n, comp.k, i, rec.h[33+16*i:48+16*i] as v from comp join rec on rec.segment_name = comp.g and rec.sequence_id = comp.x cross join unnest(range(rec.n)) as u(i) where k >= 3),
cnt as (select *, count(*) over (partition by g, c, i, v) as m from cell), fit as (select g, c, x, any_value(k) as size, round(sum(m)::double / (any_value(n) * any_value(k)), 9) as fit from cnt group by 1, 2, 3),
best as (select * from fit qualify row_number() over (partition by g, c order by fit desc, x) <= 3)
select best.g as segment_name, typical_id, any_value(size) as size, string_agg(x, ',' order by fit desc, x) as nearest from best left join top using (g, c) group by best.g, best.c, typical_id"""

P2_NEIGHBOURS = P2.rsplit("\nselect", 1)[0] + "\nselect segment_name, x as sequence_id, y as neighbour, s as agreement from t"

P3_GROUPS = f"""with recursive {_EQ}, near as (select * from eq where m >= 0.85 * n),
link as (select segment_name as g, x, y, hx, hy from near union all select segment_name, y, x, hy, hx from near union all select segment_name, sequence_id, sequence_id, h, h from rec),
reach as (select segment_name as g, sequence_id as x, sequence_id as y from rec union select r.g, r.x, l.y from reach r join link l on l.g = r.g and l.x = r.y),
comp as (select g, x, min(y) as group_id from reach group by 1, 2), cl as (select segment_name as g, h, min(sequence_id) as class_id, count(*) as copies from rec group by 1, 2),
ln as (select g, x, count(distinct hy) filter (hx <> hy) as links from link group by 1, 2)
select rec.segment_name, rec.sequence_id, class_id, copies, links, group_id from rec join comp on comp.g = rec.segment_name and comp.x = rec.sequence_id join cl on cl.g = rec.segment_name and cl.h = rec.h join ln on ln.g = rec.segment_name and ln.x = rec.sequence_id"""

_P6_WITH, _P6_REST = P6.rsplit("\nselect submission_id from ids", 1)
P6_CHECKED = f"""{_P6_WITH}, k as (select submission_id from ids{_P6_REST.split(chr(10))[0]}),
s as ({chr(10).join(_P6_REST.split(chr(10))[1:]).removeprefix('union ')})
select submission_id, submission_id in (from k) as known_id, submission_id in (from s) as near_duplicate,
coalesce({_PLAIN} in (select {_PLAIN} from sequences where sequence_id is not null), false) as known_isolate from incoming_segments"""

SIGNATURE_SQL = {"p2_neighbours": P2_NEIGHBOURS, "p3_groups": P3_GROUPS, "p6_checked": P6_CHECKED, "p7_clusters": P7_CLUSTERS, "p2_found": P2, "p3_found": P3, "p6_found": P6, "p7_found": P7}
