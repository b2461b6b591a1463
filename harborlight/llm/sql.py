"""DuckDB SQL of the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

from harborlight.llm import url_filter

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_SPACE = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATION = f"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({_FOLD}, {_ALNUM}) as w from documents),
b as (select row_number() over () as item, coalesce(cast(item_id as varchar), '') as id, regexp_extract_all({_FOLD}, {_ALNUM}) as w from benchmark),
qi as (select item, id, w, least(len(w), 10) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0),
q as (select item, id, n, i, array_to_string(w[i:i + n - 1], ' ') as k from qi),
pi as (select d.r, d.w, s.n, unnest(range(1, len(d.w) - s.n + 2)) as p from d, (select distinct n from q) s where len(d.w) >= s.n),
h as (select pi.r, q.item, q.id, q.n, q.i, pi.p from pi join q on q.n = pi.n and q.k = array_to_string(pi.w[pi.p:pi.p + pi.n - 1], ' ')),
c as (select r, count(distinct x) as n_hit from (select r, unnest(range(p, p + n)) as x from (select distinct r, p, n from h)) group by r),
m as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, id from h) group by r),
g as (select r, n + count(*) - 1 as size, min(p) - 1 as place from (select *, p - row_number() over (partition by r, item, p - i order by p) as island from h) group by r, item, n, p - i, island),
l as (select r, max(size) as size, arg_min(place, struct_pack(a := -size, b := place)) as place from g group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated, cast(coalesce(l.size, 0) as bigint) as longest_match, cast(coalesce(l.place, -1) as bigint) as longest_at
from d left join c using (r) left join m using (r) left join l using (r)"""

MIXING = f"""
with d as (select doc_id, source, coalesce(text, '') as text, cast(coalesce(len(regexp_extract_all(text, {_SPACE})), 0) as bigint) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
r as (select *, row_number() over (order by source nulls last) - 1 as rank from s),
w as (select *, [5.0::double, 2.0::double, 1.0::double][cast(rank % 3 + 1 as int)] as weight, source_size * 3.0::double as most from r),
o as (select *, most / weight as ratio from w),
v as (select *, (cast(sum(source_size) over () as bigint) - coalesce(sum(most) over (order by ratio, rank rows between unbounded preceding and 1 preceding), 0.0)) / sum(weight) over (order by ratio, rank rows between current row and unbounded following) as level from o),
t as (select source, source_size, least(most, (select coalesce(arg_min(level, struct_pack(a := ratio, b := rank)) filter (where ratio >= level), max(level)) from v) * weight) as target from v),
p as (select d.*, t.source_size, t.target, case when t.source_size > 0 then least(t.target / t.source_size, 3.0::double) else 0.0 end as rate from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, size * (cast(floor(rate) as bigint) + case when cast('0x' || substr(md5('mix-1|' || coalesce(cast(doc_id as varchar), '') || '|' || md5(text)), 1, 13) as bigint) / 4503599627370496.0 < rate - floor(rate) then 1 else 0 end) as taken from p"""

SUBSTRING = f"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), {_SPACE}) as w from documents),
s as (select r, w, unnest(range(1, len(w) - 33)) as p from d where len(w) >= 35),
k as (select r, p, md5(array_to_string(w[p:p + 34], ' ')) as h from s),
g as (select r, p from k where h in (select h from k group by h having count(*) > 1)),
c as (select distinct r, unnest(range(p, p + 35)) as x from g),
u as (select r, unnest(w) as word, generate_subscripts(w, 1) as x from d where len(w) > 0),
t as (select u.r, string_agg(word, ' ' order by u.x) as kept, count(*) as n from u left join c on c.r = u.r and c.x = u.x where c.x is null group by u.r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(t.n, 0) as bigint) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join t using (r)"""

WARC = """
with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p),
g as (select *, first is not null and coalesce(page_id <> first, true) as again from f)
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to from g"""

JACCARD = f"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all({_FOLD}, {_SPACE}) as w from documents),
s0 as (select r, w, least(len(w), 4) as k, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as p from d where len(w) > 0),
s as (select distinct r, md5(array_to_string(w[p:p + k - 1], ' ')) as t from s0),
n as (select r, count(*) as n from s group by r),
pairs as (select a.r as u, b.r as v, count(*) as shared from s a join s b on a.t = b.t and a.r < b.r group by 1, 2),
links as (select u, v from pairs join n x on x.r = u join n y on y.r = v where 100 * shared >= 85 * (x.n + y.n - shared)),
edges as (select u, v from links union all select v, u from links),
reach(a, b) as (select u, v from edges union select reach.a, edges.v from reach join edges on edges.u = reach.b),
least_ as (select a as r, min(d.doc_id) as c from reach join d on d.r = reach.b group by a)
select doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, least(doc_id, least_.c) as component_id from d left join n using (r) left join least_ using (r)"""


def _url_sql() -> str:
    depth = url_filter.DEPTH
    rules = sorted(url_filter.RULES, key=lambda r: (len(r[0] + r[1]), r), reverse=True)
    fits = [(f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v) for h, p, v in rules]
    name = "case " + " ".join(f"when {f} then '{n}'" for f, n, _ in fits) + " end"
    verdict = "case " + " ".join(f"when {f} then '{v}'" for f, _, v in fits) + " end"
    segs = []
    for i in range(1, depth + 1):
        one = f"case when regexp_matches(parts[{i}], '[0-9]') or length(parts[{i}]) > {url_filter.LONG} then '*' else parts[{i}] end"
        segs.append((f"case when len(parts) > {depth} then '**' else {one} end" if i == depth else one) + f" as s{i}")
    levels = [f"s{i}" for i in range(1, depth + 1)]
    parts = [
        r"""u as (select page_id, coalesce(url, '') as url from pages)""",
        r"""h as (select page_id, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from u)""",
        f"""x as (select *, {name} as rule, {verdict} as v, list_filter(string_split(path, '/'), lambda s: s <> '') as parts from h)""",
        f"""y as (select *, {', '.join(segs)} from x)""",
        f"""q as (select host, {', '.join(levels)}, count(*) as n, count(v) as labels, count(*) filter (where v = 'block') as blocked from y group by all)""",
        "g as (select coalesce(sum(blocked) / nullif(sum(labels), 0), 0.0) as share from q)",
        "c0 as (select q.*, cast(share as double) as e0 from q, g)",
    ]
    done: list[str] = []
    for i in range(1, depth + 1):
        node, s, e = ["host", *done], f"s{i}", f"e{i - 1}"
        keys = ", ".join(node)
        same = lambda a, b, cols: " and ".join(f"{a}.{c} is not distinct from {b}.{c}" for c in cols)
        parts.append(f"k{i} as (select {keys}, {s}, {e}, sum(n) as n, sum(labels) as labels, sum(blocked) as blocked from c{i - 1} group by all)")
        vote = f"case when {s} = '*' then cast(blocked as double) when labels = 0 then 0.0::double when 2 * blocked > labels then 1.0::double when 2 * blocked = labels then 0.5::double else 0.0::double end"
        parts.append(f"p{i} as (select {keys}, count({s}) as kids, cast(sum(case when {s} = '*' then labels when labels > 0 then 1 else 0 end) as bigint) as voters, sum({vote}) as votes, sum(n) as p_n, sum(labels) as p_labels, sum(blocked) as p_blocked from k{i} group by all)")
        ll = lambda k, n: f"(case when {k} > 0 then {k} * ln({k} / {n}) else 0.0 end + case when {n} > {k} then ({n} - {k}) * ln(({n} - {k}) / {n}) else 0.0 end)"
        others = ll("(p_blocked - blocked)", "(p_labels - labels)")
        alike = f"(labels > 0 and kids > 1 and 2 * ({ll('blocked', 'labels')} + {others} - {ll('p_blocked', 'p_labels')}) <= {url_filter.RATIO})"
        rare = f"(labels = 0 and kids > {url_filter.FANOUT} and n < {url_filter.SHARE}::double * p_n)"
        parts.append(f"m{i} as (select {', '.join('k.' + c for c in node)}, k.{s}, case when k.{s} is null then null when {rare} or {alike} then '*' else k.{s} end as t{i}, case when kids > 1 then (votes + {url_filter.VOTES}::double * k.{e}) / (voters + {url_filter.VOTES}::double) else k.{e} end as e{i} from k{i} k join p{i} p on {same('k', 'p', node)})")
        parts.append(f"c{i} as (select a.*, b.t{i}, b.e{i} from c{i - 1} a join m{i} b on {same('a', 'b', [*node, s])})")
        done.append(f"t{i}")
    keys = ["host", *done]
    parts.append(f"f as (select {', '.join(keys)}, (sum(blocked) + {url_filter.PRIOR}::double * max(e{depth})) / (sum(labels) + {url_filter.PRIOR}::double) as purity from c{depth} group by all)")
    shown = " || ".join(f"coalesce('/' || a.t{i}, '')" for i in range(1, depth + 1))
    parts.append(f"j as (select {', '.join('a.' + c for c in ('host', *levels))}, {shown} as template, f.purity from c{depth} a join f on {' and '.join(f'a.{c} is not distinct from f.{c}' for c in keys)})")
    last = f"coalesce(y.v, case when j.purity >= {url_filter.REJECT} then 'block' else 'allow' end)"
    return f"with {', '.join(parts)} select y.page_id, y.host, y.path, y.rule, {last} as verdict, j.template, j.purity from y left join j on {' and '.join(f'y.{c} is not distinct from j.{c}' for c in ('host', *levels))}"


FILL_IN_MIDDLE = """
with t as (select doc_id, coalesce(text, '') as text, cast(length(coalesce(text, '')) as bigint) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
h as (select *, cast('0x' || substr(h, 1, 8) as bigint) % (n + 1) as a, cast('0x' || substr(h, 9, 8) as bigint) % (n + 1) as b, cast('0x' || substr(h, 17, 8) as bigint) % 100 as c, cast('0x' || substr(h, 25, 8) as bigint) % 100 as d from t),
f as (select doc_id, text, n, least(a, b) as p, greatest(a, b) - least(a, b) as m, case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or c >= 90 then 'plain' when d < 20 then 'spm' else 'psm' end as form from h),
s as (select *, substr(text, 1, p) as pre, substr(text, p + 1, m) as mid, substr(text, p + m + 1) as suf from f)
select doc_id, n, form, case when form <> 'plain' then p end as prefix_chars, case when form <> 'plain' then m end as middle_chars,
  sha256(case form when 'plain' then text when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else '<P>' || pre || '<S>' || suf || '<M>' || mid end) as output_sha256, sha256(text) as restored_sha256 from s"""


def centroid_sql(rounds: int = 10, clusters: int = 8) -> str:
    """Rounds of exact assignments and floors of means, written out one after the other."""
    steps = [
        """with k as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q from embeddings
where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64)""",
        f"c0 as (select row_number() over (order by sha256('3:' || coalesce(cast(vec_id as varchar), '')), q) - 1 as c, q as z from k qualify c < {clusters})",
    ]
    for i in range(rounds + 1):
        steps.append(f"p{i} as materialized (select r, vec_id, q, c, z, list_sum(list_transform(range(1, 65), lambda j: (q[j] - z[j]) * (q[j] - z[j]))) as d from k, c{i})")
        steps.append(f"a{i} as materialized (select r, vec_id, q, c, cast(d as bigint) as d from p{i} qualify row_number() over (partition by r order by d, c) = 1)")
        if i < rounds:
            steps.append(f"u{i} as (select c, j, sum(x) as s, count(*) as n from (select c, unnest(q) as x, generate_subscripts(q, 1) as j from a{i}) group by c, j)")
            steps.append(f"n{i} as (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) as z from u{i} group by c)")
            steps.append(f"c{i + 1} as materialized (select c{i}.c, coalesce(n{i}.z, c{i}.z) as z from c{i} left join n{i} using (c))")
    last = f"""select vec_id, cast(c as integer) as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(z, ',')) as centroid_sha256 from a{rounds} join (select c, z from c{rounds}) using (c)"""
    return ",\n".join(steps) + "\n" + last


ORACLES = {
    "op3_decontamination": DECONTAMINATION,
    "op4_mixing": MIXING,
    "op5_substring_dedup": SUBSTRING,
    "op6_warc": WARC,
    "op9_jaccard_join": JACCARD,
    "op10_url_filter": _url_sql(),
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_centroid_clustering": centroid_sql(),
}
