"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = f"""
with d as (select doc_id, sha256({_LOWER}) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from d join g using (text_sha256)
"""

# Per kind: the texts between the matches and the matches give every start.
_SPANS = """
{kind} as (
  select doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
      's': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
      'n': {no}, 'l': length(m[i]), 'g': length(g[i])}}), lambda x: x.g >= {least}) as spans
  from (select doc_id, string_split_regex(text, '{pat}') as p, regexp_extract_all(text, '{pat}', 0) as m,
               regexp_extract_all(text, '{pat}', {group}) as g
        from (select doc_id, coalesce(text, '') as text from documents))
)"""


def _op7() -> str:
    from tidewater.llm.secrets import BASE_RULES, RULES
    parts = [_SPANS.format(kind=f"k_{r.kind}", no=n, least=r.least, group=r.group, pat=r.pattern.replace("'", "''"))
             for n, r in enumerate(RULES)]
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
    text = f"list_transform({{0}}, lambda x: {kinds}[x.n + 1] || ':' || (x.s::bigint)::varchar || ':' || ((x.s + x.l)::bigint)::varchar)"
    joined = " join ".join([f"k_{RULES[0].kind}", *[f"k_{r.kind} using (doc_id)" for r in RULES[1:]]])
    every = "list_sort(list_concat(" + ", ".join(f"k_{r.kind}.spans" for r in RULES) + "))"
    counts = ", ".join(f"len(k_{r.kind}.spans)::bigint as n_{r.kind}" for r in BASE_RULES)
    base = f"list_filter(a, lambda x: x.n < {len(BASE_RULES)})"
    return f"""
with {','.join(parts)},
a as (select doc_id, {every} as a, {counts} from {joined})
select doc_id, {', '.join(f'n_{r.kind}' for r in BASE_RULES)},
       sha256(coalesce(array_to_string({text.format(base)}, ','), '')) as base_sha256,
       coalesce(array_to_string({text.format('a')}, ','), '') as spans
from a
"""


# SHA-1 to base32: eight groups of 20 bits, each four signs of five.
OP1 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || h[5 * (i // 4) + 1:5 * (i // 4) + 5])::bigint >> (15 - 5 * (i % 4))) & 31)]), '')
    as payload_digest from p
), g as (select payload_digest, max(page_id) as answer from d group by 1)
select page_id, payload_bytes, payload_digest,
       case when page_id = answer then 'response' else 'revisit' end as record_type,
       case when page_id <> answer then answer end as refers_to
from d join g using (payload_digest)
"""

# A word, as RE2 reads it.
_WORD = r"[^\x20\x09-\x0D]+"

OP2 = f"""
with recursive w as (select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
l as (select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as l from w),
s as (select doc_id, len(l) as n, unnest(l) as g from l),
links as (select a.doc_id as x, b.doc_id as y from s a join s b on a.g = b.g and a.doc_id < b.doc_id
          group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id as r from documents union select reach.doc_id, e.y from reach join edges e on reach.r = e.x)
select doc_id, len(l)::bigint as n_shingles, component_id
from l join (select doc_id, min(r) as component_id from reach group by 1) using (doc_id)
"""

OP4 = f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
v as (select doc_id, unnest(range(1, len(w) - 33)) as i, w from d),
h as (select doc_id, i, count(*) over (partition by array_to_string(w[i:i + 34], ' ')) > 1 as again from v),
p as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
c as (select p.doc_id, p.i, word, coalesce(bool_or(again) over (partition by p.doc_id order by p.i
        rows between 34 preceding and current row), false) as gone
      from p left join h on p.doc_id = h.doc_id and p.i = h.i),
k as (select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from c group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join k using (doc_id)
"""

OP12 = """
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
w as (select *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
             min(doc_id) over (partition by t) as first from d),
m as (select part, r, doc_id,
        case when len(w) < 200 then 1 else 0 end
        + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
        + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 4 else 0 end
        + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
        + case when doc_id > first then 16 else 0 end as mask from w),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
c as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
      from m left join l using (doc_id) group by 1, 2),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
o as (select a.f || b.f || c.f || d.f || e.f as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits from f a, f b, f c, f d, f e
      where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s as (select filter_order, unnest(range(1, 6))::int as step, bits from o),
g as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::int as before from s),
x as (select part, filter_order, step, bit,
        coalesce(sum(n) filter (mask & (before | bit) = 0), 0)::bigint as kept,
        coalesce(sum(n) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as removed,
        coalesce(sum(n) filter (mask & before > 0 and mask & bit > 0), 0)::bigint as redundant,
        coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
        coalesce(sum(good) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as good_lost,
        coalesce(sum(toxic) filter (mask & before = 0 and mask & bit > 0), 0)::bigint as toxic_lost
      from c, g group by all)
select * exclude (bit), sum(removed) over (partition by part, bit)::bigint as shapley from x
"""

def _op13(centroids: int = 16, rounds: int = 3) -> str:
    """Rounds of assignment and floor means, one CTE each."""
    out = [f"""v as (select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as q
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x::double))) = 64)""",
           f"""m0 as (select (row_number() over (order by sha256('1:' || vec_id)) - 1)::int as cluster, q as c
  from v qualify cluster < {centroids})"""]
    for n in range(rounds + 1):
        out.append(f"""a{n} as (select r, arg_min(cluster, (d, cluster)) as cluster, min(d)::bigint as d from (
  select r, cluster, list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) as d from v, m{n}) group by r)""")
        if n < rounds:
            out.append(f"""s{n} as (select cluster, i, sum(x)::bigint as s, count(*) as n from (
  select cluster, unnest(q) as x, unnest(range(1, 65)) as i from v join a{n} using (r)) group by 1, 2)""")
            out.append(f"""m{n + 1} as (select cluster, coalesce(f.c, m{n}.c) as c from m{n} left join (
  select cluster, list((s - ((s % n) + n) % n) // n order by i) as c from s{n} group by 1) f using (cluster))""")
    return "with " + ",\n".join(out) + f"""
select vec_id, cluster, d as distance, (sum(d) over (partition by cluster))::bigint as cluster_inertia,
       (sum(d) over ())::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256
from v join a{rounds} using (r) join m{rounds} using (cluster)"""


ORACLES: dict[str, str] = {"op1_warc_revisits": OP1, "op2_jaccard_join": OP2, "op4_substring_dedup": OP4, "op8_exact_dedup": OP8, "op7_secret_scan": _op7(), "op12_filter_audit": OP12,
                           "op13_centroid_clusters": _op13()}
