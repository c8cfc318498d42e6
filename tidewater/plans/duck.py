"""DuckDB texts of the derived views and shared expressions.

The oracle of each query is plain SQL over the driver's tables; the views
of ``tidewater.sources.tables`` are repeated here as CTEs in DuckDB's
dialect.
"""

from __future__ import annotations

from tidewater.functions.logparse import DATE_PATTERN, LOG_PATTERN

P = LOG_PATTERN


def log_line(ts: str = "ts", dense: bool = False) -> str:
    first = "when event_id % 2000 < 400 then '500' " if dense else ""
    return f"""case when event_id % 97 = 0 then 'garbage line ' || cast(event_id as varchar) else
    (case when event_id % 61 = 0 then ''
          else '10.0.' || cast(user_id // 256 as varchar) || '.' || cast(user_id % 256 as varchar) end)
    || ' - u' || cast(user_id as varchar)
    || ' [' || strftime({ts},'%d/%b/%Y:%H:%M:%S') || ' +0000] "'
    || (case when event_id % 53 = 0 then '-'
             when event_type in ('click','error') then 'GET /item/' || cast(event_id % 20 as varchar) || ' HTTP/1.1'
             when event_type = 'view' then 'GET /page/' || cast(event_id % 50 as varchar) || ' HTTP/1.1'
             when event_type = 'purchase' then 'POST /cart HTTP/1.1'
             else 'POST /signup HTTP/1.1' end)
    || '" '
    || (case {first}when event_type = 'error' then '500' when event_type = 'signup' then '302'
             when event_type = 'click' and event_id % 10 = 0 then '404' else '200' end)
    || ' ' || cast(cast(floor(value*100) as bigint) as varchar)
    || ' "-" "agent-' || cast(event_id % 7 as varchar) || '"' end"""


WEBLOG = f"weblog as (select event_id, ts, {log_line()} as line from events)"

WEBLOG_DENSE = (
    "weblog as (select event_id, ts, "
    + log_line("ts", dense=True)
    + " as line from (select event_id, timestamp '2024-01-01 00:00:00' + to_seconds(event_id) as ts,"
    " user_id, event_type, value from events))"
)

POSTS = ("posts as (select doc_id as post_id, timestamp '2024-01-01 00:00:00' + to_seconds(doc_id*37) as ts, "
         "text || ' #' || lang || ' #' || source as text from documents)")

POINTS = ("points as (select event_id as id, round((value-5e1)/5e1,6) as x, "
          "round(-0.995e0*((value-5e1)/5e1) + (event_id % 7 - 3)/1e2,6) as y from events)")

BLOBS = """blobs as (select event_id as id, cast(event_id % 5 as int) as label,
 (case event_id % 5 when 0 then 16e4 when 1 then 54e3 when 2 then 113e3 when 3 then 192e3 else 56e3 end)
   + ((event_id * 7919) % 1001 - 500) * 5e1 as income,
 (case event_id % 5 when 0 then 2e1 when 1 then 5e1 when 2 then 64e0 when 3 then 59e0 else 34e0 end)
   + (event_id * 31) % 9 - 4 as age from events)"""

ORDER_ITEMS = ("order_items as (select l_orderkey, list_sort(list(cast(l_quantity as int))) as q "
               "from lineitem group by 1)")

NATION_PARTIAL = "nation_partial as (select * from nation where n_regionkey <> 2)"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def matched(line: str = "line") -> str:
    return f"regexp_matches({line}, '{P}')"


def grp(i: int, line: str = "line") -> str:
    return f"regexp_extract({line}, '{P}', {i})"


def tok(s: str) -> str:
    """JVM ``split(' ')``: trailing empties dropped, '' -> [''], '  ' -> []."""
    return (f"(case when length({s}) > 0 and rtrim({s}, ' ') = '' then []::varchar[] "
            f"else string_split(rtrim({s}, ' '), ' ') end)")


def request_or_unit(line: str = "line") -> str:
    return f"(case when {matched(line)} then {grp(5, line)} else '()' end)"


def url_strict(req: str) -> str:
    return f"(case when len({tok(req)}) = 3 then {tok(req)}[2] else '[error]' end)"


def url_lenient(req: str) -> str:
    return f"coalesce({tok(req)}[2], '[error]')"


def log_time(date_field: str) -> str:
    return (f"try_strptime(regexp_extract({date_field}, '{DATE_PATTERN}', 1), "
            f"'%d/%b/%Y:%H:%M:%S')")


def status_class(status_text: str) -> str:
    code = f"coalesce(try_cast({status_text} as integer), 0)"
    return (f"(case when {code} >= 200 and {code} < 300 then 'Success' "
            f"when {code} >= 500 and {code} < 600 then 'Failure' else 'Other' end)")


def lines(text: str) -> str:
    body = f"regexp_replace({text}, '(\\r\\n|\\r|\\n)\\z', '')"
    return (f"(case when {text} = '' then []::varchar[] "
            f"else regexp_split_to_array({body}, '\\r\\n|\\r|\\n') end)")


def us(ts: str) -> str:
    return f"epoch_us({ts})"


def sliding(src: str, ts: str, keys: list[str], length_s: int, slide_s: int) -> str:
    """SQL of window_start, window_end, *keys, n over ``src``."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    sl, ln = slide_s * 1_000_000, length_s * 1_000_000
    r = length_s // slide_s
    return f"""(select make_timestamp(w) as window_start, make_timestamp(w + {ln}) as window_end,
       {kc}cast(sum(c) as bigint) as n
  from (select {kc}b - kk * {sl} as w, c
          from (select {kc}{us(ts)} - ({us(ts)} % {sl}) as b, count(*) as c
                  from {src} where {ts} is not null group by all) bb,
               range({r}) rr(kk)) ww
 group by all)"""


def top_change_points(src: str, key: str, length_s: int, k: int) -> str:
    """CTEs and SQL: the ``k`` largest counts of the last ``length_s`` seconds
    at every second where a count changes."""
    return f"""
, b as (select {key}, epoch_us(ts) - epoch_us(ts) % 1000000 as b, count(*) as c from {src} group by all),
d as (select {key}, b + 1000000 as t, c as d from b
      union all select {key}, b + 1000000 + {length_s * 1_000_000}, -c from b),
s as (select {key}, t, sum(d) as d from d group by all having sum(d) <> 0),
r as (select {key}, t, sum(d) over w as n, lead(t) over (partition by {key} order by t) as nxt
      from s window w as (partition by {key} order by t rows between unbounded preceding and current row)),
x as (select q.t, r.{key}, r.n from (select distinct t from s) q join r on q.t >= r.t and q.t < r.nxt where r.n > 0)
select make_timestamp(t) as window_end, {key}, cast(n as bigint) as n, rank from (
  select *, cast(row_number() over (partition by t order by n desc, {key} asc nulls first) as integer) as rank from x)
where rank <= {k}"""


def parts(src: str, order: str, n: int) -> str:
    """CTE: ``src`` with the part number that staging gives each row."""
    return f"""parts as (select *, cast(({order} - (select min({order}) from {src}))
   // ((select max({order}) - min({order}) from {src}) // {n} + 1) as bigint) as batch_id from {src})"""
