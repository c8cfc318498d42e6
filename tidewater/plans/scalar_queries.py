"""Scalar, array, map, lookup and user-function queries.

The reference's worksheet examples re-aimed at columns of the driver's
tables (lineitem, customer, nation, weblog, posts).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import udfs
from tidewater.functions.logparse import LOG_PATTERN
from tidewater.operators import lookups as L
from tidewater.plans import duck as D
from tidewater.plans.registry import query
from tidewater.sources.tables import nation_partial, order_items, posts, table, weblog

# The worksheet's match words and the default of a lookup.
MATCH_WORDS = {1: "One", 2: "Two", 3: "Three"}
MATCH_DEFAULT = "Something else"
LOOKUP_DEFAULT = "Unknown"
# Greedy capture of the last number preceded by a space.
NUMBER_PATTERN = r"^.* ([0-9]+).*\z"


def _strs(a):
    return F.array_join(a.cast("array<string>"), ",")


# -- FLT4 ----------------------------------------------------------------------------
@query("predicates", """
select l_orderkey, l_linenumber, l_quantity > 25 as is_greater, l_discount < 0.05 as is_lesser,
       l_quantity > 25 and l_discount < 0.05 as both_hold, l_returnflag = 'R' as is_r
from lineitem""")
def q_predicates(spark, sf):
    li = table(spark, sf, "lineitem")
    g, l_ = F.col("l_quantity") > 25, F.col("l_discount") < 0.05
    return li.select("l_orderkey", "l_linenumber", g.alias("is_greater"), l_.alias("is_lesser"),
                     (g & l_).alias("both_hold"), (F.col("l_returnflag") == "R").alias("is_r"))


# -- FLT5: keep the quantities divisible by three, and the rest --------------------------
@query("mod_filter", """
select 'divisible' as kind, l_returnflag, count(*) as n from lineitem
 where cast(l_quantity as integer) % 3 = 0 group by all
union all
select 'not divisible', l_returnflag, count(*) from lineitem
 where cast(l_quantity as integer) % 3 <> 0 group by all""")
def q_mod_filter(spark, sf):
    li = table(spark, sf, "lineitem")
    div = F.col("l_quantity").cast("int") % 3 == 0
    kind = F.when(div, "divisible").when(~div, "not divisible")
    return (li.groupBy(kind.alias("kind"), "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("kind").isNotNull()))


# -- FLT6 --------------------------------------------------------------------------------
@query("case_match", f"""
select l_orderkey, l_linenumber,
       case l_linenumber when 1 then '{MATCH_WORDS[1]}' when 2 then '{MATCH_WORDS[2]}'
                         when 3 then '{MATCH_WORDS[3]}' else '{MATCH_DEFAULT}' end as word
from lineitem""")
def q_case_match(spark, sf):
    ln = F.col("l_linenumber")
    e = None
    for k, v in MATCH_WORDS.items():
        e = F.when(ln == k, F.lit(v)) if e is None else e.when(ln == k, F.lit(v))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                               e.otherwise(F.lit(MATCH_DEFAULT)).alias("word"))


# -- SCL10 / SCL14 ---------------------------------------------------------------------------
@query("str_concat", """
select c_custkey, c_name || ', good day.' as greeting,
       'Joined up: ' || cast(c_custkey as varchar) || cast(c_nationkey as varchar) || c_mktsegment as mess
from customer""")
def q_str_concat(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.concat("c_name", F.lit(", good day.")).alias("greeting"),
                    F.concat(F.lit("Joined up: "), F.col("c_custkey").cast("string"),
                             F.col("c_nationkey").cast("string"), "c_mktsegment").alias("mess"))


@query("str_case", "select c_custkey, upper(c_name) as upper_name, lower(c_name) as lower_name from customer")
def q_str_case(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.upper("c_name").alias("upper_name"), F.lower("c_name").alias("lower_name"))


# -- SCL11 --------------------------------------------------------------------------------------
@query("str_format", """
select c_custkey, printf('%.3f', c_acctbal) as balance, printf('%05d', c_custkey) as padded
from customer""")
def q_str_format(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.format_string("%.3f", "c_acctbal").alias("balance"),
                    F.format_string("%05d", "c_custkey").alias("padded"))


# -- SCL12 ----------------------------------------------------------------------------------------
@query("regex_int", D.with_(D.WEBLOG) + f"""
select event_id, try_cast(regexp_extract(line, '{NUMBER_PATTERN}', 1) as integer) as number from weblog""")
def q_regex_int(spark, sf):
    wl = weblog(spark, sf)
    return wl.select("event_id", F.regexp_extract("line", NUMBER_PATTERN, 1).try_cast("int").alias("number"))


# -- SCL13 --------------------------------------------------------------------------------------------
@query("arith", """
select l_orderkey, l_linenumber, q, q * q as sq, q * q * q as cube, q // 2 as half,
       (q * 2) * (q * 2) as twice_sq
from (select l_orderkey, l_linenumber, cast(l_quantity as bigint) as q from lineitem)""")
def q_arith(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                             F.col("l_quantity").cast("bigint").alias("q"))
    q = F.col("q")
    y = q * 2
    return li.select("l_orderkey", "l_linenumber", "q", (q * q).alias("sq"), (q * q * q).alias("cube"),
                     F.expr("q div 2").alias("half"), (y * y).alias("twice_sq"))


# -- SCL15 ------------------------------------------------------------------------------------------------
@query("array_ops", D.with_(D.ORDER_ITEMS) + """
select l_orderkey,
       array_to_string(list_concat(q, list_reverse(q)), ',') as concatenated,
       array_to_string(list_reverse(q), ',') as reversed,
       array_to_string(list_sort(list_reverse(q)), ',') as sorted,
       array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as distinct_values
from (select *, list_concat(list_reverse(q), q) as l from order_items)""")
def q_array_ops(spark, sf):
    oi = order_items(spark, sf)
    q = F.col("q")
    return oi.select("l_orderkey",
                     _strs(F.concat(q, F.reverse(q))).alias("concatenated"),
                     _strs(F.reverse(q)).alias("reversed"),
                     _strs(F.array_sort(F.reverse(q))).alias("sorted"),
                     _strs(F.array_distinct(F.concat(F.reverse(q), q))).alias("distinct_values"))


# -- SCL16 -------------------------------------------------------------------------------------------------
@query("array_aggs", D.with_(D.ORDER_ITEMS) + """
select l_orderkey, list_max(q) as max_q, cast(list_sum(q) as bigint) as sum_q,
       list_contains(q, 3) as has_three, cast(len(q) as integer) as n
from order_items""")
def q_array_aggs(spark, sf):
    oi = order_items(spark, sf)
    return oi.select("l_orderkey", F.array_max("q").alias("max_q"),
                     F.aggregate("q", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_q"),
                     F.array_contains("q", 3).alias("has_three"), F.size("q").alias("n"))


# -- SCL17 ---------------------------------------------------------------------------------------------------
@query("array_hof", D.with_(D.ORDER_ITEMS) + """
select c_custkey as id, array_to_string(list_transform(string_split(c_name, '#'), lambda x: reverse(x)), ',') as mapped,
       null::varchar as no_fives, null::varchar as no_threes from customer
union all
select l_orderkey, null, array_to_string(list_filter(q, lambda x: x <> 5), ','),
       array_to_string(list_filter(q, lambda x: x <> 3), ',') from order_items""")
def q_array_hof(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.array_join(F.transform(F.split("c_name", "#"), lambda x: F.reverse(x)), ",").alias("mapped"),
        F.lit(None).cast("string").alias("no_fives"), F.lit(None).cast("string").alias("no_threes"))
    o = order_items(spark, sf).select(
        F.col("l_orderkey").alias("id"), F.lit(None).cast("string").alias("mapped"),
        _strs(F.filter("q", lambda x: x != 5)).alias("no_fives"),
        _strs(F.filter("q", lambda x: x != 3)).alias("no_threes"))
    return c.unionByName(o)


# -- SCL18 ---------------------------------------------------------------------------------------------------
@query("array_access", D.with_(D.ORDER_ITEMS) + """
select l_orderkey, q[2] as second, q[1] as head, array_to_string(q[2:], ',') as tail from order_items""")
def q_array_access(spark, sf):
    oi = order_items(spark, sf)
    return oi.select("l_orderkey", F.get("q", 1).alias("second"), F.get("q", 0).alias("head"),
                     _strs(F.slice("q", 2, F.size("q") - 1)).alias("tail"))


# -- SCL19 ----------------------------------------------------------------------------------------------------
@query("struct_fields", """
select l_orderkey, l_linenumber, l_returnflag as first, l_linestatus as second,
       l_returnflag || l_linestatus as pair from lineitem""")
def q_struct_fields(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("l_returnflag").alias("_1"), F.col("l_linestatus").alias("_2")).alias("t"))
    return li.select("l_orderkey", "l_linenumber", F.col("t._1").alias("first"), F.col("t._2").alias("second"),
                     F.concat("t._1", "t._2").alias("pair"))


# -- SCL20 ------------------------------------------------------------------------------------------------------
@query("map_ops", """
select n_regionkey, cast(count(*) as integer) as size,
       coalesce(max(case when n_name = 'NATION_' || cast(n_regionkey + 5 as varchar) then n_nationkey end), -1) as found,
       coalesce(max(case when n_name = 'NATION_99' then n_nationkey end), -1) as missing,
       bool_or(n_name = 'NATION_0') as has_nation_0
from nation group by n_regionkey""")
def q_map_ops(spark, sf):
    n = table(spark, sf, "nation")
    m = n.groupBy("n_regionkey").agg(
        F.map_from_entries(F.collect_list(F.struct("n_name", "n_nationkey"))).alias("m"))
    probe = F.concat(F.lit("NATION_"), (F.col("n_regionkey") + 5).cast("string"))
    return m.select("n_regionkey", F.size("m").alias("size"),
                    F.coalesce(F.try_element_at("m", probe), F.lit(-1)).alias("found"),
                    F.coalesce(F.try_element_at("m", F.lit("NATION_99")), F.lit(-1)).alias("missing"),
                    F.map_contains_key("m", "NATION_0").alias("has_nation_0"))


# -- JON1 / JON2 ----------------------------------------------------------------------------------------------------
@query("lookup_default", D.with_(D.NATION_PARTIAL) + f"""
select c_custkey, coalesce(n_name, '{LOOKUP_DEFAULT}') as nation
from customer left join nation_partial on c_nationkey = n_nationkey""")
def q_lookup_default(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    out = L.lookup_with_default(c, nation_partial(spark, sf), "c_nationkey", "n_nationkey", "n_name",
                                LOOKUP_DEFAULT, out="nation")
    return out.select("c_custkey", "nation")


@query("lookup_present", D.with_(D.NATION_PARTIAL) + """
select c_custkey, c_nationkey from customer where c_nationkey in (select n_nationkey from nation_partial)""")
def q_lookup_present(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return L.key_present(c, nation_partial(spark, sf), "c_nationkey", "n_nationkey", True)


@query("lookup_absent", D.with_(D.NATION_PARTIAL) + """
select c_custkey, c_nationkey from customer
where not exists (select 1 from nation_partial where n_nationkey = c_nationkey)""")
def q_lookup_absent(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return L.key_present(c, nation_partial(spark, sf), "c_nationkey", "n_nationkey", False)


# -- UDF1 / UDF2 / UDF3 ----------------------------------------------------------------------------------------------
@query("udf_map", D.with_(D.WEBLOG) + f"""
select event_id, {D.status_class(f"case when {D.matched()} then {D.grp(6)} else '[error]' end")} as status_class
from weblog""")
def q_udf_map(spark, sf):
    wl = weblog(spark, sf)
    st = F.when(F.col("line").rlike(LOG_PATTERN), F.regexp_extract("line", LOG_PATTERN, 6)).otherwise("[error]")
    return wl.select("event_id", udfs.status_class_udf(st).alias("status_class"))


@query("udaf_sum", """
select l_returnflag, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem group by all""")
def q_udaf_sum(spark, sf):
    li = table(spark, sf, "lineitem")
    return udfs.partial_sums(li, "l_returnflag", "l_quantity")


@query("udtf_words", D.with_(D.POSTS) + f"""
select post_id, count(*) as n_words, cast(sum(length(word)) as bigint) as total_word_len
from (select post_id, unnest({D.tok('text')}) as word from posts) group by post_id""")
def q_udtf_words(spark, sf):
    split_words = udfs.make_word_udtf()
    w = split_words(posts(spark, sf).select("post_id", "text").asTable())
    return w.groupBy(F.col("id").alias("post_id")).agg(F.count(F.lit(1)).alias("n_words"),
                                    F.sum(F.length("word")).cast("bigint").alias("total_word_len"))
