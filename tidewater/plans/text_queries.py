"""Short-text and word queries over ``posts`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.text import jvm_split
from tidewater.operators import text as T
from tidewater.operators.windows import (
    bucket_counts,
    sliding_counts,
    top_k_change_points,
    top_k_per_window,
)
from tidewater.plans import duck as D
from tidewater.plans.registry import query
from tidewater.sources.tables import posts, table

WINDOW_S = 300
SLIDE_S = 60
BATCH_S = 3600
TOP_K = 10
WORD_TOP = 20
PRINT_ROWS = 10

_U16 = "(length({s}) + length(regexp_replace({s}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def u16(s: str) -> str:
    return _U16.format(s=s)


# -- SRC7 -------------------------------------------------------------------------
@query("posts_text", D.with_(D.POSTS) + "select post_id, text from posts")
def q_posts_text(spark, sf):
    return posts(spark, sf).select("post_id", "text")


# -- SCL2 ---------------------------------------------------------------------------
@query("tokens", D.with_(D.POSTS) + f"""
select post_id, cast(len({D.tok('text')}) as integer) as n_tokens,
       cast(len(list_filter({D.tok('text')}, lambda x: x = '')) as integer) as n_empty,
       array_to_string({D.tok('text')}, '|') as joined
from posts""")
def q_tokens(spark, sf):
    t = jvm_split("text")
    return posts(spark, sf).select(
        "post_id", F.size(t).alias("n_tokens"),
        F.size(F.filter(t, lambda x: x == "")).alias("n_empty"), F.array_join(t, "|").alias("joined"))


# -- PRJ9 / UDF3 (built-in form) ------------------------------------------------------
@query("words", D.with_(D.POSTS) + f"""
select post_id, count(*) as n_words, cast(sum(length(word)) as bigint) as total_word_len,
       cast(max(pos) as integer) as last_pos, string_agg(word, '|' order by pos) as joined
from (select post_id, unnest({D.tok('text')}) as word,
             unnest(range(0, len({D.tok('text')}))) as pos from posts)
group by post_id""")
def q_words(spark, sf):
    w = T.words(T.texts_by_key(posts(spark, sf), "post_id"))
    return w.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_words"),
                                    F.sum(F.length("word")).cast("bigint").alias("total_word_len"),
                                    F.max("pos").alias("last_pos"),
                                    F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))),
                                                             lambda x: x["word"]), "|").alias("joined"))


# -- FLT1 / SCL8 ------------------------------------------------------------------------
_TAGS = f"""h as (select post_id, ts, word as hashtag
  from (select post_id, ts, unnest({D.tok('text')}) as word from posts) where starts_with(word, '#'))"""


@query("hashtags", D.with_(D.POSTS, _TAGS) + "select post_id, hashtag, count(*) as n from h group by all")
def q_hashtags(spark, sf):
    return T.hashtags(posts(spark, sf)).groupBy("post_id", "hashtag").agg(F.count(F.lit(1)).alias("n"))


# -- APP7: popular hashtags over sliding windows ------------------------------------------
@query("top_hashtags", D.with_(D.POSTS, _TAGS) + f"""
select * from (
  select *, cast(row_number() over (partition by window_start, window_end
                                    order by n desc, hashtag asc nulls first) as integer) as rank
  from {D.sliding('h', 'ts', ['hashtag'], WINDOW_S, SLIDE_S)}) where rank <= {TOP_K}""")
def q_top_hashtags(spark, sf):
    tags = T.hashtags(posts(spark, sf), keep=("post_id", "ts"))
    return top_k_per_window(sliding_counts(tags, "ts", ["hashtag"], WINDOW_S, SLIDE_S), "hashtag", TOP_K)


# -- APP7 at the reference's 1 s slide --------------------------------------------------------
TOP_HASHTAGS_1S = D.with_(D.POSTS, _TAGS) + D.top_change_points("h", "hashtag", WINDOW_S, TOP_K)


@query("top_hashtags_1s", TOP_HASHTAGS_1S)
def q_top_hashtags_1s(spark, sf):
    tags = T.hashtags(posts(spark, sf), keep=("post_id", "ts"))
    return top_k_change_points(bucket_counts(tags, "ts", ["hashtag"], 1), "hashtag", WINDOW_S, 1, TOP_K)


# -- SRC1 / SCL3 / AGG3 / APP12 ----------------------------------------------------------
_WC = f"""wc as (select lower(w) as word, count(*) as n from (
  select unnest({D.tok('line')}) as w from (select unnest({D.lines('text')}) as line from documents))
  group by all)"""


@query("word_count", D.with_(_WC) + "select word, n from wc")
def q_word_count(spark, sf):
    return T.word_count(table(spark, sf, "documents"))


@query("word_count_top", D.with_(_WC) + f"select word, n from wc order by n desc, word asc limit {WORD_TOP}")
def q_word_count_top(spark, sf):
    return T.top_n(T.word_count(table(spark, sf, "documents")), WORD_TOP, "n", "word")


# -- SCL4 ------------------------------------------------------------------------------------
@query("text_length", D.with_(D.POSTS) + f"""
select post_id, cast(length(text) as bigint) as length, cast({u16('text')} as bigint) as utf16_length
from posts""")
def q_text_length(spark, sf):
    return T.text_lengths(posts(spark, sf))


# -- AGG6 / AGG7 / APP8 / APP9 ------------------------------------------------------------------
_RUN = f"""r as (select batch_start,
   cast(sum(n) over w as bigint) as n_posts, cast(sum(c) over w as bigint) as total_chars,
   cast(max(m) over w as bigint) as max_len
 from (select make_timestamp(epoch_us(ts) - epoch_us(ts) % {BATCH_S * 1_000_000}) as batch_start,
              count(*) as n, sum({u16('text')}) as c, max({u16('text')}) as m
       from posts group by all)
 window w as (order by batch_start rows between unbounded preceding and current row))"""


@query("post_length_avg", D.with_(D.POSTS, _RUN) + """
select batch_start, n_posts, total_chars, total_chars // n_posts as avg_len,
       total_chars / n_posts as avg_len_exact from r""")
def q_post_length_avg(spark, sf):
    r = T.running_length_totals(posts(spark, sf), "ts", BATCH_S)
    return r.select("batch_start", "n_posts", "total_chars", "avg_len", "avg_len_exact")


@query("post_length_max", D.with_(D.POSTS, _RUN) + "select batch_start, max_len from r")
def q_post_length_max(spark, sf):
    return T.running_length_totals(posts(spark, sf), "ts", BATCH_S).select("batch_start", "max_len")


# -- SNK1 / APP10: first 10 rows of every batch ------------------------------------------------
@query("print_posts", D.with_(D.POSTS) + f"""
select batch_start, post_id, text, rn from (
  select make_timestamp(epoch_us(ts) - epoch_us(ts) % {BATCH_S * 1_000_000}) as batch_start, post_id, text,
         cast(row_number() over (partition by epoch_us(ts) - epoch_us(ts) % {BATCH_S * 1_000_000}
                                 order by ts, post_id) as integer) as rn
  from posts) where rn <= {PRINT_ROWS}""")
def q_print_posts(spark, sf):
    p = T.first_per_batch(posts(spark, sf), "ts", BATCH_S, PRINT_ROWS, ["ts", "post_id"])
    return p.select("batch_start", "post_id", "text", "rn")
