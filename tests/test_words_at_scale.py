"""Words of long texts: what a task or a call holds of them."""
import pyarrow as pa
from pyspark.sql import functions as F

from tidewater.functions import udfs
from tidewater.operators import text as T
from tidewater.plans import all_queries


def test_the_table_function_splits_a_piece_of_a_batch_at_a_time():
    texts = ["a b", None, "", "   ", "x " * 900_000, *["word " * 1000] * 900]
    rows = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    sizes = [sum(len(t or "") for t in p.column(1).to_pylist()) for p in udfs.pieces(rows, 1)]
    assert sum(sizes) == sum(len(t or "") for t in texts) and len(sizes) >= 6
    assert sorted(sizes)[-2] <= udfs.SPLIT_BYTES and max(sizes) == 1_800_000
    assert [i for p in udfs.pieces(rows, 1) for i in p.column(0).to_pylist()] == list(range(len(texts)))
    yielded = list(udfs.make_word_udtf().func().eval(rows))
    assert len(yielded) == len(sizes) and sum(t.num_rows for t in yielded) == 2 + 1 + 900_000 + 900_000


def test_words_are_not_shuffled_but_their_texts(spark, tmp_path):
    docs = [(i % 40, f" a{i}  b c{i % 3} " * (i % 5), "en", "web") for i in range(60)] + [(7, None, "en", "web"), (None, "x", "en", "web")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    df = all_queries()["words"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.index("Generate") < plan.index("Exchange ")      # the shuffle lies below
    many = T.texts_by_key(spark.createDataFrame([(d[0], d[1]) for d in docs], "post_id long, text string"), "post_id", most=100)
    assert many.rdd.getNumPartitions() > 4
    plan = T.words(many).groupBy("post_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "hashpartitioning(post_id" in plan
    got = {r.post_id: (r.n_words, r.total_word_len, r.last_pos) for r in df.collect()}
    ws = T.words(spark.createDataFrame([(d[0], f"{d[1]} #en #web" if d[1] is not None else None) for d in docs], "post_id long, text string"))
    want = ws.groupBy("post_id").agg(F.count("word").alias("n"), F.sum(F.length("word")).alias("s"), F.max("pos").alias("p")).collect()
    assert got == {r.post_id: (r.n, r.s, r.p) for r in want}
