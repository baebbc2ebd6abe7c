"""What models learn from: the same rows whatever the partitions, and never none."""

import random

import pytest
from pyspark.sql import functions as F

from apportion.llm import langid, quality
from apportion.llm.common import LONGEST, bounded_sample


def test_a_sample_of_a_huge_table_is_not_empty(spark):
    many = spark.range(3_000_000).select(F.col("id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    got = {r["id"] for r in bounded_sample(many, 2).collect()}
    assert len(got) == 2 and got == {r["id"] for r in bounded_sample(many.repartition(7), 2).collect()}


def test_models_and_the_pipeline_s_first_stage_at_huge_totals(spark):
    docs = spark.range(3_000_000).select(F.when(F.col("id") % 2 == 0, "der und die nicht").otherwise("the and of that").alias("text"), F.when(F.col("id") % 2 == 0, "de").otherwise("en").alias("lang"))
    model = langid.fit(docs, rows=2)  # two distinct rows among three million
    assert model.langs == ("de", "en")
    assert langid.accepted(docs.limit(10), model).count() == 10


@pytest.mark.parametrize("rows", [1, 40, 5_000])
def test_rows_do_not_depend_on_partitions(spark, rows):
    r = random.Random(3)
    docs = spark.createDataFrame([(i % 700, " ".join(r.choices("a b c d e f g".split(), k=9)), i % 3) for i in range(2_000)], "doc_id long, text string, x int")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in (3, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, bounded_sample(docs.repartition(n), rows).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", was)
    assert got[0] == got[1] and len(got[0]) == min(rows, docs.distinct().count())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, "x" * (LONGEST + 1)), (None, "y"), (None, "y")], "doc_id long, text string")
    assert [tuple(r) for r in bounded_sample(docs, 3).collect()] == [(None, "y")]
    assert bounded_sample(docs.where("false"), 3).count() == 0
    clash = docs.withColumnRenamed("doc_id", "__hash")
    assert bounded_sample(clash, 3).columns == clash.columns


def test_fitted_models_do_not_depend_on_partitions(spark):
    r = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(r.choices(("good fine well nice" if i % 2 else "bad poor ill worse").split(), k=20)), "en" if i % 2 else "de") for i in range(300)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    a, b = (quality.fit(docs.repartition(n), labels.repartition(n), rows=100) for n in (1, 9))
    assert a == b
    a, b = (langid.fit(docs.repartition(n), rows=100) for n in (1, 9))
    assert (a.table == b.table).all() and (a.langs, a.temperature, a.threshold) == (b.langs, b.temperature, b.threshold)
