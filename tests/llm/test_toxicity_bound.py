"""Labels without a text take nothing from the bound of the training rows."""

import __spark_entry__  # noqa: F401  (ships the package to the workers)
from pyspark.sql import functions as F

from pairforge.llm import toxicity


def test_labels_without_a_text_leave_the_model_as_it_is(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.expr("concat(if(id % 2 = 0, 'vile nasty words ', 'kind and fair words '), 'w', id % 7)").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    lost = spark.range(1000, 21000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    nulls = spark.range(1000, 6000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    plain = toxicity.fit(docs, labels, rows=200)
    mixed = toxicity.fit(docs.unionByName(nulls), labels.unionByName(lost), rows=200)
    assert len(plain[0]) > 1 and [x.tolist() for x in plain] == [x.tolist() for x in mixed]
