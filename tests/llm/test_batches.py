"""Operators that send texts to Python bound the batches the JVM holds, unless the session has a bound."""

import pyarrow as pa

from fundlens.llm import common, language_id

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(rows):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"size": batch.nbytes}])

    return max(r.size for r in rows.coalesce(1).mapInArrow(run, "size long").collect())


def test_texts_travel_in_bounded_batches(spark):
    spark.conf.unset(KEY)
    texts = spark.range(20_000).selectExpr("id AS doc_id", "repeat('ab ', 400) AS text", "'en' AS lang")
    assert largest(texts) > 10 << 20
    language_id.identify(texts.limit(10))
    assert largest(texts) < 1.5 * common.BATCH_BYTES
    spark.conf.set(KEY, "2m")
    language_id.identify(texts.limit(10))
    assert spark.conf.get(KEY) == "2m" and largest(texts) < 3 << 20
    spark.conf.unset(KEY)
