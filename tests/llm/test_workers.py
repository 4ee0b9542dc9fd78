"""What worker processes keep from task to task."""

import pyarrow as pa

from marketloom.llm.common import map_text
from marketloom.llm.sentencepiece_codec import Codec, encode_documents, machine


def held(batch):
    return pa.RecordBatch.from_arrays([pa.array([machine.cache_info().currsize], pa.int64())], names=["n"])


def test_other_work_finds_no_model_in_the_worker(spark):
    docs = spark.range(400, numPartitions=8).selectExpr("id as doc_id", "concat('text number ', id) as text")
    first = encode_documents(docs, Codec.load()).collect()
    assert {r.n for r in map_text(spark.range(400, numPartitions=8), held, "n long", keep="sentencepiece").collect()} >= {1}
    assert {r.n for r in map_text(spark.range(400, numPartitions=8), held, "n long").collect()} == {0}
    assert sorted(first) == sorted(encode_documents(docs, Codec.load()).collect())
