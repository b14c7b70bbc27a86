"""Query of BPE encoding and decoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from zonewright.llm.bpe import round_trip
from zonewright.llm.registry import query, table

VOCABULARY = "byte_bpe_50k.json"


@query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark, sf_dir):
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
