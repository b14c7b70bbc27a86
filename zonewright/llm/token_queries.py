"""Query of the token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from zonewright.llm.registry import query, table
from zonewright.llm.token_frames import read_token_files, write_token_files

VOCABULARY = "byte_bpe_50k.json"


@query("op5_token_files")
def op5_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    files = write_token_files(docs, public_tokenizers.path(VOCABULARY), end_id=0)
    return read_token_files(files).select(
        "doc_id", "start", "n_tokens", F.crc32("token_bytes").alias("ids_crc32")
    )
