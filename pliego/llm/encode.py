"""Problem 6: encoding a whole corpus with a public byte-level BPE tokenizer."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pliego.llm.byte_bpe import encoder
from pliego.llm.spark import columns, prepare

#: Where the public tokenizers lie; a parameter of every operator.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")


def tokenizer_path(name: str, folder: str = TOKENIZERS) -> str:
    return os.path.join(folder, name)


def encode_ids(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, ids` of every row of df: the ids of `text` without special tokens.

    A null text and an empty one have no ids (an empty list, never null); strings of special tokens
    are ordinary text; repeated rows come out as often as they stand there.  No shuffle: each
    partition is encoded where it is read.
    """
    prepare(df.sparkSession)

    def work(batches):
        bpe = encoder(path)
        for batch in batches:
            offsets, ids = bpe.encode(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    schema = T.StructType([df.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return columns(df, key, text).mapInArrow(work, schema)


def count_tokens(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", out: str = "n_tok") -> DataFrame:
    """`key, out`: the number of tokens of every row's text, 0 for null and empty ones."""
    prepare(df.sparkSession)

    def work(batches):
        bpe = encoder(path)
        for batch in batches:
            n = pa.array(bpe.counts(batch.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n], names=[key, out])

    schema = T.StructType([df.schema[key], T.StructField(out, T.LongType())])
    return columns(df, key, text).mapInArrow(work, schema)
