"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proven offline (bpe.whole_tokens); pre-tokens among them count one each, and only the
rest goes through the merges. No shuffle: one pass over the texts, with a bounded memory of chunks in each worker."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm import bpe
from sedimenta.llm.common import text_or_empty


def token_counts(df: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of df: the id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Ids may be null or repeat; every row is kept. Other columns, whatever their names, are
    not read. An empty table gives an empty result."""
    spec = bpe.load(df.sparkSession, tokenizer)
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(spec)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [len(encode(t)) // 4 for t in texts]
            sizes = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, schema)
