"""Token-ID output in Parquet list columns (operator 4).

A token file set is a folder ``data`` of Parquet files in ascending document order and
a small table ``index`` with a row per shard. A data row has shard, doc_id, shard_start
(ids before it in its shard), n_tokens and token_ids (list of 32-bit integers). Token
ids are delta-encoded in pages of a bounded number of rows; row groups are bounded in bytes; Parquet's column and
offset indexes let a reader fetch some documents' tokens, and the metadata columns
without any token page. Shards are ranges of the id order, written by one task each, so
running offsets need no pass over the tokens.

Defined cases: a null text is empty and has only the end id; null ids come last; equal
ids are ordered by a hash of their text; an empty table gives an empty file set. Other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import Scratch, partitions, released, slices, table, text_or_empty
from stratum.llm.encoding import byte_bpe

END_ID = 0
DATA_SCHEMA = "shard int, doc_id long, shard_start long, n_tokens long, token_ids array<int>"
INDEX_SCHEMA = "shard int, start long, n_docs long, n_tokens long"
PARQUET = {
    "parquet.writer.version": "v2",  # delta encodings
    "parquet.enable.dictionary#token_ids.list.element": "false",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#shard_start": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1024",
    "compression": "snappy",
}


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, before = byte_bpe(path, specials=True), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids = [np.append(x, np.int32(END_ID)) for x in encoder.encode(batch.column("text"))]
            n = np.array([len(x) for x in ids], np.int64)
            ends = np.cumsum(n)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), shard, np.int32)), batch.column("doc_id"), pa.array(before + ends - n), pa.array(n),
                 pa.ListArray.from_arrays(offsets, np.concatenate(ids).astype(np.int32))],
                names=["shard", "doc_id", "shard_start", "n_tokens", "token_ids"])
            before += int(ends[-1])
    return run


def write_tokens(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write a token file set below ``path``."""
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("_tie", F.xxhash64("text")))
    order = [F.asc_nulls_last("doc_id"), F.asc("_tie")]
    ordered = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(released(_encode(tokenizer)), DATA_SCHEMA).write.options(**PARQUET).parquet(f"{path}/data")
    shards = (spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data").groupBy("shard")
              .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    (shards.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_docs", "n_tokens")
     .write.parquet(f"{path}/index"))


def read_tokens(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """The documents of a token file set: doc_id, start (ids of all documents before), n_tokens and,
    if asked for, token_ids; without them no token page is read."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index").select("shard", F.col("start").alias("_shard_at"))
    data = spark.read.schema(DATA_SCHEMA).parquet(f"{path}/data")
    columns = ["doc_id", (F.col("_shard_at") + F.col("shard_start")).alias("start"), "n_tokens"]
    return data.join(index, "shard").select(*columns, *(["token_ids"] if tokens else []))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column("token_ids")
        values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_pylist()
        crc = [zlib.crc32(values[x:y]) for x, y in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{Scratch(spark, 'op4').root}/tokens"
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_tokens(spark, path).mapInArrow(released(_crc), "doc_id long, start long, n_tokens long, ids_crc32 long")
