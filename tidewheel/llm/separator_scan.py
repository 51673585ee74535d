"""Token counts by separator scan of flat, unindexed token files.

A flat file is a stream of ids without any index, stored as Parquet rows of fixed-size blocks that cut through
documents wherever they fill up; only end-of-document ids tell documents apart. The scan searches each block's
ids for the separator in one vectorised comparison and stitches documents that cross blocks with a prefix scan:
each block contributes (ids, separators, last separator), and exclusive running sums and maxima over the blocks
before it give the place and number of its first document. Ranges of blocks are scanned by part, and the parts'
totals, one row each, are summed on the driver.

``write`` keeps the input's order (no shuffle) and stores the documents' names apart, in order: the names tell
which document is the k-th, never where it lies. Null texts are empty documents (the separator alone, counted as
1 with the separator); repeated rows stay; ids after the last separator of a part form an unfinished document
that belongs to the next part's first separator, as in one long file. An empty file gives no rows. Names are 64-bit
integers. Part numbers are those of the writer's tasks and so depend on the input's files; ``counts`` leaves them out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import placed, scratch_path, stored
from tidewheel.llm.word_tokens import encoder

#: Ids in a block.
BLOCK = 1 << 18
SCHEMA = "part int, block int, data binary, names array<long>"
_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("data", pa.binary()), ("names", pa.list_(pa.int64()))])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, dtype: str = "<u2") -> None:
    """Encodes (doc_id, text) rows in input order, each followed by ``end_id``, as flat blocks; names go in rows of their own (block < 0)."""
    width = np.dtype(dtype).itemsize
    end = np.array([end_id], dtype).tobytes()

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, dtype, True), TaskContext.get().partitionId()
        held, block, named = bytearray(), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for ids in enc.encode(batch.column(1)[lo : lo + 256].to_pylist()):
                    held += ids
                    held += end
                    while len(held) >= BLOCK * width:
                        yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "data": bytes(held[: BLOCK * width])}], _ARROW)
                        del held[: BLOCK * width]
                        block += 1
            named -= 1
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([named], pa.int32()), pa.array([None], pa.binary()), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(0).cast(pa.int64()))], schema=_ARROW)
        if held:
            yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "data": bytes(held)}], _ARROW)

    docs.select("doc_id", "text").mapInArrow(flat, SCHEMA).write.option("compression", "zstd").parquet(path)


def separators(data: bytes, end_id: int, dtype: str = "<u2") -> np.ndarray:
    """Places of the separator in a block."""
    return np.flatnonzero(np.frombuffer(data, dtype) == end_id)


def scan(spark: SparkSession, path: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """(part, k, start, n_tokens): the k-th document that ends in its part, where it starts in the whole stream, and its ids with the separator."""
    width = np.dtype(dtype).itemsize

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column(2).to_pylist()
            found = [separators(d, end_id, dtype).astype(np.int32) for d in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(d) // width for d in data], pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["part", "block", "ids", "at"])

    blocks = spark.read.schema(SCHEMA).parquet(path).where("block >= 0").select("part", "block", "data").mapInArrow(search, "part int, block int, ids long, at array<int>")
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # within a part: ids, separators and the last separator of the blocks before
    blocks = blocks.withColumn("n", F.size("at")).withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    blocks = blocks.withColumn("k0", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("tail", F.when(F.col("n") > 0, F.col("base") + F.element_at("at", -1)))
    blocks = blocks.withColumn("prev", F.max("tail").over(before))
    path2 = scratch_path(spark, "separators")
    blocks.write.parquet(path2)
    blocks = spark.read.schema(blocks.schema).parquet(path2)
    starts, open_, total = [], [], 0
    last = -1  # the last separator before the part
    for r in blocks.groupBy("part").agg(F.sum("ids").alias("ids"), F.max("tail").alias("tail")).orderBy("part").collect():
        starts.append((r["part"], total, last))
        last = total + r["tail"] if r["tail"] is not None else last
        total += r["ids"]
    parts = spark.createDataFrame(starts, "part int, part_base long, part_prev long")
    rows = blocks.where("n > 0").join(F.broadcast(parts), "part")
    first = F.coalesce(F.col("part_base") + F.col("prev"), F.col("part_prev")) + 1
    rows = rows.select("part", "k0", (F.col("part_base") + F.col("base")).alias("from"), first.alias("first"), "at", F.posexplode("at").alias("i", "own"))
    start = F.when(F.col("i") == 0, F.col("first")).otherwise(F.col("from") + F.element_at("at", F.greatest("i", F.lit(1))) + 1)
    return rows.select("part", (F.col("k0") + F.col("i")).alias("k"), start.alias("start"), (F.col("from") + F.col("own") + 1 - start).alias("n_tokens"))


def names(spark: SparkSession, path: str) -> DataFrame:
    """(part, k, doc_id): the k-th document that was written in its part."""
    rows = spark.read.schema(SCHEMA).parquet(path).where("block < 0").select("part", "block", "names")
    before = Window.partitionBy("part").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("k0", F.coalesce(F.sum(F.size("names")).over(before), F.lit(0)))
    return rows.select("part", "k0", F.posexplode("names").alias("i", "doc_id")).select("part", (F.col("k0") + F.col("i")).alias("k"), "doc_id")


def counts(docs: DataFrame, tokenizer: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """(doc_id, start, n_tokens) of every document, from flat files written in the shared folder.

    ``start`` is the number of ids of all documents before it in ascending doc_id order (nulls first, equal ids by
    their counts), so nothing in the result depends on how the input's files were split.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "flat-tokens")
    write(docs, path, tokenizer, end_id, dtype)
    return in_order_of_ids(stored(scan(spark, path, end_id, dtype).join(names(spark, path), ["part", "k"]).select("doc_id", "n_tokens"), "token-counts"))


def in_order_of_ids(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens) of (doc_id, n_tokens) rows: running sums within parts of the ids' range, after the parts' totals."""
    own = placed(rows, "doc_id")
    order = Window.partitionBy("_part").orderBy(F.asc_nulls_first("doc_id"), "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("_to", F.sum("n_tokens").over(order))
    bases, total = [], 0
    for r in placed(rows, "doc_id").groupBy("_part").agg(F.sum("n_tokens").alias("n")).orderBy("_part").collect():
        bases.append((r["_part"], total))
        total += r["n"]
    parts = rows.sparkSession.createDataFrame(bases, "_part int, _base long")
    return own.join(F.broadcast(parts), "_part").select("doc_id", (F.col("_base") + F.col("_to") - F.col("n_tokens")).alias("start"), "n_tokens")
