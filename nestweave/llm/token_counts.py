"""Token counts (8): a separator scan over flat token files that have no index.

A flat token file is nothing but the ids of one document after the other, each with the
end-of-document id behind it. It is scanned in blocks that know nothing of documents: a vectorised
search finds the separators of a block, and what a document has in earlier blocks is added
afterwards, by a prefix scan over one small summary per block (separators in it, ids behind the
last of them). The scan runs over the blocks of a chunk and then over the chunks of a file, so no
task holds the summaries of a whole large file.

Defined results: ids behind the last separator of a file are a document without an end (``ended``
false); two separators in a row enclose a document of no tokens; an empty file has no documents. A
null or empty text is such an empty document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nestweave.llm.common import each_row, texts, written
from nestweave.llm.tokens import text_ids

BLOCK_IDS = 1 << 15
CHUNK_BLOCKS = 1 << 10
BLOCKS = "file string, block long, data binary"


def read_flat(spark: SparkSession, path: str, id_bytes: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, block, data) of flat binary files, by any file system that Spark reads.

    Spark hands over a binary file as one row, so files are at most 2 GB, as token shards are.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = block_ids * id_bytes
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                for i, at in enumerate(range(0, len(content), step)):
                    yield pd.DataFrame({"file": [name], "block": [i], "data": [content[at : at + step]]})

    return files.mapInPandas(blocks, BLOCKS)


def scan_separators(blocks: DataFrame, separator: int, dtype: str = "<u2") -> DataFrame:
    """(file, document, start, n_tokens, ended) for every document of the files.

    ``document`` counts from 0 within its file; ``start`` is the place of its first id there.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, sizes = [], []
            for data in batch["data"]:
                ids = np.frombuffer(data, dtype=dtype)
                found.append(np.flatnonzero(ids == separator).astype(np.int64))
                sizes.append(len(ids))
            yield batch[["file", "block"]].assign(n_ids=sizes, ends=found)

    rows = blocks.mapInPandas(scan, "file string, block long, n_ids long, ends array<bigint>")
    rows = rows.withColumn("chunk", F.floor(F.col("block") / CHUNK_BLOCKS).cast("long"))
    rows = written(rows.withColumn("n_ends", F.size("ends").cast("long")), "separators")
    # Ids before a block and documents ended before it, first within its chunk; "last_end" is the
    # place behind the last separator, counted from the start of the chunk and then of the file.
    chunks = rows.groupBy("file", "chunk").agg(
        F.sum("n_ids").alias("n_ids"), F.sum("n_ends").alias("n_ends")
    )
    earlier = "ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    chunks = chunks.selectExpr(
        "file", "chunk",
        f"coalesce(sum(n_ids) OVER (PARTITION BY file {earlier}), 0) AS ids_before",
        f"coalesce(sum(n_ends) OVER (PARTITION BY file {earlier}), 0) AS ends_before",
    )
    earlier = "ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    within = rows.selectExpr(
        "*",
        f"coalesce(sum(n_ids) OVER (PARTITION BY file, chunk {earlier}), 0) AS ids_in",
        f"coalesce(sum(n_ends) OVER (PARTITION BY file, chunk {earlier}), 0) AS ends_in",
    )
    placed = within.join(chunks, ["file", "chunk"]).selectExpr(
        "file", "chunk", "block", "n_ids", "n_ends", "ends",
        "ids_before + ids_in AS at", "ends_before + ends_in AS nth",
    )
    placed = written(placed, "placed-blocks")
    # The place behind the last separator of all earlier blocks: within the chunk, else before it.
    last = "CASE WHEN n_ends > 0 THEN at + element_at(ends, -1) + 1 END"
    of_chunk = placed.groupBy("file", "chunk").agg(F.max(F.expr(last)).alias("last_end"))
    of_chunk = of_chunk.selectExpr(
        "file", "chunk",
        "coalesce(max(last_end) OVER (PARTITION BY file ORDER BY chunk "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk_from",
    )
    carried = placed.selectExpr(
        "*", f"max({last}) OVER (PARTITION BY file, chunk {earlier}) AS block_from"
    ).join(of_chunk, ["file", "chunk"])
    carried = carried.withColumn("from", F.coalesce("block_from", "chunk_from"))
    ends = F.transform("ends", lambda x: x + F.col("at"))
    begins = F.concat(F.array("from"), F.transform(ends, lambda x: x + 1))
    spans = F.arrays_zip(begins.alias("start"), ends.alias("end"))
    ended = carried.where("n_ends > 0").select("file", "nth", F.posexplode(F.slice(spans, 1, F.size("ends"))))
    ended = ended.select(
        "file", (F.col("nth") + F.col("pos")).alias("document"), "col.start",
        (F.col("col.end") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("ended"),
    )
    files = placed.groupBy("file").agg(
        F.sum("n_ids").alias("n_ids"), F.sum("n_ends").alias("document"),
        F.coalesce(F.max(F.expr(last)), F.lit(0)).alias("start"),
    )
    open_end = files.where("n_ids > start").select(
        "file", "document", "start", (F.col("n_ids") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended")
    )
    return ended.unionByName(open_end)


def write_flat(docs: DataFrame, tokenizer: str, separator: int, block_ids: int = BLOCK_IDS) -> tuple[DataFrame, DataFrame]:
    """Writes ``docs`` as flat token streams, one per input partition; (blocks, names).

    The streams are cut into blocks without regard to documents. ``names`` has (file, document,
    doc_id): the order in which the documents went in. The ids are 16 bits wide.
    """
    rows = texts(docs).select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("long"), "text")

    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(("file", "document", "doc_id", "block", "data"), types, strict=True)))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema=schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, step = text_ids(tokenizer, True), 2 * block_ids
        end = np.array([separator], "<u2").tobytes()
        held, block, document, name = bytearray(), 0, 0, ""
        for batch in batches:
            rows: list[tuple] = []
            for part, doc_id, text in each_row(batch):
                name = f"part-{part:06d}"
                rows.append((name, document, doc_id, None, None))
                document += 1
                held += np.frombuffer(ids.text(text), "<u4").astype("<u2").tobytes() + end
                for _ in range(len(held) // step):
                    rows.append((name, None, None, block, bytes(held[:step])))
                    del held[:step]
                    block += 1
            if rows:
                yield table(rows)
        if held:
            yield table([(name, None, None, block, bytes(held))])

    both = written(
        rows.mapInArrow(stream, "file string, document long, doc_id long, block long, data binary"), "token-files"
    )
    blocks = both.where("block IS NOT NULL").select("file", "block", "data")
    return blocks, both.where("document IS NOT NULL").select("file", "document", "doc_id")


def count_tokens(docs: DataFrame, tokenizer: str, separator: int) -> DataFrame:
    """(doc_id, file, document, start, n_tokens) of every row of ``docs``, from its token files."""
    blocks, names = write_flat(docs, tokenizer, separator)
    counts = scan_separators(blocks, separator).where("ended").drop("ended")
    return names.join(counts, ["file", "document"]).select("doc_id", "file", "document", "start", "n_tokens")
