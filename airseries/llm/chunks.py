"""Documents in chunks of bounded size, written once so that several passes can meet them by chunk."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from airseries.llm.common import release_memory, schema_of
from airseries.session import stage_path

#: Chunks of one task are numbered from its partition's number times this.
CHUNKS_PER_TASK = 1 << 20


def in_chunks(docs: DataFrame, chunk_bytes: int, **columns: Column) -> DataFrame:
    """The columns given (one of them ``text``) and ``chunk``, as a bucketed table.

    Rows that follow each other in a partition share a chunk until their texts reach ``chunk_bytes``,
    so no text is shuffled and a chunk is bounded whatever the ids and texts are. The table
    lies in the shared folder, bucketed by chunk: passes grouped by chunk read it in
    place, and only what they exchange moves.
    """
    source = docs.select(*[c.alias(name) for name, c in columns.items()])
    schema = schema_of(source, source.columns, [("chunk", "long")])
    text_at = source.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held = TaskContext.get().partitionId() * CHUNKS_PER_TASK, 0
        for batch in batches:
            numbers = []
            for text in batch.column(text_at):
                size = len(text.as_buffer()) if text.is_valid else 0
                if held and held + size > chunk_bytes:
                    chunk, held = chunk + 1, 0
                held += size
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "chunk"]
            )
            release_memory()

    spark = docs.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = source.mapInArrow(run, schema).write.bucketBy(buckets, "chunk")
    writer.option("path", stage_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)
