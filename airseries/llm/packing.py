"""Cost-balanced packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airseries.llm.common import as_bytes, release_memory
from airseries.llm.tokens import VOCABULARY, encode_texts

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, cost double"
)
#: Sequences of one task are numbered from its partition's number times this.
SEQUENCES_PER_TASK = 1 << 40


def piece_cost(length: np.ndarray | int, capacity: int, linear: float, quadratic: float):
    """Estimated cost of a piece: linear layers, and attention within the piece."""
    return linear * length + quadratic * length * length / capacity


@dataclass
class Begun:
    """Room and cost of the sequences begun so far."""

    room: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cost: np.ndarray = field(default_factory=lambda: np.zeros(0))


def balance(
    lengths: np.ndarray,
    capacity: int,
    linear: float = 1.0,
    quadratic: float = 1.0,
    begun: Begun | None = None,
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths.

    Sequences ``begun`` before are numbered first, and those begun now are added to them.
    Whole sequences are cut off the front of long documents. What is left of each goes,
    by falling cost, to the sequence of lowest cost that has room for all of it;
    if none has, the cheapest one with any room takes what fits and the rest goes on.
    No more sequences are begun than are needed to hold all tokens.
    """
    pieces = []
    begun = begun or Begun()
    rest = lengths % capacity
    number = max(0, -(-int(rest.sum() - begun.room.sum()) // capacity))
    room = np.concatenate([begun.room, np.full(number, capacity, np.int64)])
    cost = np.concatenate([begun.cost, np.zeros(number)])
    # Whole sequences come after those that are shared.
    sequence = len(room)
    for doc in np.flatnonzero(lengths >= capacity):
        for start in range(0, int(lengths[doc] - rest[doc]), capacity):
            pieces.append((int(doc), start, capacity, sequence, 0))
            sequence += 1
    order = np.lexsort((np.arange(len(rest)), -piece_cost(rest, capacity, linear, quadratic)))
    for doc in order:
        left = int(rest[doc])
        start = int(lengths[doc]) - left
        while left:
            to = int(cost.argmin())
            if room[to] < left:
                fits = np.flatnonzero(room >= left)
                if len(fits):
                    to = int(fits[cost[fits].argmin()])
            size = min(left, int(room[to]))
            pieces.append((int(doc), start, size, to, int(capacity - room[to])))
            room[to] -= size
            # A full sequence is out of the race; its cost is set beyond all others.
            cost[to] = cost[to] + piece_cost(size, capacity, linear, quadratic) if room[to] else np.inf
            start += size
            left -= size
    begun.room, begun.cost = room, cost
    return pieces


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    vocabulary: str = VOCABULARY,
    linear: float = 1.0,
    quadratic: float = 1.0,
    with_ids: bool = False,
    task_bytes: int = 1 << 20,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    A document is its byte-BPE ids and then ``end_id``. Each Arrow batch of rows
    is packed (``balance``) into the sequences that the batches before it left open and as
    few new ones as hold it, so nothing is shuffled, memory is bounded by a batch (open sequences have less
    than ``capacity`` tokens of room in all), and less than one sequence's worth of padding is left per task.
    Partitions that hold fewer bytes than ``task_bytes`` on average are first put together, whole and
    without a shuffle, so that many small ones do not leave many sequences unfilled. A task that
    runs again gets the same rows and numbers.

    Null and empty texts are one piece with the end id alone; a null id stays null;
    repeated rows are packed once each; other columns are left out. ``with_ids`` adds
    the pieces' ids as an array.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    from pyspark.sql.pandas.types import to_arrow_schema

    from airseries.llm.common import schema_of

    arrow = to_arrow_schema(schema_of(docs, [], [tuple(f.split()) for f in schema.split(", ")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        next_sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        numbers, begun = np.zeros(0, np.int64), Begun()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [t or b"" for t in as_bytes(batch.column(1)).to_pylist()]
            owners = batch.column(0).to_pylist()
            ids, ends = encode_texts(texts, vocabulary)
            ids = np.insert(ids, ends[1:], np.uint32(end_id)).astype("<u4")
            ends = ends + np.arange(len(ends))
            lengths = np.diff(ends)
            rows = balance(lengths, capacity, linear, quadratic, begun)
            doc, start, size, sequence, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            new = int(max(sequence.max() + 1, len(begun.room)) - len(numbers))
            numbers = np.concatenate([numbers, np.arange(next_sequence, next_sequence + new)])
            next_sequence += new
            sequence = numbers[sequence]
            stay = begun.room > 0
            numbers, begun = numbers[: len(stay)][stay], Begun(begun.room[stay], begun.cost[stay])
            begin = ends[doc] + start
            parts = [ids[b : b + n] for b, n in zip(begin.tolist(), size.tolist(), strict=True)]
            columns = [
                pa.array(owners, pa.int64()).take(pa.array(doc)),
                pa.array(start),
                pa.array(size),
                pa.array([zlib.crc32(p.data) for p in parts], pa.int64()),
                pa.array(lengths[doc]),
                pa.array(sequence),
                pa.array(offset),
                pa.array(piece_cost(size.astype(float), capacity, linear, quadratic)),
            ]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                columns.append(
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts).astype(np.int32)))
                )
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )
            # Nothing of a batch is held while the next one comes in or the worker waits for its next task.
            del batch, texts, owners, ids, rows, parts, columns
            release_memory()

    rows = docs.selectExpr(f"cast(`{id_col}` as long) as id", f"`{text_col}` as text")
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    return rows.coalesce(held // task_bytes + 1).mapInArrow(run, schema)


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
