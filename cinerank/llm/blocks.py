"""Documents packed into blocks: rows of compressed Arrow tables that ask for corpus-wide facts and get them back.

What a block needs (counts of its words, names of its passages) is asked for with one row for each distinct key of
the block, summed over the corpus by key, and returned to the block as one row; neither the driver nor a task ever
holds the whole table, and a key that a third of all rows have is asked for once a block.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cinerank.llm.common import byte_column, pieces, settle

#: Bytes of text in a block at most, but for a single longer row; and rows.
BLOCK, ROWS = 24 << 20, 1 << 20


def encode(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def decode(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def pack(df: DataFrame, name: str, text: str = "text", size: int = BLOCK) -> tuple[DataFrame, str]:
    """A written table with a row a block: block (long) and payload (the rows); rows keep their order. Also its path."""

    def run(batches):
        at, seq, have, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        for b in batches:
            off = byte_column(b.column(text))[1]
            for i, j in pieces(off, size):
                n = int(off[j] - off[i])
                if parts and (have + n > size or sum(map(len, parts)) + j - i > ROWS):
                    yield pa.record_batch([pa.array([at + seq]), pa.array([encode(pa.Table.from_batches(parts))], pa.binary())], names=["block", "payload"])
                    seq, have, parts = seq + 1, 0, []
                parts.append(b.slice(i, j - i))
                have += n
        if parts:
            yield pa.record_batch([pa.array([at + seq]), pa.array([encode(pa.Table.from_batches(parts))], pa.binary())], names=["block", "payload"])

    return settle(df.mapInArrow(run, "block long, payload binary"), name)


def payloads(batches):
    """(block, table, the batch's row) of each block, one at a time."""
    for b in batches:
        for k in range(len(b)):
            yield b.column("block")[k].as_py(), decode(b.column("payload")[k].as_py()), b.slice(k, 1)
