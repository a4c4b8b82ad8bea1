"""Token files: packed id matrices with cumulative segment lengths and position resets.

Documents are packed as in ``packing`` and written as a Parquet table of matrix blocks. A block is

- ``ids``: ``sequences`` rows of ``width`` little-endian ids (``id_bytes`` bytes each), padded with ``pad``;
- ``cu_seqlens``: for each row the cumulative lengths of its segments, from 0;
- ``position_resets``: offsets into the flat matrix where positions start again at 0: at each segment, and
  at the padding of a row;
- ``doc_ids`` and ``doc_starts``: for each row, the document of each segment and that document's ids before it.

Rows of 4096 ids share blocks of up to ``BLOCK`` rows; a shorter row, whose length is a power of two, is a
block without padding. ``read_sequences`` and ``read_pieces`` give the rows and documents back.

Defined results: as in ``packing``; an empty table writes an empty table.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.llm.packing import WINDOW, Sequence, first_sequence, packed_groups

BLOCK = 64
BLOCKS = (
    "first_sequence long, sequences int, width int, id_bytes int, ids binary, cu_seqlens array<array<int>>, "
    "position_resets array<int>, doc_ids array<array<long>>, doc_starts array<array<long>>"
)
_KINDS = {
    "first_sequence": pa.int64(),
    "sequences": pa.int32(),
    "width": pa.int32(),
    "id_bytes": pa.int32(),
    "ids": pa.binary(),
    "cu_seqlens": pa.list_(pa.list_(pa.int32())),
    "position_resets": pa.list_(pa.int32()),
    "doc_ids": pa.list_(pa.list_(pa.int64())),
    "doc_starts": pa.list_(pa.list_(pa.int64())),
}


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end: int, pad: int = 0, window: int = WINDOW, block: int = BLOCK
) -> None:
    """Write ``docs`` as matrix blocks to the folder ``path``, by Spark's own committed writer."""

    def blocks(batches):
        number = first_sequence()
        for ids, tokens, sequences in packed_groups(batches, vocabulary, end, window):
            for width, group in _by_width(sequences, window, block):
                yield _block(number, width, group, ids, tokens, pad)
                number += len(group)

    docs.select("doc_id", "text").mapInArrow(blocks, BLOCKS).write.parquet(path)


def _by_width(sequences: list[Sequence], window: int, block: int):
    def width(sequence):
        return sequence.length if sequence.length & (sequence.length - 1) == 0 else window

    wide = [s for s in sequences if width(s) == window]
    for start in range(0, len(wide), block):
        yield window, wide[start : start + block]
    for sequence in sequences:
        if width(sequence) < window:
            yield width(sequence), [sequence]


def _block(number: int, width: int, group: list[Sequence], ids, tokens, pad: int) -> pa.RecordBatch:
    matrix = np.full((len(group), width), pad, tokens[0].dtype)
    cumulative, resets, doc_ids, starts = [], [], [], []
    for row, sequence in enumerate(group):
        ends = [0]
        for document, start, length in sequence.pieces:
            matrix[row, ends[-1] : ends[-1] + length] = tokens[document][start : start + length]
            ends.append(ends[-1] + length)
        cumulative.append(ends)
        resets += [row * width + at for at in ends if at < width]
        doc_ids.append([ids[document] for document, _, _ in sequence.pieces])
        starts.append([start for _, start, _ in sequence.pieces])
    values = [number, len(group), width, matrix.itemsize, matrix.tobytes(), cumulative, resets, doc_ids, starts]
    arrays = [pa.array([value], kind) for value, kind in zip(values, _KINDS.values())]
    return pa.RecordBatch.from_arrays(arrays, list(_KINDS))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """One row per sequence: its ids without padding, its segments, its width, padding and position resets."""
    row = F.col("row")
    at = F.col("row") * F.col("width") * F.col("id_bytes") + 1
    blocks = spark.read.schema(BLOCKS).parquet(path)
    rows = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("sequences") - 1)).alias("row"))
    lengths = F.element_at(F.get("cu_seqlens", row), -1)
    own = lambda x: (x >= F.col("row") * F.col("width")) & (x < (F.col("row") + 1) * F.col("width"))
    return rows.select(
        (F.col("first_sequence") + row).alias("sequence_id"),
        F.get("cu_seqlens", row).alias("cu_seqlens"),
        F.get("doc_ids", row).alias("doc_ids"),
        F.get("doc_starts", row).alias("doc_starts"),
        F.substring("ids", at, lengths * F.col("id_bytes")).alias("ids"),
        "id_bytes",
        "width",
        F.substring("ids", at + lengths * F.col("id_bytes"), (F.col("width") - lengths) * F.col("id_bytes")).alias("padding"),
        F.transform(F.filter("position_resets", own), lambda x: x - F.col("row") * F.col("width")).alias("position_resets"),
    )


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: document, place in it, place in its sequence, and ids as written."""
    ends = F.col("cu_seqlens")
    segment = F.col("segment")
    rows = read_sequences(spark, path).select("*", F.posexplode("doc_ids").alias("segment", "doc_id"))
    offset, length = F.get(ends, segment), F.get(ends, segment + 1) - F.get(ends, segment)
    return rows.select(
        "doc_id",
        F.get("doc_starts", segment).alias("start"),
        length.alias("length"),
        "sequence_id",
        offset.alias("offset"),
        F.substring("ids", offset * F.col("id_bytes") + 1, length * F.col("id_bytes")).alias("ids"),
    )
