"""Documents packed into sequences of at most ``window`` tokens.

Each document's ids, an end id added, are cut into full windows; what remains
is packed by best fit decreasing: longest first, each into the open sequence
with the least room that is enough. A segment tree over remaining room finds it.

Ids are computed where the text is read and only a few numbers per piece are
shuffled, evenly whatever their doc_id. A task packs the pieces it gets in groups of
``GROUP_PIECES`` to twice as many, one group after the other, so that a group's size
does not grow with the input, and a large input has up to ``TASK_GROUPS`` groups a
task; each group leaves at most a few sequences badly filled. No document shorter than a
window is cut, so a corpus of texts all a bit over half a window long would be
padded by nearly as much; all other corpora that we measured are padded by
below two percent.

Cases: NULL text is empty, and a document without text is its end id alone;
every row is a document of its own, repeated or not, with or without doc_id; of pieces of
one length the one of the smaller doc_id (NULL first), then start, comes first, so that a
task gives the same sequences in every run; very long texts are encoded one at a time; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored
from salesmart.llm.tokens import Encoder

WINDOW = 2048
END_ID = 1
GROUP_PIECES = 20_000
# Groups that one task packs where there are more groups than shuffle partitions.
TASK_GROUPS = 50
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_SEQUENCES = 1 << 32


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    ids: bool = False,
) -> DataFrame:
    """Full windows and the remainder of each document; ``ids`` adds the piece's ids.

    ``tokenizer`` and ``ranks`` are files, as ``tokens.Encoder`` takes them, at the
    same path on every machine.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer, ranks)
        end = np.array([end_id], "<u4").tobytes()
        for batch in found:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.encode(text.as_py() or "") + end
                total = len(data) // 4
                for start in range(0, total, window):
                    part = data[start * 4 : (start + window) * 4]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), total)
                    out.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if ids else row)
            columns = [pa.array(c, pa.int64()) for c in list(zip(*out))[:5]] or [
                pa.array([], pa.int64())
            ] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if ids:
                columns.append(pa.array([r[5] for r in out], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return narrow.mapInArrow(run, PIECE + (", ids array<int>" if ids else ""))


class OpenSequences:
    """Open sequences by remaining room, in a segment tree that counts them."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, sequence) of the tightest sequence with at least that room."""
        count, at = self.count, self.leaves + least
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        self._change(room, -1)
        return room, self.open[room].pop()

    def _change(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at >>= 1


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, sequences numbered from 0."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, opened = OpenSequences(window), 0
    order = np.argsort(-lengths, kind="stable")
    for at, length in zip(order.tolist(), lengths[order].tolist()):
        found = rooms.take(length) if length < window else None
        if found is None:
            found, opened = (window, opened), opened + 1
        room, number = found
        sequence[at], offset[at] = number, window - room
        if room > length:
            rooms.add(room - length, number)
    return sequence, offset


def in_groups(found: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """A task's rows in tables of ``most`` rows; the last has up to twice as many, or all."""
    held: list[pa.RecordBatch] = []
    for batch in found:
        held.append(batch)
        while sum(b.num_rows for b in held) >= 2 * most:
            table = pa.Table.from_batches(held).combine_chunks()
            yield table.slice(0, most).combine_chunks()
            held = table.slice(most).to_batches()
    held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence_id and its offset there (and its ids, if asked)."""
    cut = stored(pieces(docs, tokenizer, ranks, window, end_id, ids), "pieces")
    most = GROUP_PIECES
    groups = max(1, -(-cut.count() // most))
    at_once = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(groups, max(at_once, -(-groups // TASK_GROUPS)))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * _SEQUENCES
        for group in in_groups(found, most):
            sequence, offset = best_fit(group.column("length").to_numpy(), window)
            group = group.append_column("sequence_id", pa.array(first + sequence))
            yield from group.append_column("offset", pa.array(offset)).to_batches()
            first += int(sequence.max()) + 1

    schema = PIECE + (", ids array<int>" if ids else "") + ", sequence_id bigint, offset bigint"
    # Rows of a task come in the order in which blocks are fetched. Sorted, a task that is
    # run again packs them in the same way, and sequences that were read before still hold.
    dealt = cut.repartition(tasks).sortWithinPartitions("doc_id", "start", "ids_crc32", "doc_tokens")
    return dealt.mapInArrow(run, schema)
