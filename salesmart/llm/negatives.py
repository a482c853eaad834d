"""Hard negatives: for each anchor and each of its nearest rows of the same label, the best
rows of other labels that score a stated share of it.

Vectors become whole numbers, ``floor(SCALE * x)``, and a score is their inner product, so
that all comparisons are exact. Scores are computed in blocks: the rows are dealt over blocks
of at most ``BLOCK_ROWS``, the anchors (a stated set of queries) pass through every block,
and a block keeps what can be among the answers:

1. each block's nearest rows of the anchor's label, of which the ``positives`` nearest of all
   are the anchor's positives. Each opens a window of scores from ``LOW`` to ``HIGH``
   hundredths of its own;
2. each block's first ``negatives`` rows of other labels in each of the anchor's windows.

Scores of positives and of these negatives are packed into keys (anchor, descending score,
positive before negative, id) whose bytes sort in that order, dealt by anchor and sorted
within partitions. One pass over the sorted keys opens a window at each positive and gives
the negatives that fall into open ones; it holds the open windows of one anchor. Nothing is
lost: the first rows of a window are among the first of their own blocks.

Rows with a NULL id, label or vector, or a NULL, NaN or infinite component, take no part.
Rows of one ``vec_id`` count once: the one of least label, then least encoded vector. Only
vectors of equal length are compared; empty ones score 0. Products and components beyond 64
bits are taken as the largest number of that sign. Ties go to the smaller id. A positive of
negative score has an empty window. An empty table, or one without anchors, gives no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
# A block has at most so many rows, and fewer while there are less blocks than shuffle
# partitions, but not below the second number.
BLOCK_ROWS, LEAST_ROWS = 65_536, 4_096
TILE_SCORES = 1 << 21
EXACT = 2**53
_LARGEST = 2**63 - 1

_CODES = "vec_id bigint, label bigint, dim int, width int, code binary"
_SCORED = "anchor_id bigint, score bigint, vec_id bigint"
_FOUND = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint,"
    " negative_score bigint"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector as whole numbers of two bytes, or of eight where they are larger."""
    for batch in batches:
        lists = batch.column("embedding")
        lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        whole = np.floor(values * SCALE)
        ends = np.cumsum(lengths)
        codes, widths = [], []
        for end, n in zip(ends, lengths):
            x = whole[end - n : end]
            most = np.abs(x).max(initial=0)
            if most < 2**63:
                x = x.astype(np.int16 if most < 2**15 else np.int64)
            else:
                x = np.array([max(-_LARGEST, min(_LARGEST, int(v))) for v in x], np.int64)
            codes.append(x.tobytes())
            widths.append(x.itemsize)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                batch.column("label"),
                pa.array(lengths, pa.int32()),
                pa.array(widths, pa.int32()),
                pa.array(codes, pa.binary()),
            ],
            ["vec_id", "label", "dim", "width", "code"],
        )


def encoded(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("embedding").cast("array<double>")
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = given.mapInArrow(_encode, _CODES)
    one = F.min(F.struct("label", "dim", "width", "code")).alias("row")
    return rows.groupBy("vec_id").agg(one).select("vec_id", "row.*")


class Block:
    """Rows of one length, by label and id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, codes: np.ndarray) -> None:
        order = np.lexsort((ids, labels))
        self.ids, self.codes, self.labels = ids[order], codes[order], labels[order]
        self.most = largest(codes)

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, (label, label + 1)))


def largest(codes: np.ndarray) -> int:
    return max(int(codes.max(initial=0)), -int(codes.min(initial=0)))


def products(block: Block, anchors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number of an anchor, its exact scores), anchors taken so many at a time as fit a tile."""
    bound = max(block.most, 1) * max(largest(anchors), 1) * max(anchors.shape[1], 1)
    kind = np.float64 if bound < EXACT else np.int64 if bound <= _LARGEST else object
    step = max(1, TILE_SCORES // max(1, len(block.ids)))
    rows = block.codes.astype(kind).T
    for first in range(0, len(anchors), step):
        tile = anchors[first : first + step].astype(kind) @ rows
        if kind is object:
            tile = np.array([[max(-_LARGEST, min(_LARGEST, int(x))) for x in line] for line in tile])
        for i, scores in enumerate(tile.astype(np.int64)):
            yield first + i, scores


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by descending score, then id."""
    n = len(scores)
    near = np.flatnonzero(scores >= np.partition(scores, n - k)[n - k]) if n > k else np.arange(n)
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def window(score: int) -> tuple[int, int]:
    """Whole numbers n with LOW * score <= 100 * n <= HIGH * score."""
    return -(-LOW * score // 100), HIGH * score // 100


def _matrix(codes: list[bytes], widths: list[int], dim: int) -> np.ndarray:
    if all(w == 2 for w in widths):
        return np.frombuffer(b"".join(codes), np.int16).reshape(len(codes), dim)
    kinds = {2: np.int16, 8: np.int64}
    return np.array([np.frombuffer(c, kinds[w]) for c, w in zip(codes, widths)], np.int64).reshape(len(codes), dim)


def _by_length(rows: dict[str, list]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.array(rows["dim"], np.int64)
    for dim in np.unique(lengths):
        yield int(dim), np.flatnonzero(lengths == dim)


def _blocks(answers):
    """What ``answers`` gives for every anchor in the blocks of a partition, as batches.

    Rows come by block, its own rows before the anchors that pass through it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, own, made = None, [], {}
        for batch in batches:
            keys = list(zip(batch.column("block").to_pylist(), batch.column("is_anchor").to_pylist()))
            first = 0
            while first < len(keys):
                last = first
                while last < len(keys) and keys[last] == keys[first]:
                    last += 1
                (block, is_anchor), part = keys[first], batch.slice(first, last - first)
                first = last
                if block != number:
                    number, own, made = block, [], {}
                if not is_anchor:
                    own.append(part)
                    continue
                if own:
                    rows = pa.Table.from_batches(own).to_pydict()
                    made, own = dict(_made(rows)), []
                rows = part.to_pydict()
                for dim, places in _by_length(rows):
                    if dim in made:
                        yield from answers(made[dim], rows, places)

    return run


def _made(rows: dict[str, list]) -> Iterator[tuple[int, Block]]:
    for dim, places in _by_length(rows):
        pick = lambda c: [rows[c][i] for i in places]
        codes = _matrix(pick("code"), pick("width"), dim)
        yield dim, Block(np.array(pick("vec_id"), np.int64), np.array(pick("label"), np.int64), codes)


def _anchor_codes(rows: dict[str, list], places: np.ndarray) -> np.ndarray:
    pick = lambda c: [rows[c][i] for i in places]
    return _matrix(pick("code"), pick("width"), rows["dim"][places[0]])


def _nearest(k: int):
    def answers(block: Block, rows: dict[str, list], places: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchors, found, ids = [], [], []
        for i, scores in products(block, _anchor_codes(rows, places)):
            anchor, label = rows["vec_id"][places[i]], rows["label"][places[i]]
            same = block.of_label(label)
            others = block.ids[same] != anchor
            near, near_ids = scores[same][others], block.ids[same][others]
            best = first_of(near, near_ids, k)
            anchors.append(np.full(len(best), anchor, np.int64))
            found.append(near[best])
            ids.append(near_ids[best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (anchors, found, ids)], ["anchor_id", "score", "vec_id"]
        )

    return answers


_SIGN = np.uint64(1 << 63)


def packed(anchors: np.ndarray, scores: np.ndarray, negative: bool, ids: np.ndarray) -> pa.Array:
    """Keys whose bytes sort by anchor, descending score, positives first, id."""
    keys = np.empty(len(ids), np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")]))
    keys["anchor"] = anchors.astype(np.int64).view(np.uint64) ^ _SIGN
    keys["score"] = ~(scores.astype(np.int64).view(np.uint64) ^ _SIGN)
    keys["kind"] = negative
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ _SIGN
    width = keys.dtype.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def unpacked(keys: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    kinds = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
    rows = np.frombuffer(b"".join(keys.to_pylist()), kinds)
    whole = lambda x: (x.astype(np.uint64) ^ _SIGN).view(np.int64).tolist()
    return zip(whole(rows["anchor"]), whole(~rows["score"].astype(np.uint64)), rows["kind"].tolist(), whole(rows["id"]))


def _in_windows(k: int):
    def answers(block: Block, rows: dict[str, list], places: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchors, found, ids = [], [], []
        for i, scores in products(block, _anchor_codes(rows, places)):
            label, positive = rows["label"][places[i]], rows["scores"][places[i]]
            same = block.of_label(label)
            other = np.concatenate([scores[: same.start], scores[same.stop :]])
            other_ids = np.concatenate([block.ids[: same.start], block.ids[same.stop :]])
            kept = set()
            for score in set(positive):
                low, high = window(score)
                inside = np.flatnonzero((other >= low) & (other <= high))
                kept.update(inside[first_of(other[inside], other_ids[inside], k)].tolist())
            chosen = np.fromiter(kept, np.int64, len(kept))
            anchors.append(np.full(len(chosen), rows["vec_id"][places[i]], np.int64))
            found.append(other[chosen])
            ids.append(other_ids[chosen])
        yield pa.RecordBatch.from_arrays([packed(np.concatenate(anchors), np.concatenate(found), True, np.concatenate(ids))], ["key"])

    return answers


def _pack_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("anchor_id", "score", "vec_id")]
        yield pa.RecordBatch.from_arrays([packed(columns[0], columns[1], False, columns[2])], ["key"])


def _open_windows(k: int, positives: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows, opened = None, [], 0
        for batch in batches:
            out = []
            for key_anchor, score, kind, row in unpacked(batch.column("key")):
                if key_anchor != anchor:
                    anchor, windows, opened = key_anchor, [], 0
                if kind == 0:
                    if opened < positives:
                        windows.append([row, score, *window(score), 0])
                        opened += 1
                    continue
                # Scores only fall: a window below which we are, or that is full, is over.
                windows = [w for w in windows if score >= w[2] and w[4] < k]
                for w in windows:
                    if score <= w[3]:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], row, w[1], score))
            columns = list(zip(*out)) or [()] * 6
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            kinds = [pa.int32() if n == "rank" else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    rows = stored(encoded(vectors), "negatives-codes")
    count = rows.count()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-count // BLOCK_ROWS), min(wide, -(-count // LEAST_ROWS)), 1)
    own = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    own = own.withColumn("is_anchor", F.lit(False))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    anchors = rows.where(is_anchor)

    def through_blocks(passing: DataFrame) -> DataFrame:
        passing = passing.select("*", each).withColumn("is_anchor", F.lit(True))
        both = own.unionByName(passing, allowMissingColumns=True)
        return both.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "is_anchor")

    near = through_blocks(anchors).mapInArrow(_blocks(_nearest(positives)), _SCORED)
    listed = F.collect_list(F.struct((-F.col("score")).alias("below"), "vec_id"))
    nearest = near.groupBy("anchor_id").agg(F.slice(F.array_sort(listed), 1, positives).alias("found"))
    nearest = stored(nearest, "negatives-positives")

    scores = F.transform("found", lambda x: -x["below"]).alias("scores")
    opening = anchors.join(nearest.select(F.col("anchor_id").alias("vec_id"), scores), "vec_id")
    keys = through_blocks(opening).mapInArrow(_blocks(_in_windows(negatives)), "key binary")
    first = nearest.select("anchor_id", F.explode("found").alias("f"))
    first = first.select("anchor_id", (-F.col("f.below")).alias("score"), "f.vec_id")
    keys = keys.unionByName(first.mapInArrow(_pack_positives, "key binary"))
    dealt = keys.repartition(F.substring("key", 1, 8)).sortWithinPartitions("key")
    return dealt.mapInArrow(_open_windows(negatives, positives), _FOUND)
