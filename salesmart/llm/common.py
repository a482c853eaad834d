"""What the operators share: stored intermediate tables, row keys, words of a batch of texts.

``WHITE`` separates words everywhere in this folder; it is the ASCII white space
that ``bytes.split()`` uses, so that words need no regular expression.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.session import scan_bytes, shared_folder, size_shuffles

WHITE = b"\t\n\x0b\x0c\r "
SLICE_BYTES = 4 << 20

# Functions that run in tasks travel by value: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__package__])


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again, which cuts its lineage.

    What is read back survives the loss of executors, and is not computed anew
    by the steps that follow. Raises where a cluster names no shared folder.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    path = f"{folder}/llm/{name}-{uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def per_process(name: str, make):
    """What ``make`` returns, kept by the Python process for its next tasks.

    Functions travel by value, so that globals of this folder are new in each task.
    """
    kept = sys.__dict__.setdefault("_salesmart_kept", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Shuffles get more partitions if it is too large for the session's."""
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size_shuffles(spark, scan_bytes(found))
    return found


def id_key(doc_id: Column) -> Column:
    """A document's id as a join key: NULL counts as -1 (the text's hash tells them apart)."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(-1).cast("bigint"))


def text_key(text: Column) -> Column:
    """Tells rows of one doc_id apart. Rows alike in both get the same decisions."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """(first row, row count) of runs of rows whose text is about ``most`` bytes or one row."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    first, rows = 0, batch.num_rows
    while first < rows:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield first, last - first
        first = last


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each text begins (one more at the end)."""
    array = pa.compute.fill_null(array.cast(pa.large_string()), "")
    if array.offset:
        array = pa.concat_arrays([array])
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64, len(array) + 1)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True


class Words:
    """Words of some texts: their bounds in ``data``, and the text (row) of each.

    ``first[r]`` is the index of the first word of row ``r``; ``first[-1]`` is
    the number of all words.
    """

    def __init__(self, array: pa.Array) -> None:
        self.data, self.offsets = utf8(array)
        white = _IS_WHITE[self.data]
        n = len(white)
        cut = self.offsets[:-1]
        cut = cut[cut < n]
        before = np.ones(n + 1, bool)
        before[1:] = white
        before[cut] = True
        after = np.ones(n + 1, bool)
        after[:-1] = white
        after[cut] = True
        self.starts = np.flatnonzero(before[:-1] & ~white)
        self.ends = np.flatnonzero(after[1:] & ~white) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.row = np.repeat(np.arange(len(array)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int) -> np.ndarray:
        """A 64-bit hash of each word: two polynomials of random numbers for its bytes, mixed.

        They are taken modulo a prime. Modulo a power of two there are words, long ones of
        two letters, that meet whatever the numbers are.
        """
        if not len(self):
            return np.empty(0, np.uint64)
        random = np.random.Generator(np.random.PCG64(seed))
        longest = int((self.ends - self.starts).max())
        tables = []
        for _ in range(2):
            numbers = random.integers(1, _PRIME, 256, np.uint64)
            powers = prime_powers(int(random.integers(2**20, _PRIME - 1)), longest)
            tables.append((numbers, powers))
        out = np.empty(len(self), np.uint64)
        for first, last, heads, place, at in self._runs():
            bytes_ = self.data[at]
            # Below 2 to the 32 each, so that a word's sum has room for any length.
            halves = [
                np.add.reduceat(reduced(numbers[bytes_] * powers[place]), heads) % np.uint64(_PRIME)
                for numbers, powers in tables
            ]
            out[first:last] = mixed((halves[0] << np.uint64(32)) | halves[1])
        return out

    def _runs(self, most: int = 1 << 18):
        """Words in runs of about ``most`` bytes, so that little memory is used for each: first
        and last word, where each begins among the run's bytes, and of each byte its place in
        the word and in the data."""
        lengths = self.ends - self.starts
        upto, first = np.cumsum(lengths), 0
        while first < len(self):
            base = int(upto[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(upto, base + most, side="right")))
            own = lengths[first:last]
            heads = upto[first:last] - own - base
            place = np.arange(int(own.sum())) - np.repeat(heads, own)
            yield first, last, heads, place, place + np.repeat(self.starts[first:last], own)
            first = last

    def spaced(self) -> tuple[memoryview, np.ndarray]:
        """All words joined by one space each, and where each begins (one more at the end)."""
        lengths = self.ends - self.starts
        begins = np.zeros(len(self) + 1, np.int64)
        np.cumsum(lengths + 1, out=begins[1:])
        joined = np.full(int(begins[-1]), 32, np.uint8)
        for first, last, _, place, at in self._runs():
            joined[place + np.repeat(begins[first:last], lengths[first:last])] = self.data[at]
        return memoryview(joined), begins

    def text(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """Words of a row, joined by one space; ``keep`` is a mask over all words."""
        picked = np.arange(self.first[row], self.first[row + 1])
        if keep is not None:
            picked = picked[keep[picked]]
        data = self.data.tobytes() if len(self.offsets) == 2 else None
        if data is None:
            at, end = int(self.offsets[row]), int(self.offsets[row + 1])
            data, base = self.data[at:end].tobytes(), at
        else:
            base = 0
        bounds = zip(self.starts[picked] - base, self.ends[picked] - base)
        return b" ".join([data[a:b] for a, b in bounds])


# A Mersenne prime, whose remainders need no division.
_PRIME = (1 << 31) - 1


def reduced(x: np.ndarray) -> np.ndarray:
    """Remainders of numbers below 2 to the 62 modulo the prime, in part: below 2 to the 32."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(31))
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def prime_powers(base: int, count: int) -> np.ndarray:
    """1, base, base squared and so on modulo the prime, by doubling."""
    powers = np.ones(1, np.uint64)
    while len(powers) < count:
        step = np.uint64(pow(base, len(powers), _PRIME))
        powers = np.concatenate([powers, powers * step % np.uint64(_PRIME)])
    return powers[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """A published 64-bit finaliser (splitmix64), which spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of each ``size`` consecutive items, by doubling; ``len - size + 1`` of them."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    base = int(np.random.Generator(np.random.PCG64(seed)).integers(2**40, 2**62)) * 2 + 1
    power = lambda k: np.uint64(pow(base, k, 1 << 64))
    out, done, block, width = None, 0, hashes, 1
    while True:
        if size & width:
            part = block[: len(hashes) - size + 1] if out is None else block[done : done + len(out)]
            out = part.copy() if out is None else out + part * power(done)
            done += width
        if width * 2 > size:
            return mixed(out)
        block = block[: len(block) - width] + block[width:] * power(width)
        width *= 2


def batches(columns: dict[str, pa.Array | np.ndarray]) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
        list(columns),
    )
