"""Approximate nearest neighbours by cross-polytope hashing.

In each table a unit vector is rotated by three rounds of random signs and a fast
Hadamard transform, and falls into the bucket of its nearest signed axis. The
number of axes looked at grows with the number of rows, so that a bucket holds
about ``BUCKET_ROWS``; when one rotation's axes are too few, a second one's are
added. Rows are counted for each length of vector, so that a length of few rows has one
bucket. A query looks into the ``PROBES`` buckets whose axes are nearest to it in every
table. What it finds there is ranked by short codes, of 8 bits a component; ``CELL`` rows of
each bucket and of these the best ``RERANKED`` are compared with it by exact cosine of the
vectors. A query that finds fewer
rows than it is to return, though there are more, is compared with all of its length.

A bucket's rows and queries come one after another in a partition's stream, and only codes
are copied into the tables; whole vectors are joined to the pairs that are compared exactly.

Vectors that are equal are searched for once, and of equal rows only as many take
part as can be in one answer, cut down before the shuffle. Buckets beyond
``CHUNK_ROWS`` rows or ``CHUNK_QUERIES`` queries are split into a grid of chunks,
each compared by itself, so that nothing is left out and no task holds a whole
bucket. Per query and chunk only the best few are passed on.

Cases: vectors that are NULL, empty, zero or hold NULL or non-finite components
take no part, nor do rows without vec_id; vectors of different lengths never
meet; rows of the query's own vec_id are not candidates; ties go to the smaller
vec_id; repeated rows are one; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stored

TABLES = 16
PROBES = 4
BUCKET_ROWS = 512
CHUNK_ROWS = 8192
CHUNK_QUERIES = 2048
SEED = 17
# Candidates that a query takes from a chunk, and of all of them those whose vectors are
# compared with it; codes rank the others out. Both are several times what is returned.
CELL, RERANKED = 16, 96
# Power of the number of buckets by which probes grow once a second rotation is needed.
GROWTH = 0.75


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the length is a power of two."""
    width, count = rows.shape[1], len(rows)
    step = 1
    while step < width:
        rows = rows.reshape(count, -1, 2, step)
        rows = np.stack([rows[:, :, 0] + rows[:, :, 1], rows[:, :, 0] - rows[:, :, 1]], axis=2)
        rows = rows.reshape(count, width)
        step *= 2
    return rows


def rotated(units: np.ndarray, table: int, part: int) -> np.ndarray:
    """Pseudo-random rotation, the same for a table in every task."""
    width = 1 << max(0, units.shape[1] - 1).bit_length()
    random = np.random.Generator(np.random.PCG64([SEED, table, part, width]))
    out = np.zeros((len(units), width))
    out[:, : units.shape[1]] = units
    for _ in range(3):
        out = hadamard(out * random.choice([-1.0, 1.0], width)) / np.sqrt(width)
    return out


def parts_for(rows: int, dims: int) -> list[int]:
    """Axes looked at in each rotation, for buckets of about BUCKET_ROWS rows."""
    width, wanted, parts = 1 << max(0, dims - 1).bit_length(), rows / BUCKET_ROWS, []
    while wanted > 1.5:
        axes = min(width, 1 << max(0, round(np.log2(wanted / 2))))
        parts.append(axes)
        wanted /= 2 * axes
    return parts


def probes_for(rows: int, dims: int, probes: int) -> int:
    """More probes where a second rotation makes buckets finer: 2.8 times as many for
    four times the rows. With fewer, recall would fall as the number of rows grows."""
    width = 1 << max(0, dims - 1).bit_length()
    return int(np.ceil(probes * max(1.0, rows / (BUCKET_ROWS * 2 * width)) ** GROWTH))


def signed_axes(units: np.ndarray, table: int, part: int, axes: int) -> np.ndarray:
    """Nearness to each axis and its negative, axis by axis."""
    near = rotated(units, table, part)[:, :axes]
    return np.stack([near, -near], axis=2).reshape(len(units), 2 * axes)


def buckets(units: np.ndarray, table: int, parts: list[int], probes: int) -> np.ndarray:
    """The ``probes`` nearest buckets of each vector (fewer if there are fewer), nearest first."""
    found = np.zeros((len(units), 1), np.int64)
    score = np.zeros((len(units), 1))
    for part, axes in enumerate(parts):
        near = signed_axes(units, table, part, axes)
        best = np.argsort(-near, axis=1, kind="stable")[:, :probes]
        value = np.take_along_axis(near, best, axis=1)
        found = (found[:, :, None] * (2 * axes) + best[:, None, :]).reshape(len(units), -1)
        score = (score[:, :, None] + value[:, None, :]).reshape(len(units), -1)
        keep = np.argsort(-score, axis=1, kind="stable")[:, :probes]
        found = np.take_along_axis(found, keep, axis=1)
        score = np.take_along_axis(score, keep, axis=1)
    return found


def _matrices(batch: pa.RecordBatch):
    """(row numbers, matrix) for each length of vector in a batch."""
    lists = batch.column("embedding")
    lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, flat.astype(np.float64).reshape(len(rows), int(dims))


def codes_of(units: np.ndarray) -> list[bytes]:
    """Components of unit vectors in 8 bits, of the row's largest one."""
    most = np.abs(units).max(axis=1, keepdims=True)
    return [c.tobytes() for c in np.rint(units / most * 127).astype(np.int8)]


def with_buckets(
    vectors: DataFrame,
    rows: Mapping[int, int],
    tables: int,
    probes: int | None,
    keep: list[str],
    code: bool = False,
) -> DataFrame:
    """A row per vector, table and probe: dims, place (table), bucket and the columns ``keep``.

    ``rows`` has the number of rows for each length of vector that has more than one bucket.
    ``probes`` is None for the vectors of the index, which have one bucket each; ``code``
    adds each vector's code.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for at, matrix in _matrices(batch):
                units = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
                dims = matrix.shape[1]
                own = rows.get(dims, 1)
                parts = parts_for(own, dims)
                looked = probes_for(own, dims, probes) if probes else 1
                codes = pa.array(codes_of(units), pa.binary()) if code else None
                # One bucket is one table, too.
                for place in range(tables if parts else 1):
                    got = buckets(units, place, parts, looked)
                    each = np.repeat(np.arange(len(at)), got.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(got.size, dims, np.int32)),
                            pa.array(np.full(got.size, place, np.int32)),
                            pa.array(got.ravel()),
                            *(batch.column(c).take(pa.array(at[each])) for c in keep),
                            *([codes.take(pa.array(each))] if code else []),
                        ],
                        ["dims", "place", "bucket", *keep, *(["code"] if code else [])],
                    )

    kinds = dict(vectors.dtypes)
    schema = "dims int, place int, bucket bigint" + "".join(f", {c} {kinds[c]}" for c in keep)
    return vectors.mapInArrow(run, schema + (", code binary" if code else ""))


def valid(embedding: Column) -> Column:
    fine = F.forall(
        embedding,
        lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)),
    )
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _nearest_codes(rows: dict[str, list], asked: dict[str, list], best: int):
    """(h1, h2 of the query, near, id, h1, h2 of the row) of the ``best`` rows of each query by codes."""
    dims = len(rows["code"][0])

    def units(codes: list[bytes]) -> np.ndarray:
        made = np.frombuffer(b"".join(codes), np.int8).reshape(-1, dims).astype(np.float32)
        return made / np.sqrt((made * made).sum(axis=1, keepdims=True))

    own, queries = units(rows["code"]).T, units(asked["code"])
    for k in range(0, len(queries), 256):
        near = queries[k : k + 256] @ own
        if near.shape[1] > best:
            picked = np.argpartition(near, -best, axis=1)[:, -best:]
        else:
            picked = np.broadcast_to(np.arange(near.shape[1]), near.shape)
        q, r = np.repeat(np.arange(k, k + len(near)), picked.shape[1]), picked.ravel()
        take = lambda side, c, at: np.array(side[c], np.int64)[at]
        yield {
            "h1": take(asked, "h1", q), "h2": take(asked, "h2", q),
            "near": np.take_along_axis(near, picked, axis=1).ravel(), "id": take(rows, "id", r), "r1": take(rows, "h1", r), "r2": take(rows, "h2", r),
        }


def candidates(best: int):
    """Pairs from a stream in which each chunk's rows come before its queries."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, own = None, [], {}
        for batch in found:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dims", "place", "bucket", "r", "q"))))
            query = batch.column("is_query").to_pylist()
            first = 0
            while first < batch.num_rows:
                last = first
                while last < batch.num_rows and keys[last] == keys[first] and query[last] == query[first]:
                    last += 1
                part = batch.slice(first, last - first)
                if keys[first] != cell:
                    cell, rows, own = keys[first], [], {}
                if not query[first]:
                    rows.append(part)
                elif rows or own:
                    if rows:
                        own, rows = pa.Table.from_batches(rows).to_pydict(), []
                    for pairs in _nearest_codes(own, part.to_pydict(), best):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in pairs.values()], list(pairs))
                first = last

    return run


def exact_cosines(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs of vectors, ``a`` and ``b``, in double precision."""
    for batch in found:
        scores = np.empty(batch.num_rows)
        lengths = pa.compute.list_value_length(batch.column("a")).to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths):
            at = np.flatnonzero(lengths == dims)
            a, b = (
                batch.column(c).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                for c in "ab"
            )
            # Scaled first, so that no square is beyond the range of a double.
            a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
            norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
            scores[at] = (a * b).sum(axis=1) / norms
        columns = [batch.column(c) for c in ("h1", "h2", "id")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], ["h1", "h2", "vec_id", "score"])


def _found(
    index: DataFrame, asking: DataFrame, counts: Mapping[int, int], k: int, tables: int, probes: int
) -> DataFrame:
    """h1, h2, vec_id and score of the ``k + 1`` nearest found of each query."""
    cells = ["dims", "place", "bucket"]
    sizes = with_buckets(index, counts, tables, None, []).groupBy(cells).agg(F.count("*").alias("r"))
    asked = with_buckets(asking, counts, tables, probes, []).groupBy(cells)
    asked = asked.agg(F.count("*").alias("q"))
    grid = sizes.join(asked, cells).select(
        *cells,
        F.ceil(F.col("r") / CHUNK_ROWS).cast("int").alias("row_chunks"),
        F.ceil(F.col("q") / CHUNK_QUERIES).cast("int").alias("query_chunks"),
    )
    # Buckets that no query looks into are left out by the join.
    grid = stored(grid, "grid")
    keep = ["id", "h1", "h2"]

    def dealt(frame: DataFrame, probed: int | None, own: str, other: str, query: bool) -> DataFrame:
        joined = with_buckets(frame, counts, tables, probed, keep, code=True).join(grid, cells)
        mine = F.pmod(F.xxhash64("id", "h1"), F.col(own)).cast("int").alias(own[0])
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])
        return joined.select(*cells, *keep, "code", F.lit(query).alias("is_query"), mine, every)

    both = dealt(index, None, "row_chunks", "query_chunks", False).unionByName(
        dealt(asking, probes, "query_chunks", "row_chunks", True)
    )
    chunk = [*cells, "r", "q"]
    both = both.repartition(*chunk).sortWithinPartitions(*chunk, "is_query")
    pairs = both.mapInArrow(
        candidates(max(CELL, 3 * (k + 1))),
        "h1 bigint, h2 bigint, near float, id bigint, r1 bigint, r2 bigint",
    )
    # The same row of several tables, and then the best rows of all tables.
    pairs = pairs.groupBy("h1", "h2", "id", "r1", "r2").agg(F.max("near").alias("near"))
    nearest = Window.partitionBy("h1", "h2").orderBy(F.desc("near"), "id", "r1")
    pairs = pairs.withColumn("n", F.row_number().over(nearest))
    pairs = pairs.where(F.col("n") <= max(RERANKED, 16 * (k + 1)))
    queries = asking.select("h1", "h2", F.col("embedding").alias("a"))
    vectors = index.select("id", F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("embedding").alias("b"))
    both = pairs.join(vectors, ["id", "r1", "r2"]).join(queries, ["h1", "h2"])
    scored = both.select("h1", "h2", "id", "a", "b").mapInArrow(
        exact_cosines, "h1 bigint, h2 bigint, vec_id bigint, score double"
    )
    # Rows of one id are one candidate, the nearest of them.
    scored = scored.groupBy("h1", "h2", "vec_id").agg(F.max("score").alias("score"))
    top = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.asc("vec_id"))
    return scored.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).drop("n")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found of each query."""
    hashes = [F.xxhash64("embedding"), F.xxhash64(F.lit(1), "embedding")]
    rows = vectors.where(valid(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"),
        "embedding",
        hashes[0].alias("h1"),
        hashes[1].alias("h2"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    # Of equal vectors an answer holds k at most, and the query itself may be among them.
    alike = Window.partitionBy("h1", "h2").orderBy("id")
    index = rows.withColumn("n", F.dense_rank().over(alike)).where(F.col("n") <= k + 1)
    index = stored(index.select("id", "embedding", "h1", "h2").dropDuplicates(["id", "h1", "h2"]), "vectors")
    dims = F.size("embedding").alias("dims")
    per_length = index.groupBy(dims).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))
    per_length = stored(per_length, "lengths")
    # Lengths that have several buckets; each has some hundreds of rows at least.
    counts = {r.dims: r.n for r in per_length.where(F.col("n") > 1.5 * BUCKET_ROWS).collect()}
    asking = rows.where("asks").select("id", "h1", "h2", "embedding")
    one = Window.partitionBy("h1", "h2").orderBy("id")
    different = asking.withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    different = stored(different, "queries")

    found = stored(_found(index, different, counts, k, tables, probes), "found")
    # Of k + 1 rows one may be the query itself, so that fewer may be too few to answer.
    got = found.groupBy("h1", "h2").agg(F.count("*").alias("got"))
    wanted = different.withColumn("dims", F.size("embedding")).join(per_length, "dims")
    short = wanted.join(got, ["h1", "h2"], "left").where(
        F.coalesce("got", F.lit(0)) < F.least(F.col("ids"), F.lit(k + 1))
    )
    short = stored(short.select(*different.columns), "short")
    if not short.isEmpty():
        again = _found(index, short, {}, k, 1, 1)
        rest = found.join(short.select("h1", "h2"), ["h1", "h2"], "left_anti")
        found = rest.unionByName(again)
    order = [F.desc("score"), F.asc("vec_id")]
    ids = asking.select(F.col("id").alias("query_id"), "h1", "h2").distinct()
    pairs = ids.join(found, ["h1", "h2"]).where("vec_id != query_id")
    own = Window.partitionBy("query_id", "h1", "h2").orderBy(*order)
    ranked = pairs.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
