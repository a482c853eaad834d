"""SimHash near-duplicates: fingerprints, found pairwise by a vantage-point tree.

A fingerprint's bit is 1 if it is set in over half of the hashes of the text's
shingles. Equal fingerprints are one point. Points are dealt to shards by the
upper part of a vantage-point tree: at each node a point goes inside if its
Hamming distance to the vantage point is at most the radius, else outside, and
the triangle inequality tells which points near the boundary must be shown to
the other side as well. Within a shard the tree goes on, down to blocks small
enough to compare directly, so all pairs within the distance are found.

A shard that has more than ``MOST_POINTS`` is cut into chunks, by a hash of its points, and
every pair of chunks is searched by itself, so that no task holds more than two chunks
however unequal the shards are.

Each search returns a forest instead of all its links: as many rows as points at
most, with the same connected components.

Cases: NULL text counts as empty; a text without words has fingerprint 0 and
links like any other; NULL doc_ids take part but never name a component (its id
is NULL if it has no other); repeated rows are one point; a text's bits that are set in
exactly half of its hashes are 0; very long texts are hashed a part at a time; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import id_key, stored, text_key
from salesmart.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SHINGLES_AT_ONCE = 1 << 16
# Points for the tree's upper part; at 8 bytes each the driver holds 1 MB.
SAMPLE = 1 << 17
SHARD_POINTS = 20_000
# Points of a shard that are searched at once, and of each chunk of a larger one. Shards
# differ in size, and most stay below some times the points that they are made for.
MOST_POINTS = 4 * SHARD_POINTS
BLOCK = 2048
# Points compared at once; their distances fit into a processor cache.
TILE = (32, 2048)
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """SimHash of a text in UTF-8; its shingles are hashed with XXH64."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined, size = b" ".join(parts), min(words, len(parts))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - size + 1]
    ends = ends[size - 1 :]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = zip(
            starts[k : k + SHINGLES_AT_ONCE].tolist(), ends[k : k + SHINGLES_AT_ONCE].tolist()
        )
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(packed.view("<u8")[0])


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, k and th (the row's key), fingerprint as a signed 64-bit number."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = batch.column("text")
            prints = np.fromiter(
                (fingerprint((t.as_py() or "").encode(), words) for t in texts), np.uint64, len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "k", "th")] + [pa.array(prints.view(np.int64))],
                ["doc_id", "k", "th", "fingerprint"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        id_key(F.col("doc_id")).alias("k"),
        text_key(F.col("text")).alias("th"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(run, "doc_id bigint, k bigint, th bigint, fingerprint bigint")


def distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def choose_split(points: np.ndarray, bits: int) -> tuple[np.uint64, int] | None:
    """Vantage point and radius with the fewest points near the boundary.

    At least an eighth of the points is on either side. None if no vantage point
    that was tried separates the points.
    """
    best = None
    for vantage in points[np.linspace(0, len(points) - 1, 8).astype(int)]:
        counts = np.bincount(distance(points, vantage), minlength=66 + bits)
        below = np.cumsum(counts)
        for radius in range(64):
            inside = below[radius]
            if min(inside, len(points) - inside) * 8 < len(points):
                continue
            near = below[radius + bits] - (below[radius - bits] if radius >= bits else 0)
            cost = near + abs(2 * inside - len(points)) / 8
            if best is None or cost < best[0]:
                best = (cost, vantage, radius)
    return best and best[1:]


def build_tree(sample: np.ndarray, leaf: int, bits: int) -> list[tuple]:
    """Nodes (vantage, radius, inside, outside); a leaf is (None, shard number)."""
    nodes: list[tuple] = []

    def grow(points: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(())
        split = choose_split(points, bits) if len(points) > leaf else None
        if split is None:
            nodes[at] = (None, at)
        else:
            near = distance(points, split[0]) <= split[1]
            nodes[at] = (*split, grow(points[near]), grow(points[~near]))
        return at

    grow(sample)
    return nodes


def parts_of(points: np.ndarray, home: np.ndarray, vantage, radius: int, bits: int):
    """(selection, which of it is at home) inside and outside.

    Of two linked points on different sides the outer one is shown inside. A
    point that is only shown goes to every side where a link of it may be.
    """
    away = distance(points, vantage).astype(np.int64)
    inner = home & (away <= radius)
    inside = inner | (away <= radius + bits)
    outer = home & (away > radius)
    outside = outer | (~home & (away > radius - bits))
    return (inside, inner[inside]), (outside, outer[outside])


def route(points: np.ndarray, nodes: list[tuple], bits: int):
    """(shard, points, which of them are at home) for every shard that gets any."""
    todo = [(0, points, np.ones(len(points), bool))]
    while todo:
        at, these, home = todo.pop()
        if not len(these):
            continue
        if nodes[at][0] is None:
            yield nodes[at][1], these, home
            continue
        vantage, radius, *children = nodes[at]
        for child, (picked, own) in zip(children, parts_of(these, home, vantage, radius, bits)):
            todo.append((child, these[picked], own))


def linked_blocks(points: np.ndarray, home: np.ndarray, bits: int):
    """Index pairs of points within ``bits``; each pair has a point at home.

    A node is split as long as that saves a fifth of the comparisons at least.
    """
    todo = [(np.arange(len(points)), home)]
    while todo:
        at, own = todo.pop()
        mine = np.flatnonzero(own)
        if not len(mine):
            continue
        these = points[at]
        split = choose_split(these, bits) if len(at) > BLOCK else None
        if split:
            parts = parts_of(these, own, *split, bits)
            if sum(len(o) * o.sum() for _, o in parts) < 0.8 * len(at) * len(mine):
                todo += [(at[picked], own) for picked, own in parts]
                continue
        for k in range(0, len(mine), TILE[0]):
            left = mine[k : k + TILE[0]]
            for j in range(0, len(at), TILE[1]):
                right = these[j : j + TILE[1]]
                near = np.bitwise_count(these[left][:, None] ^ right[None, :]) <= bits
                a, b = np.nonzero(near)
                a, b = at[left[a]], at[j + b]
                yield a[a != b], b[a != b]


def forest(count: int, pairs) -> np.ndarray:
    """For each of ``count`` items the smallest item of its component."""
    root, some, size = np.arange(count), [], 0

    def join() -> None:
        nonlocal root
        a, b = (np.concatenate(x) for x in zip(*some))
        while len(a):
            ra, rb = root[a], root[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (up := root[root]).tobytes() != root.tobytes():
                root = up

    for pair in pairs:
        if len(pair[0]):
            some.append(pair)
            size += len(pair[0])
        if size > PAIRS_AT_ONCE:
            join()
            some, size = [], 0
    if some:
        join()
    return root


def near_links(prints: DataFrame, bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) that join all fingerprints within ``bits`` of each other.

    ``prints`` holds each fingerprint once (column ``fingerprint``). The tree's
    upper part is fitted on at most ``SAMPLE`` fingerprints, those with the
    smallest hash; every fingerprint is then dealt to its shards.
    """
    points = prints.count()
    shards = max(1, points // shard_points)
    drawn = prints.select("fingerprint", F.xxhash64("fingerprint").alias("h"))
    share = min(1.0, SAMPLE / 2 / max(1, points))
    drawn = drawn.where(F.col("h") <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
    sample = drawn.orderBy("h").limit(SAMPLE).toPandas()["fingerprint"].to_numpy(np.int64)
    nodes = build_tree(sample.view(np.uint64), max(8, len(sample) // shards), bits)

    def deal(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            these = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for shard, part, home in route(these, nodes, bits):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), shard, np.int64)),
                        pa.array(part.view(np.int64)),
                        pa.array(home),
                    ],
                    ["shard", "fingerprint", "home"],
                )

    def search(cell):
        these = cell.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64)
        home = cell.column("home").to_numpy()
        order = np.argsort(these)
        these, home = these[order], home[order]
        root = forest(len(these), linked_blocks(these, home, bits))
        child = np.flatnonzero(root != np.arange(len(these)))
        return pa.table({"a": these[child].view(np.int64), "b": these[root[child]].view(np.int64)})

    dealt = prints.select("fingerprint").mapInArrow(
        deal, "shard bigint, fingerprint bigint, home boolean"
    )
    dealt = stored(dealt, "dealt")
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / MOST_POINTS).cast("int").alias("chunks"))
    # A row per leaf of the tree, which is fitted on a bounded sample.
    cut = dealt.join(F.broadcast(stored(sizes, "shards")), "shard")
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    pairs = cut.select("shard", "fingerprint", "home", mine.alias("mine"), other)
    cells = pairs.select(
        "shard",
        F.least("mine", "other").alias("one"),
        F.greatest("mine", "other").alias("two"),
        "fingerprint",
        "home",
    )
    return cells.groupBy("shard", "one", "two").applyInArrow(search, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: doc_id, k, th, fingerprint (16 hex digits), component_id, root.

    ``root`` tells components apart even where rows share a doc_id.
    """
    prints = stored(with_fingerprints(docs, words), "fingerprints")
    points = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    points = stored(points, "points")
    roots = components(near_links(points, bits))
    named = points.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.select("fingerprint", "root").join(least, "root")
    return prints.join(ids, "fingerprint").select(
        "doc_id",
        "k",
        "th",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest
    doc_id stays (NULL last; of rows alike in doc_id the one with the smallest
    text hash, of repeated rows one)."""
    found = near_duplicates(docs, words, bits)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "k", "th")
    kept = found.groupBy("root").agg(F.min(order).alias("first"))
    kept = kept.select(F.col("first.k").alias("_llm_k"), F.col("first.th").alias("_llm_th"))
    keyed = docs.withColumn("_llm_k", id_key(F.col("doc_id")))
    keyed = keyed.withColumn("_llm_th", text_key(F.col("text")))
    one = Window.partitionBy("_llm_k", "_llm_th").orderBy(F.lit(0))
    return (
        keyed.join(kept, ["_llm_k", "_llm_th"])
        .withColumn("_llm_row", F.row_number().over(one))
        .where("_llm_row = 1")
        .drop("_llm_k", "_llm_th", "_llm_row")
    )
