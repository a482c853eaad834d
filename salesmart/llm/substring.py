"""Long passages that occur more than once, removed wherever they occur.

The windows of ``size`` consecutive words are the edges of a De Bruijn graph
whose nodes are the windows of one word less. It is built and compacted as in
published assemblers of genomes: each edge belongs to its minimizer, the least
hashed shorter window in it, and consecutive edges of a document with the same
minimizer form a path, which is one row, a tenth of the words. Equal windows have
equal minimizers, so Spark joins on the minimizer alone bring together all that
may be equal:

* a minimizer that occurs once belongs to edges that occur once; it is dropped;
* a path whose hash occurs twice or more has only repeated edges: it does not
  branch, and its rows stay as spans in the coordinates of their documents;
* the other paths of a shared minimizer may branch off each other; only these
  are cut into single edges again, one document for each different path, which
  are looked up in the documents at the paths' coordinates, compared within the
  minimizer, and joined back.

Hashes of words only choose minimizers, so that words that share one cost time and no more.
What is repeated is decided by the words that stand at the coordinates: paths and edges are
compared by 128 bits of a cryptographic digest of their words, taken where the text is read.

The spans are then joined to the documents and removed from their texts.

Cases: NULL text has no words; texts shorter than a window lose nothing; repeated
rows are occurrences of their own and lose everything a window covers; NULL
doc_ids are documents like others; an empty table gives no rows; very long texts
are handled one at a time; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import Words, id_key, stored, text_key, text_slices, windows

WINDOW = 35
MINIMIZER = 12
_PATH = "k bigint, th bigint, start bigint, edges int, minimizer bigint, path bigint, path2 bigint"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least of each ``width`` consecutive values, by doubling."""
    best, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[right] < values[left], right, left)
        span += step
    return best


def digests(words: Words, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128 bits, as two columns, of the words of each span."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    text, begins = words.spaced()
    ends = begins[starts + lengths] - 1
    digest = lambda a, b: blake2b(text[a:b], digest_size=16).digest()
    found = b"".join(map(digest, begins[starts].tolist(), ends.tolist()))
    return np.frombuffer(found, np.int64).reshape(-1, 2)


_WORD_SEED, _MINIMIZER_SEED = 101, 103


def paths_of(words: Words, size: int, short: int) -> dict[str, np.ndarray]:
    """Paths of all rows: row, start (word in the row), edges, minimizer, path (digest)."""
    hashes = words.hashes(_WORD_SEED)
    count = len(hashes) - size + 1
    if count <= 0:
        empty = np.empty(0, np.int64)
        return dict.fromkeys(("row", "start", "edges", "minimizer", "path", "path2"), empty)
    small = windows(hashes, short, _MINIMIZER_SEED)
    least = sliding_least(small, size - short + 1)
    at = np.flatnonzero(words.row[:count] == words.row[size - 1 :])
    first = np.ones(len(at), bool)
    first[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    heads = np.flatnonzero(first)
    edges = np.diff(np.append(heads, len(at)))
    starts = at[heads]
    path = digests(words, starts, edges + size - 1)
    row = words.row[starts]
    return dict(
        row=row,
        start=starts - words.first[row],
        edges=edges,
        minimizer=small[least[starts]].view(np.int64),
        path=path[:, 0],
        path2=path[:, 1],
    )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        id_key(F.col("doc_id")).alias("k"),
        text_key(F.col("text")).alias("th"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def paths(docs: DataFrame, size: int = WINDOW, short: int = MINIMIZER) -> DataFrame:
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for first, count in text_slices(batch):
                part = batch.slice(first, count)
                got = paths_of(Words(part.column("text")), size, short)
                row = pa.array(got["row"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k").take(row),
                        part.column("th").take(row),
                        pa.array(got["start"]),
                        pa.array(got["edges"].astype(np.int32)),
                        pa.array(got["minimizer"]),
                        pa.array(got["path"]),
                        pa.array(got["path2"]),
                    ],
                    ["k", "th", "start", "edges", "minimizer", "path", "path2"],
                )

    return _rows(docs).mapInArrow(run, _PATH)


def _edges(texts: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """Single edges (k, th, at, minimizer, edge, again) of the paths asked for, by document."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for first, count in text_slices(batch):
                part = batch.slice(first, count)
                words = Words(part.column("text"))
                lists = part.column("asked")
                flat = lists.flatten()
                owner = np.repeat(np.arange(count), pa.compute.list_value_length(lists).to_numpy())
                field = lambda name: flat.field(name).to_numpy(zero_copy_only=False)
                edges = field("edges").astype(np.int64)
                each = np.repeat(np.arange(len(edges)), edges)
                inner = np.arange(len(each)) - np.repeat(np.cumsum(edges) - edges, edges)
                at = field("start")[each] + inner
                row = pa.array(owner[each])
                first_word = words.first[owner[each]] + at
                edge = digests(words, first_word, np.full(len(at), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("k").take(row),
                        part.column("th").take(row),
                        pa.array(at),
                        pa.array(field("minimizer")[each]),
                        pa.array(edge[:, 0]),
                        pa.array(edge[:, 1]),
                        pa.array(field("again")[each]),
                    ],
                    ["k", "th", "at", "minimizer", "edge", "edge2", "again"],
                )

    lists = asked.groupBy("k", "th").agg(
        F.collect_list(F.struct("start", "edges", "minimizer", "again")).alias("asked")
    )
    # Repeated rows give the same edges again; theirs all have ``again``.
    joined = texts.join(lists, ["k", "th"]).select("k", "th", "text", "asked")
    return joined.mapInArrow(
        run, "k bigint, th bigint, at bigint, minimizer bigint, edge bigint, edge2 bigint, again boolean"
    )


def repeated_spans(docs: DataFrame, size: int = WINDOW, short: int = MINIMIZER) -> DataFrame:
    """k, th, start and words of spans whose every window occurs elsewhere too.

    Spans of a document may touch, overlap or be named twice; their union is what
    is repeated.
    """
    every = stored(paths(docs, size, short), "paths")
    ends = [f(c).alias(f"{n}_{c}") for c in ("path", "path2") for n, f in (("least", F.min), ("most", F.max))]
    differ = (F.col("least_path") != F.col("most_path")) | (F.col("least_path2") != F.col("most_path2"))
    shared = every.groupBy("minimizer").agg(F.count("*").alias("n"), *ends)
    # What is joined to the paths is stored before: in a stage of its own, the join's
    # skewed partitions, those of very common passages, are split.
    shared = stored(shared.where("n > 1").select("minimizer", differ.alias("branches")), "shared")
    hits = stored(every.join(shared, "minimizer"), "shared_paths")
    plain = hits.where("not branches")
    path, edge = ["minimizer", "path", "path2"], ["minimizer", "edge", "edge2"]
    counts = hits.where("branches").groupBy(*path).agg(
        F.count("*").alias("n"),
        F.min(F.struct("k", "th", "start", "edges")).alias("first"),
    )
    counts = stored(counts, "branching_paths")
    again = counts.where("n > 1").select(*path)
    whole = hits.where("branches").join(again, path, "left_semi")
    asked = counts.select("first.*", "minimizer", (F.col("n") > 1).alias("again"))
    edges = stored(_edges(_rows(docs), asked, size), "edges")
    twice = edges.groupBy(*edge).agg(F.count("*").alias("n"), F.bool_or("again").alias("again"))
    twice = stored(twice.where("n > 1 or again").select(*edge), "repeated_edges")
    single = edges.where("not again").join(twice, edge, "left_semi")
    span = ("k", "th", "start", "words")
    long = plain.unionByName(whole).withColumn("words", F.col("edges") + F.lit(size - 1))
    short_ones = single.withColumn("start", F.col("at")).withColumn("words", F.lit(size))
    return long.select(*span).unionByName(short_ones.select(*span))


def remove_repeats(docs: DataFrame, size: int = WINDOW, short: int = MINIMIZER) -> DataFrame:
    """doc_id, n_words, n_removed and text (kept words joined by one space) of every row."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for first, count in text_slices(batch):
                part = batch.slice(first, count)
                words = Words(part.column("text"))
                lists = pa.compute.fill_null(
                    pa.compute.list_value_length(part.column("spans")), 0
                ).to_numpy(zero_copy_only=False)
                flat = part.column("spans").flatten()
                owner = np.repeat(np.arange(count), lists)
                begin = words.first[owner] + flat.field("start").to_numpy(zero_copy_only=False)
                end = begin + flat.field("words").to_numpy(zero_copy_only=False)
                marks = np.zeros(len(words) + 1, np.int64)
                np.add.at(marks, begin, 1)
                np.add.at(marks, end, -1)
                keep = np.cumsum(marks[:-1]) == 0
                kept = np.concatenate([[0], np.cumsum(keep)])[words.first]
                n = np.diff(words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n),
                        pa.array(n - np.diff(kept)),
                        pa.array([words.text(r, keep).decode() for r in range(count)], pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "text"],
                )

    spans = repeated_spans(docs, size, short).groupBy("k", "th")
    spans = spans.agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    joined = _rows(docs).join(spans, ["k", "th"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, text string")
