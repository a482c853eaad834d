"""Hard negatives against brute force in Python integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import negatives
from salesmart.llm.queries import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, key string, block string, scores string"
FIELDS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
LARGEST = 2**63 - 1


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "other", "other", "other") for r in rows], SCHEMA)


def relabelled(rows):
    return [(i, v, (l + 1) % 10 if i is not None and l is not None and i % 7 == 0 else l) for i, v, l in rows]


def clip(x):
    return max(-LARGEST, min(LARGEST, x))


def brute(rows, asks, n_positives=5, n_negatives=10):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [clip(math.floor(256 * float(np.float32(x)))) for x in v]
        if i not in kept or (label, len(whole)) < (kept[i][1], len(kept[i][0])):
            kept[i] = whole, label
    out = []
    for a, (anchor, label) in kept.items():
        if not asks(a):
            continue
        scored = sorted(
            (-clip(sum(x * y for x, y in zip(anchor, v))), i, other)
            for i, (v, other) in kept.items()
            if i != a and len(v) == len(anchor)
        )
        for p, i, _ in [s for s in scored if s[2] == label][:n_positives]:
            fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a, i, r, j, -p, -n) for r, (n, j, _) in enumerate(fit[:n_negatives], 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r[f] for f in FIELDS) for r in frame.collect())


inf, nan = float("inf"), float("nan")
EDGE = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.5, 0.0], 2), (3, [0.9, 0.0], 2), (4, [0.5, 0.0], 3)]
EDGE += [(5, None, 1), (6, [1.0, None], 1), (7, [nan, 1.0], 2), (8, [inf, 0.0], 2), (9, [1.0, 1.0], None)]
EDGE += [(None, [0.5, 0.0], 2), (10, [], 1), (20, [], 1), (11, [], 2), (12, [0.5], 2), (30, [0.5, 0.0], 1)]
EDGE += [(0, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (40, [0.0, 0.0], 4), (41, [0.0, 1.0], 4), (50, [-1.0, 0.0], 9), (51, [1.0, 0.0], 9)]
EDGE += [(60, [3e38, 1.0], 5), (61, [3e38, 1.0], 5), (62, [1.5e38, 0.0], 6), (70, [1e7, 2.0], 7), (71, [1e7, 1.0], 7), (72, [5e6, 0.0], 8)]
EDGE += [(80, [2e14, 3.0], 7), (-10, [1.0, 0.0], 2), (-11, [0.8, 0.0], 2)]


def test_odd_vectors(spark):
    got = negatives.mine(vectors(spark, EDGE), F.col("vec_id") % 10 == 0)
    wanted = brute(EDGE, lambda i: i % 10 == 0)
    assert found(got) == wanted and wanted
    assert negatives.mine(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine(vectors(spark, EDGE), F.col("vec_id") == 999).count() == 0


@pytest.mark.parametrize("block, tile", [(65_536, 1 << 21), (40, 64), (7, 1)])
def test_blocks_ties_and_labels(spark, monkeypatch, block, tile):
    """Many equal scores, one label with a third of the rows, many small blocks."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "LEAST_ROWS", block)
    monkeypatch.setattr(negatives, "TILE_SCORES", tile)
    draw = random.Random(2)
    rows = [
        (i, [draw.choice([0.0, 0.25, 0.5, 1.0]) for _ in range(4)], draw.choice([0, 0, 1, 2, 3])) for i in range(300)
    ]
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 20 == 0, 3, 4)
    assert found(got) == brute(rows, lambda i: i % 20 == 0, 3, 4)


def test_keys_sort_as_they_should():
    draw = random.Random(4)
    numbers = [0, 1, -1, 2**62, -(2**62), LARGEST, -LARGEST, 255, 256]
    rows = [tuple(draw.choice(numbers) for _ in range(3)) for _ in range(500)]
    for negative in (False, True):
        keys = negatives.packed(*(np.array([r[i] for r in rows]) for i in (0, 1)), negative, np.array([r[2] for r in rows]))
        assert list(negatives.unpacked(keys)) == [(a, s, int(negative), i) for a, s, i in rows]
        by_bytes = [r for _, r in sorted(zip(keys.to_pylist(), rows))]
        assert by_bytes == sorted(rows, key=lambda r: (r[0], -r[1], r[2]))


def test_query(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST_ROWS", 64)
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = found(queries()["op13_hard_negatives"](spark, sf_dir))
    assert got == brute(relabelled(rows), lambda i: i % 100 == 0)
    assert got
