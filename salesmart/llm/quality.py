"""Quality rules: documents far from the robust centre of their language and source.

A text becomes a vector of transformed statistics. For each language and source
the minimum covariance determinant is sought by concentration steps over all rows:
rows in the nearest ``SHARE`` by Mahalanobis distance give the next mean and
covariance. Several starts, from the median and from the quartiles of every
statistic, go ``STEPS`` steps side by side; of each group the one of least determinant
goes on until its determinant stops falling. So a block of alike junk that one start
settles on is left where another start finds a tighter share. As in all published
algorithms for many rows, the least determinant of all shares is not proven. A row is
rejected if its squared distance, shrunk for short texts, is above ``CUTOFF``. Rows that
fail the base rules take no part in the estimates and are not kept.

The vectors are stored once, then every step is two sums over groups; distances
are found from a histogram of counts, so that a group's size does not matter. Sums of
doubles may differ in their last bits from run to run, and with them a row at the very
cutoff. Only a few rows per group are joined to the vectors.

Cases: NULL text has no words and fails the base rules; NULL language or source
is a group of its own; groups below ``MIN_GROUP`` rows are pooled by language,
what is then still too small over all languages, and a rest that is too small is
judged by the estimate of all rows, which needs ``MIN_GROUP`` rows itself, or rejects
nothing; a distance that is equal to the cutoff is kept; very long texts are read whole;
equal rows give a covariance of its floor; repeated rows count
as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Words, id_key, mixed, stored, text_key, text_slices, windows

MIN_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?"

SHARE = 0.6
# Quantiles at which the starts have their centres, steps of each of them, and steps of the
# best one at most; it has stopped falling before in all corpora that we measured.
STARTS = (0.5, 0.25, 0.75)
STEPS, MOST_STEPS = 2, 12
LEAST_FALL = 1e-9
# Part of normal vectors that the cutoff keeps.
NORMAL_KEPT = 0.9999
MIN_GROUP = 50
# Words at which a text's distance counts half: short texts vary more. Of 0, 5, 10, 15,
# 20 and 40 the largest at which no more bad documents of the labelled sample (sf0.1,
# 3,980 labels) stay than without shrinking.
HALF_WORDS = 10
# The statistics and the least standard deviation each is given, so that one
# that is the same in nearly all texts does not make every other value an outlier.
FLOORS = {
    "word_length": 0.06,
    "symbols": 0.5,
    "upper": 0.25,
    "punctuation": 0.25,
    "repeats": 1.0,
    "short_words": 0.08,
}
STATISTICS = tuple(FLOORS)
_BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_COLUMNS = ("doc_id", "k", "th", "lang", "source")
_P = len(STATISTICS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _table(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def _per_row(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated_words(words: Words, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Mask of words in a window of ``size`` found twice or more in the same text."""
    marked = np.zeros(len(words) + 1, np.int64)
    found = windows(words.hashes(11), size, 13)
    if len(found):
        inside = np.flatnonzero(words.row[: len(found)] == words.row[size - 1 :])
        keys = found[inside] ^ mixed(words.row[inside].astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(inside), bool)
        twice[order[1:]] = same
        twice[order[:-1]] |= same
        np.add.at(marked, inside[twice], 1)
        np.add.at(marked, inside[twice] + size, -1)
    return np.cumsum(marked[:-1]) > 0


def duplicate_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    count = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            count += line in seen
            seen.add(line)
    return count


def text_statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts)
    data, offsets = words.data, words.offsets
    n = np.diff(words.first)
    begins = (data & 0xC0) != 0x80
    inside = np.zeros(len(data) + 1, np.int64)
    inside[words.starts] += 1
    np.subtract.at(inside, words.ends, 1)
    inside = np.cumsum(inside[:-1]) > 0
    letters = begins & inside
    word_chars = _per_row(letters, offsets)
    symbols = _per_row(_table(SYMBOLS)[data], offsets)
    upper = (data >= 65) & (data <= 90)
    if len(data):
        marked = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)
        upper[1:] |= marked
    chars = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
    short = (chars[words.ends] - chars[words.starts]) <= 3
    repeats = _per_row(repeated_words(words), words.first)
    raw = data.tobytes()
    lines = [duplicate_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    per_word = lambda x: 100 * x / np.maximum(n, 1)
    return {
        "n_words": n,
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": np.array(lines, np.int64),
        "n_repeat_words": repeats,
        "word_length": np.log(np.maximum(word_chars, 1) / np.maximum(n, 1)),
        "symbols": np.log1p(per_word(symbols)),
        "upper": np.log1p(100 * _per_row(upper, offsets) / np.maximum(word_chars, 1)),
        "punctuation": np.log1p(per_word(_per_row(_table(PUNCTUATION)[data], offsets))),
        "repeats": np.log1p(per_word(repeats)),
        "short_words": np.arcsin(np.sqrt(_per_row(short, words.first) / np.maximum(n, 1))),
    }


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, k and th (the row's key), lang, source, base counts and statistics."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for first, rows in text_slices(batch):
                part = batch.slice(first, rows)
                numbers = text_statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in _COLUMNS] + [pa.array(x) for x in numbers.values()],
                    [*_COLUMNS, *numbers],
                )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        id_key(F.col("doc_id")).alias("k"),
        text_key(F.col("text")).alias("th"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    schema = "doc_id bigint, k bigint, th bigint, lang string, source string, " + _BASE
    found = narrow.mapInArrow(run, schema + "".join(f", {s} double" for s in STATISTICS))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    return found.withColumn("base_failed", failed)


# Names of pools over all languages: of groups that are too small, and of all rows.
REST, ALL = "rest", "all"


def _groups(vectors: DataFrame) -> DataFrame:
    """The group (or NULL: too few rows) of each language and source, NULL-safe."""
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < MIN_GROUP
    pooled = F.sum(F.when(small, F.col("n")).otherwise(0))
    sizes = stored(sizes.withColumn("of_lang", pooled.over(Window.partitionBy("lang"))), "sizes")
    rest = sizes.where(small & (F.col("of_lang") < MIN_GROUP)).agg(F.sum("n")).first()[0] or 0
    every = sizes.agg(F.sum("n")).first()[0] or 0
    name = (
        F.when(~small, F.to_json(F.struct(F.lit(0).alias("p"), "lang", "source")))
        .when(F.col("of_lang") >= MIN_GROUP, F.to_json(F.struct(F.lit(1).alias("p"), "lang")))
        .when(F.lit(rest >= MIN_GROUP), F.lit(REST))
        .when(F.lit(every >= MIN_GROUP), F.lit(ALL))
    )
    return sizes.select("lang", "source", name.alias("g"))


def _start(vectors: DataFrame) -> DataFrame:
    """Centres of the starts (t) and quartile range of each statistic, from counts per 1/512."""
    long = vectors.select("g", F.expr(f"stack({_P}, {', '.join(f'{i}, {s}' for i, s in enumerate(STATISTICS))}) as (i, x)"))
    bins = long.groupBy("g", "i", F.floor(F.col("x") * 512).alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("g", "i")
    bins = bins.withColumn("upto", F.sum("n").over(whole.orderBy("bin")) / F.sum("n").over(whole))

    def quantile(q: float) -> Column:
        return (F.min(F.when(F.col("upto") >= q, F.col("bin"))) + 0.5) / 512

    found = bins.groupBy("g", "i").agg(
        F.array(*map(quantile, STARTS)).alias("centres"),
        ((quantile(0.75) - quantile(0.25)) / 1.349).alias("s"),
    )
    each = found.select("g", "i", "s", F.posexplode("centres").alias("t", "m"))
    return each.groupBy("g", "t").agg(F.array_sort(F.collect_list(F.struct("i", "m", "s"))).alias("a"))


def inverse(covariance: np.ndarray) -> tuple[np.ndarray, float]:
    """Upper triangle of the inverse, row by row, and the determinant's logarithm; the floors
    are added to the variances."""
    floors = np.array(list(FLOORS.values())) ** 2
    full = np.zeros((_P, _P))
    for (i, j), x in zip(_PAIRS, covariance):
        full[i, j] = full[j, i] = x
    full += np.diag(floors)
    found = np.linalg.inv(full)
    return np.array([found[i, j] for i, j in _PAIRS]), float(np.linalg.slogdet(full)[1])


def _inverted(moments: DataFrame) -> DataFrame:
    """g, t, mean, inverse and log_det from g, t, mean and covariance (arrays)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            turned = [inverse(np.array(c)) for c in batch.column("cov").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("g", "t", "mean")),
                    pa.array([inv.tolist() for inv, _ in turned], pa.list_(pa.float64())),
                    pa.array([log_det for _, log_det in turned], pa.float64()),
                ],
                ["g", "t", "mean", "inv", "log_det"],
            )

    return moments.select("g", "t", "mean", "cov").mapInArrow(
        run, "g string, t int, mean array<double>, inv array<double>, log_det double"
    )


def _distance() -> Column:
    away = [F.col(s) - F.col("mean")[i] for i, s in enumerate(STATISTICS)]
    terms = [
        F.col("inv")[n] * away[i] * away[j] * (1.0 if i == j else 2.0)
        for n, (i, j) in enumerate(_PAIRS)
    ]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def chi_square_quantile(p: float, freedom: int = _P) -> float:
    """Wilson and Hilferty's approximation."""
    a = 2 / (9 * freedom)
    return freedom * (1 - a + NormalDist().inv_cdf(p) * a**0.5) ** 3


CUTOFF = chi_square_quantile(NORMAL_KEPT)
_BIN = "cast(floor(log2(1 + d2) * 64) as int)"


def _nearest(judged: DataFrame) -> DataFrame:
    """The bin up to which a group's nearest ``SHARE`` of rows lies, for each start."""
    bins = judged.groupBy("g", "t", F.expr(_BIN).alias("bin")).agg(F.count("*").alias("n"))
    whole = Window.partitionBy("g", "t")
    upto = F.sum("n").over(whole.orderBy("bin")) / F.sum("n").over(whole)
    return bins.withColumn("upto", upto).where(F.col("upto") >= SHARE).groupBy("g", "t").agg(F.min("bin").alias("last"))


def _step(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """Mean, inverse and determinant of the rows that are nearest to an estimate."""
    judged = vectors.join(found, "g").withColumn("d2", _distance())
    near = judged.join(stored(_nearest(judged), "nearest"), ["g", "t"]).where(f"{_BIN} <= last")
    sums = [F.avg(s).alias(f"m{i}") for i, s in enumerate(STATISTICS)]
    for n, (i, j) in enumerate(_PAIRS):
        sums.append(F.covar_pop(STATISTICS[i], STATISTICS[j]).alias(f"c{n}"))
    moments = near.groupBy("g", "t").agg(*sums).select(
        "g",
        "t",
        F.array(*[f"m{i}" for i in range(_P)]).alias("mean"),
        F.array(*[f"c{n}" for n in range(len(_PAIRS))]).alias("cov"),
    )
    return stored(_inverted(moments), "estimate")


def estimates(vectors: DataFrame) -> DataFrame:
    """g, mean, inv and scale of every group; ``vectors`` are stored rows with g."""
    start = _start(vectors).withColumn("mean", F.expr("transform(a, x -> x.m)"))
    diagonal = [F.col("a")[i]["s"] * F.col("a")[i]["s"] if i == j else F.lit(0.0) for i, j in _PAIRS]
    found = stored(_inverted(start.withColumn("cov", F.array(*diagonal))), "estimate")
    for _ in range(STEPS):
        found = _step(vectors, found)
    columns = ("t", "mean", "inv", "log_det")
    least = F.min(F.struct(F.col("log_det").alias("by"), *columns)).alias("best")
    best = found.groupBy("g").agg(least).select("g", *(f"best.{c}" for c in columns))
    best = stored(best.withColumn("falls", F.lit(True)), "estimate")
    for _ in range(MOST_STEPS):
        falling = best.where("falls").drop("falls")
        if falling.isEmpty():
            break
        after = _step(vectors, falling).select("g", F.struct(*columns).alias("after"))
        falls = F.coalesce(F.col("after.log_det") < F.col("log_det") - LEAST_FALL, F.lit(False))
        both = best.drop("falls").join(after, "g", "left").withColumn("falls", falls)
        best = stored(
            both.select(
                "g", *(F.when(F.col("falls"), F.col(f"after.{c}")).otherwise(F.col(c)).alias(c) for c in columns), "falls"
            ),
            "estimate",
        )
    found = best.drop("falls")
    judged = vectors.join(found, "g").withColumn("d2", _distance())
    last = stored(_nearest(judged), "nearest")
    # The nearest share alone has too small a covariance: make the share's
    # distance what it is for normal vectors, but never enlarge distances.
    scale = F.greatest((F.pow(F.lit(2.0), (F.col("last") + 1) / 64) - 1) / chi_square_quantile(SHARE), F.lit(1.0))
    return stored(found.join(last, ["g", "t"]).select("g", "mean", "inv", scale.alias("scale")), "estimate")


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Base counts, base_failed, kept and distance of every row, with its key.

    The distance is NULL for rows that fail the base rules or whose pool is too small.
    """
    rows = stored(with_statistics(docs), "statistics")
    passed = rows.where("not base_failed")
    groups = stored(_groups(passed), "groups").withColumnsRenamed({"lang": "_l", "source": "_s"})
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    vectors = passed.join(groups, same).drop("_l", "_s").where("g is not null")
    if not groups.where(F.col("g") == ALL).isEmpty():
        others = vectors.where(F.col("g") != ALL).withColumn("g", F.lit(ALL))
        vectors = vectors.unionByName(others)
    vectors = stored(vectors, "vectors")
    # NULL for a language and source whose rows all fail the base rules.
    grouped = rows.join(groups, same, "left").drop("_l", "_s")
    found = grouped.join(estimates(vectors), "g", "left")
    shrink = F.col("n_words") / (F.col("n_words") + HALF_WORDS)
    distance = F.when(~F.col("base_failed"), _distance() / F.col("scale") * shrink)
    near = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return found.withColumn("distance", distance).select(
        "doc_id",
        "k",
        "th",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        "distance",
    )


def keep_good(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents without those rejected."""
    bad = judge(docs, cutoff).where("not kept").select(
        F.col("k").alias("_llm_k"), F.col("th").alias("_llm_th")
    )
    keyed = docs.withColumn("_llm_k", id_key(F.col("doc_id")))
    keyed = keyed.withColumn("_llm_th", text_key(F.col("text")))
    bad = bad.distinct().hint("shuffle_hash")
    return keyed.join(bad, ["_llm_k", "_llm_th"], "left_anti").drop("_llm_k", "_llm_th")
