"""Sources mixed to target weights by Poisson replication.

Native: DataFrame functions only. A document of source s is repeated as often as
a Poisson number with mean rate(s) says, which is read off the inverse of the
distribution at a hash of seed and doc_id, so that a run may be repeated, and a
document's copies do not depend on other documents. The rate brings the source's
expected characters to its weight's share of ``epochs`` times all characters.
Copies are then dealt by a hash and sorted by it in each partition: a global
shuffle without a sampling pass.

Only one row per source is ever joined to the documents; Spark broadcasts that
table if its file is below the session's limit, else it splits hot sources.

Cases: NULL source is a source of its own; a text counts one character at least,
so that sources of empty texts can be repeated too; sources without a weight get
weight 0 where weights are given; a document without doc_id is known by its text's
hash; rows with the same doc_id, or without one and of the same text, are repeated
equally often, and ties in shuffle_key come in the order of doc_id and copy; empty and very
long texts are copied like others, and count by their characters; an empty table gives no
rows; other columns are kept, those named copy and shuffle_key are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import stored

# A rate is split into equal parts of at most this; their Poisson numbers add up.
PART_RATE = 16.0
# With a mean of 16, a number of 100 or more has a probability below 1e-40.
TERMS = 100
SEED = 7


def unit(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash of the parts."""
    text = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(text, 1, 13), 16, 10).cast("bigint")


def rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, epochs: float = 1.0
) -> DataFrame:
    """source, rate and cdf (of one part of the rate, from 0 on), part_count."""
    size = F.greatest(F.length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("bigint")
    sums = docs.groupBy("source").agg(F.sum(size).alias("chars"))
    if weights is None:
        sums = sums.withColumn("weight", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame(
            [(s, float(w)) for s, w in weights.items()], "given string, weight double"
        )
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("given")), "left")
        sums = sums.drop("given").fillna(0.0, ["weight"])
    sums = stored(sums, "sources")
    whole = sums.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight")).first()
    if not whole["all_chars"]:
        whole = {"all_chars": 1, "all_weight": 1.0}
    share = F.col("weight") / F.lit(float(whole["all_weight"] or 1.0))
    rate = share * F.lit(float(whole["all_chars"])) * F.lit(float(epochs)) / F.col("chars")
    found = sums.select("source", rate.alias("rate"))
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    found = found.withColumn("part_count", parts)
    found = found.withColumn("mean", F.col("rate") / F.col("part_count"))
    logs = F.array(*[F.lit(math.lgamma(j + 1)) for j in range(TERMS)])
    terms = found.select("*", F.posexplode(logs).alias("j", "log_fact"))
    term = F.when(
        F.col("mean") > 0, F.exp(F.col("j") * F.log("mean") - F.col("mean") - F.col("log_fact"))
    ).otherwise(F.when(F.col("j") == 0, 1.0).otherwise(0.0))
    upto = Window.partitionBy("source").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    sums = terms.withColumn("cdf", F.sum(term).over(upto))
    cdf = F.transform(F.array_sort(F.collect_list(F.struct("j", "cdf"))), lambda x: x["cdf"])
    whole = sums.groupBy("source", "rate", "part_count").agg(cdf.alias("cdf"))
    # Beyond what a 52-bit number can tell from 1 no entry decides anything.
    return whole.withColumn("cdf", F.expr("filter(cdf, (c, i) -> i = 0 or cdf[i - 1] < 1 - 1e-16)"))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    epochs: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Every copy of every document, with copy (from 0) and shuffle_key (its place)."""
    table = stored(rates(docs, weights, epochs), "rates").select(
        F.col("source").alias("_llm_source"), "part_count", "cdf"
    )
    table = table.withColumnsRenamed({"part_count": "_llm_parts", "cdf": "_llm_cdf"})
    joined = docs.join(table, F.col("source").eqNullSafe(F.col("_llm_source")))
    text_hash = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), text_hash))
    joined = joined.withColumn("_llm_name", name)
    count = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), F.col("_llm_parts") - 1),
            lambda part: F.size(
                F.filter(
                    F.col("_llm_cdf"),
                    lambda c: c * F.lit(float(2**52))
                    <= unit(F.lit(f"{seed}:n"), part.cast("string"), F.col("_llm_name")),
                )
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    joined = joined.withColumn("_llm_n", count).where("_llm_n > 0")
    copies = joined.withColumn("copy", F.explode(F.expr("sequence(0L, _llm_n - 1L)")))
    key = unit(F.lit(f"{seed}:k"), F.col("copy").cast("string"), F.col("_llm_name"))
    copies = copies.withColumn("shuffle_key", key)
    copies = copies.drop("_llm_source", "_llm_parts", "_llm_cdf", "_llm_name", "_llm_n")
    # Rows that share an id, and so their keys, are told apart by their texts.
    dealt = copies.repartition("shuffle_key", F.xxhash64("text"))
    return dealt.sortWithinPartitions("shuffle_key", "doc_id", "copy")
