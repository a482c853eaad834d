"""Lines that occur in several documents, dropped from all but the first of them.

Native: DataFrame functions only. Lines become 128-bit hashes of their keys,
dealt by range over the hash and sorted by document and position, so that the
first document of a key is the first row of its run; every later document's row
is a line to drop. What is returned is a bitmap per document, one 64-bit word
for every 64 lines, words without a dropped line left out. Texts stay where they
are until ``apply_bitmaps``.

Keys that hold a large share of all lines are found with a bounded sketch and
dealt by a hash of their document as well, over as many ranges as their rows
fill. Which keys it finds only decides how rows are dealt, never the result: such
a key's first document is a plain minimum.

Cases: NULL or empty text is one empty line; rows without doc_id count as one
document that comes after all others; rows with the same doc_id are one
document, so lines they share stay; repeated rows get the same bitmap; a text may have any
number of lines, and takes time in proportion to them; ties, which are lines of one key and
document, all stay or all go; an empty table gives no rows; other columns are kept by
``drop_lines``, those named n_lines and n_dropped are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WHITE, stored, text_key

MIN_CHARS = 10
# Bound of the sketch, and so of the broadcast table of heavy keys.
HEAVY_KEYS = 64
_LAST = 2**63 - 1


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    plain = F.octet_length(text) == F.length(text)
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, lower))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE.decode())))


def _rows(docs: DataFrame) -> DataFrame:
    """_llm_o: the document in order, NULL last; _llm_th: tells its rows apart."""
    return docs.withColumns(
        {
            "_llm_o": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)),
            "_llm_th": text_key(F.col("text")),
        }
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """o, th and words (array of word number and 64 bits, 1: keep, in order) of every
    document that loses a line."""
    rows = _rows(docs).select(
        F.col("_llm_o").alias("o"),
        F.col("_llm_th").alias("th"),
        F.posexplode(_lines(F.col("text"))).alias("pos", "line"),
    )
    rows = rows.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    # Two hashes with different seeds; the key itself is not carried.
    rows = rows.select(
        "o", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    rows = stored(rows, "lines")
    found = rows.agg(F.expr(f"approx_top_k(h1, {HEAVY_KEYS}, 10000)").alias("found"))
    found = found.select(F.explode("found").alias("f")).select(F.col("f.item").alias("h1"))
    heavy = rows.join(F.broadcast(found), "h1").groupBy("h1", "h2")
    heavy = stored(heavy.agg(F.min("o").alias("least")), "heavy")
    salted = rows.join(F.broadcast(heavy), ["h1", "h2"], "left").withColumn(
        "salt",
        F.when(F.col("least").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64("o", "th")),
    )
    dealt = salted.repartitionByRange("h1", "h2", "salt")
    run = Window.partitionBy("h1", "h2", "salt").orderBy("o", "pos")
    first = F.first("o").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dropped = dealt.withColumn("first", first).where(F.col("o") > F.coalesce("least", "first"))
    bit = F.expr("shiftleft(1L, cast(pos % 64 as int))")
    words = dropped.groupBy("o", "th", F.expr("pos div 64").cast("int").alias("word"))
    words = words.agg(F.bitwise_not(F.bit_or(bit)).alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("o", "th").agg(listed.alias("words"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with their kept text, and n_lines and n_dropped, the lines before and gone."""
    marks = bitmaps.select(
        F.col("o").alias("_llm_o"), F.col("th").alias("_llm_th"), F.col("words").alias("_llm_w")
    )
    joined = _rows(docs).join(marks.hint("shuffle_hash"), ["_llm_o", "_llm_th"], "left")
    plain = F.coalesce(F.col("text"), F.lit(""))
    # The words become an array without gaps, in one pass over them, bound to a lambda
    # variable, so that it is made once per document and not once per line.
    kept = F.expr(
        r"""
        element_at(transform(
            array(concat(
                flatten(transform(_llm_w, (e, i) -> concat(
                    array_repeat(-1L, e.word - if(i = 0, -1, _llm_w[i - 1].word) - 1), array(e.bits)))),
                array_repeat(-1L, cast((n_lines - 1) div 64 as int) - element_at(_llm_w, -1).word))),
            dense -> array_join(transform(filter(
                transform(split(text, '\n', -1), (x, i) -> struct(x, i)),
                s -> shiftrightunsigned(dense[cast(s.i div 64 as int)], cast(s.i % 64 as int)) & 1 = 1
            ), s -> s.x), '\n')), 1)
        """
    )
    gone = F.expr("aggregate(_llm_w, 0L, (n, w) -> n + bit_count(~w.bits))")
    lines = F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1
    return (
        joined.withColumn("n_lines", lines.cast("bigint"))
        .withColumn("n_dropped", F.coalesce(gone, F.lit(0)).cast("bigint"))
        .withColumn("text", F.when(F.col("_llm_w").isNull(), plain).otherwise(kept))
        .drop("_llm_o", "_llm_th", "_llm_w")
    )


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
