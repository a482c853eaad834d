"""Token totals by source, language and tokenizer version, kept up by signed changes.

Batches of inserts, deletes and revised counts become signed sums, which are
added up when totals are asked for; documents that a batch does not name are not
looked at. What a delete or a revision takes away is found in a ledger, which has
one row per document and version that a batch touched.

A batch is written in three steps (ledger, sums, commit mark), each of which
replaces what an attempt that was cut off may have left. Only what has a commit
mark is ever read, and a batch that has one is not applied again, so that every
batch counts once whatever fails and however often it is sent. Batch numbers
grow, as those of Structured Streaming's ``foreachBatch`` do.

Cases: NULL source, language or text are values like others (a NULL text has no
tokens); a document without doc_id is known by its text's hash; of several rows
for one document and version in a batch the one with the greatest seq counts,
then deletes before others, then the greatest count, source and language, so
repeated rows count once; a delete of an unknown document changes nothing; a
batch without rows is committed as such; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.common import stored, text_key
from salesmart.llm.tokens import Encoder

WHITE_SPACE = "white_space"
CHANGE = "doc string, version string, op string, seq bigint, source string, lang string, n_tokens bigint"
# Batches up to this size are broadcast to find their documents in the ledger;
# for larger ones both sides are shuffled.
BROADCAST_ROWS = 100_000
_GROUP = ("source", "lang", "version")


def doc_name(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.hex(text_key(text))))


def count_tokens(docs: DataFrame, encoders: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """doc, source, lang, version, n_tokens: words for ``white_space``, and a row for each encoder.

    ``encoders`` names the files of each tokenizer version, see ``tokens.Encoder``.
    """
    versions = [*encoders, WHITE_SPACE]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = [Encoder(*files) for files in encoders.values()]
        for batch in found:
            counts = np.zeros((batch.num_rows, len(versions)), np.int64)
            for row, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                counts[row, :-1] = [len(e.encode(text)) // 4 for e in made]
                counts[row, -1] = len(text.encode().split())
            each = pa.array(np.repeat(np.arange(batch.num_rows), len(versions)))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(each) for c in ("doc", "source", "lang")),
                    pa.array(versions * batch.num_rows, pa.string()),
                    pa.array(counts.ravel()),
                ],
                ["doc", "source", "lang", "version", "n_tokens"],
            )

    narrow = docs.select(
        doc_name(F.col("doc_id"), F.col("text")).alias("doc"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInArrow(
        run, "doc string, source string, lang string, version string, n_tokens bigint"
    )


def as_changes(counts: DataFrame, op: str, seq: int = 0) -> DataFrame:
    """Counted documents as changes; op is insert, revise or delete."""
    return counts.select(
        "doc", "version", F.lit(op).alias("op"), F.lit(seq).cast("bigint").alias("seq"),
        "source", "lang", "n_tokens",
    )


class Rollup:
    """Totals in a folder that all executors reach. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def is_committed(self, batch: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._at('commits', batch)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Applies a batch once. False if it was committed before."""
        if self.is_committed(batch):
            return False
        order = F.struct(
            "seq", (F.col("op") == "delete").alias("gone"), F.col("n_tokens").alias("n"),
            F.col("source").alias("s"), F.col("lang").alias("l"),
        )
        last = changes.groupBy("doc", "version").agg(F.max(order).alias("c"))
        fresh = stored(
            last.select(
                "doc",
                "version",
                (~F.col("c.gone")).alias("alive"),
                F.col("c.s").alias("source"),
                F.col("c.l").alias("lang"),
                F.coalesce("c.n", F.lit(0).cast("bigint")).alias("n_tokens"),
            ),
            "changes",
        )
        before = self._committed("ledger", "doc string, version string, alive boolean, " + _VALUES)
        named = fresh.select("doc", "version")
        few = fresh.count() <= BROADCAST_ROWS
        named = F.broadcast(named) if few else named.hint("merge")
        before = before.where(F.col("batch") < batch).join(named, ["doc", "version"], "left_semi")
        row = F.struct("alive", "source", "lang", "n_tokens")
        before = before.groupBy("doc", "version").agg(F.max_by(row, F.col("batch")).alias("r"))
        before = before.select("version", "r.*").where("alive")
        signed = before.withColumn("sign", F.lit(-1)).unionByName(
            fresh.where("alive").drop("doc").withColumn("sign", F.lit(1))
        )
        sums = signed.groupBy(*_GROUP).agg(
            F.sum("sign").cast("bigint").alias("n_docs"),
            F.sum(F.col("sign") * F.col("n_tokens")).cast("bigint").alias("n_tokens"),
        )
        self._write(sums, "sums", batch)
        self._write(fresh, "ledger", batch)
        self._write(self.spark.range(1).select(F.lit(True).alias("done")), "commits", batch)
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens; groups that no document is left in are gone."""
        sums = self._committed("sums", "version string, n_docs bigint, " + _VALUES)
        found = sums.groupBy(*_GROUP).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        return found.where("n_docs != 0 or n_tokens != 0")

    def _at(self, part: str, batch: int) -> str:
        return f"{self.path}/{part}/batch={batch}"

    def _write(self, frame: DataFrame, part: str, batch: int) -> None:
        frame.write.mode("overwrite").parquet(self._at(part, batch))

    def _committed(self, part: str, schema: str) -> DataFrame:
        """Rows of committed batches; none before the first commit."""
        schema += ", batch bigint"
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return self.spark.createDataFrame([], schema)
        done = self.spark.read.schema("done boolean, batch bigint").parquet(f"{self.path}/commits")
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{part}")
        return rows.join(done.where("done").select("batch"), "batch", "left_semi")


_VALUES = "source string, lang string, n_tokens bigint"
