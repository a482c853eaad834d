"""The registered queries of this folder, and what SQL says about them."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    ann,
    chatformat,
    htmltext,
    linededup,
    mixing,
    negatives,
    packing,
    pii,
    quality,
    repair,
    simhash,
    substring,
    tokencounts,
)
from salesmart.llm.common import table
from salesmart.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_files(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """One vocabulary for both tokenizer libraries."""
    import public_tokenizers

    return tuple(str(public_tokenizers.path(f"{name}.{kind}")) for kind in ("json", "tiktoken"))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents counted, then cleaned: exact copies deleted, counts of documents
    with repeated lines revised. The second batch is sent twice."""
    docs = table(spark, sf_dir, "documents")
    encoders = {"byte_bpe_50k": tokenizer_files()}
    rollup = tokencounts.Rollup(spark, f"{shared_folder(spark)}/llm/rollup-{uuid4().hex}")
    counts = tokencounts.count_tokens(docs, encoders)
    rollup.apply(1, tokencounts.as_changes(counts, "insert"))

    texts = docs.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    first = texts.groupBy("a", "b").agg(F.min("doc_id").alias("first"))
    copies = texts.join(first, ["a", "b"]).where("doc_id > first")
    deleted = copies.select(
        F.col("doc_id").cast("string").alias("doc"),
        F.explode(F.array(*map(F.lit, [*encoders, tokencounts.WHITE_SPACE]))).alias("version"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("lang", "string"), ("n_tokens", "bigint"))),
    )
    lines = F.split("text", "\n", -1)
    once = docs.withColumn("lines", F.array_distinct(lines)).where(F.size("lines") < F.size(lines))
    revised = once.withColumn("text", F.array_join("lines", "\n")).drop("lines")
    changes = tokencounts.as_changes(tokencounts.count_tokens(revised, encoders), "revise")
    changes = changes.unionByName(tokencounts.as_changes(deleted, "delete"))
    for _ in range(2):
        rollup.apply(2, changes)
    return rollup.totals()


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_private(table(spark, sf_dir, "documents"))


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "lang", "source", "copy", "shuffle_key", "text")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text"), 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", digest)


def op10_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("k", "th")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.summary(repair.repair(damaged))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chatformat.format_chat(given.unionByName(chatformat.probe_rows(spark)))
    return chatformat.summary(formatted)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_nearest,
            op2_token_rollup,
            op3_simhash,
            op4_packing,
            op5_main_text,
            op6_private_data,
            op7_poisson_mixing,
            op8_line_dedup,
            op9_repeated_passages,
            op10_robust_outliers,
            op11_structure_repair,
            op12_chat_format,
            op13_hard_negatives,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_poisson_mixing": OP7, "op8_line_dedup": OP8}


OP7 = f"""
with doc as materialized (
    select doc_id, lang, source, text, row_number() over () as r,
           coalesce(doc_id::varchar, 'text ' || md5(coalesce(text, ''))) as name from documents),
size as (select source, sum(greatest(length(coalesce(text, '')), 1)) as chars
         from doc group by source),
rate as (select source,
                1.0 / (select count(*) from size)
                * (select sum(chars) from size)::double / chars as rate from size),
part as (select *, greatest(ceil(rate / {mixing.PART_RATE}), 1)::int as parts from rate),
term as (select source, parts, j,
                exp(j * ln(rate / parts) - rate / parts - lgamma(j + 1)) as p
         from part, range({mixing.TERMS}) t(j)),
cdf as (select source, parts, j,
               sum(p) over (partition by source order by j rows unbounded preceding) as c
        from term),
draw as (select r, doc.source, k,
                ('0x' || substr(md5('{mixing.SEED}:n:' || k || ':' || name), 1, 13))::bigint as u
         from doc join part on doc.source is not distinct from part.source, range(64) t(k)
         where k < parts),
number as (select r, count(*) filter (c * 4503599627370496.0 <= u) as n
           from draw join cdf on draw.source is not distinct from cdf.source group by r),
copies as (select r, unnest(range(n)) as copy from number where n > 0)
select doc_id, lang, source, copy, text,
       ('0x' || substr(md5('{mixing.SEED}:k:' || copy || ':' || name), 1, 13))::bigint
           as shuffle_key
from copies join doc using (r)
"""

OP8 = f"""
with line as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from line),
firsts as (select key, min(doc_id) as first from keyed where length(key) >= 10 group by key),
judged as (
    select k.*, f.first is null or f.first = doc_id as keep
    from keyed k left join firsts f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (not keep) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (keep), '')) as kept_sha256
from judged group by doc_id
"""
