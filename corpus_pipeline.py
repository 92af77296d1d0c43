"""From raw documents to packed sequences: quality rules, near-duplicates, secrets, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.packing import packed, tokenize
from tidemark.llm.quality_rules import keep_sound
from tidemark.llm.runtime import discard, materialize, tuned
from tidemark.llm.secrets import redact
from tidemark.llm.substring_dedup import tune_bands

#: Documents this similar, in percent, are near-duplicates; a pair that is just so similar shares a band with probability RECALL.
PERCENT, RECALL, ROWS = 80, 0.9999, 7


def _digest(docs: DataFrame):
    return F.sha2(F.to_json(F.struct(*docs.columns)).cast("binary"), 256)


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until docs has no column of the name, in whatever case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _told_apart(docs: DataFrame) -> bool:
    """Whether each row has a doc_id of its own."""
    return docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").isEmpty()


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the forest reject go; null and empty texts are among them.

    Each row is judged by itself, so that rows that repeat stay or go together. Empty table: empty result. Extra columns stay, whatever their names.
    """
    return keep_sound(docs, tuned(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays: five-word shingles, similarity of 0.8 or more.

    Rows of one doc_id are documents of their own, ordered by a digest of the row: of those that are near-duplicates one stays, and others all
    stay; rows that are equal in every column become one. Rows without a doc_id, and texts without words, stay. Empty table: empty
    result. Extra columns stay.
    """
    tuned(spark)
    named = docs.filter("doc_id is not null")
    single = _told_apart(named)
    (key,) = _free(docs, "__row")
    row = F.col("doc_id") if single else F.struct("doc_id", _digest(docs).alias("digest"))
    keyed = named.withColumn(key, row)
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    found = near_duplicates(rows, percent=PERCENT, bands=tune_bands(PERCENT / 100, RECALL, ROWS), rows=ROWS)
    kept = found.filter("id = component").select(F.col("id").alias(key)).distinct()
    # as many ids as documents: never broadcast
    stay = keyed.join(kept.hint("merge"), key, "left_semi")
    stay = stay if single else stay.dropDuplicates([key])
    return stay.select(docs.columns).union(docs.filter("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place, and n_chars follows the text; every document stays, null texts as they are.

    Each row is masked by itself, whether or not rows repeat. Empty table: empty result. Extra columns stay.
    """
    tuned(spark)
    return redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or twice.

    Rows without a doc_id, and rows that repeat one, are mixed one by one; of rows equal in every column as many are given as the mix
    takes of them together. Texts without words count as any other; documents without a source are a source of their own. Empty table:
    empty result. Extra columns stay.
    """
    tuned(spark)
    single = _told_apart(docs)
    row = F.col("doc_id").cast("string") if single else F.to_json(F.struct("doc_id", _digest(docs).alias("digest")))
    key, times, copy = _free(docs, "__mix_key", "__mix_copies", "__mix_copy")
    keyed = docs.withColumn(key, row)
    copies = mix_sources(keyed, id_col=key).groupBy(F.col("id").alias(key)).agg(F.sum("copies").cast("int").alias(times))
    once = keyed if single else keyed.dropDuplicates([key])
    taken = once.join(copies.filter(F.col(times) > 0).hint("merge"), key)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), times))).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: in which sequence of at most 1024 tokens, and at which offset.

    Null and empty texts are one end id. A document that the mix took twice, or a row that repeats, is packed as often. Empty table: empty
    result. Extra columns are ignored.
    """
    tuned(spark)
    return packed(tokenize(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: No SQL has tokenizers, forests or sketches: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again by the next, and then deleted."""
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        given, docs = docs, materialize(stage(spark, docs, sf_dir))
        discard(given)
    return STAGES[-1][1](spark, docs, sf_dir)
