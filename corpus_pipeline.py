"""The corpus pipeline: documents to packed training sequences, stage by stage."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from diagarc.llm import jaccard, langid, mixing, packing, secrets
from diagarc.plans.shared import run_dir, ship_package

#: Least share of a document's words that its language must have.
LEAST_SCORE = 0.4
#: Words of a shingle, and the least similarity of linked documents in hundredths.
WIDTH, LEAST = 5, 80


def _rows(docs):
    """row (all columns), id, text and hash of the text; a column of the documents may have any name."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("hash"))


def by_language(spark, docs, sf_dir):
    """Documents without letters go, and those in which no language has LEAST_SCORE of the words."""
    labelled = langid.label_documents(_rows(docs).select("row"), langid.fit(docs), text="row.text")
    return labelled.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select("row.*")


def one_of_each_group(spark, docs, sf_dir):
    """Of documents that links of shingle similarity connect, the one with the smallest id stays.

    Of several rows with that id the one with the smallest text hash stays, of equal rows one.
    Documents without words are linked with nothing and stay.
    """
    groups = jaccard.alike_groups(docs, width=WIDTH, least=LEAST)
    heads = groups.filter("n_shingles > 0 and doc_id <=> component_id")
    heads = heads.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("times"))
    heads = heads.groupBy("component").agg(F.min(F.struct("text_hash", "doc_id", "times")).alias("one"))
    heads = heads.select(F.col("one.doc_id").alias("head"), F.col("one.text_hash").alias("head_hash"), "one.times")
    wordless = groups.filter("n_shingles = 0").select(F.col("doc_id").alias("head"), F.col("text_hash").alias("head_hash")).distinct()
    wanted = heads.unionByName(wordless.withColumn("times", F.lit(1).cast("bigint")))
    kept = _rows(docs).join(wanted, F.col("id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("head_hash")))
    single, several = kept.filter("times = 1"), kept.filter("times > 1").dropDuplicates(["head", "head_hash"])
    return single.unionByName(several).select("row.*")


def without_secrets(spark, docs, sf_dir):
    """Every finding is replaced by a mark; all documents stay."""
    return secrets.redacted(docs, secrets.fit(docs))


def to_mix(spark, docs, sf_dir):
    """As many copies of each document as the mix takes of it, to the nearest whole copy; none where it takes less than half or the document has no words."""
    taken = mixing.mix(docs).groupBy("doc_id", "text_hash").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = taken.withColumn("copies", F.round(F.try_divide("taken", "size")).cast("int")).filter("copies > 0")
    copies = copies.select("doc_id", "text_hash", "copies")
    met = _rows(docs).join(copies, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
    return met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def to_sequences(spark, docs, sf_dir):
    """Pieces of the documents and their places in sequences; copies of a document are packed one by one."""
    return packing.pack(docs)


def _shipped(stage):
    @wraps(stage)
    def run_stage(spark, docs, sf_dir):
        ship_package(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _shipped(stage)) for name, stage in (
    ("language", by_language), ("similar", one_of_each_group), ("secrets", without_secrets), ("mix", to_mix), ("pack", to_sequences))]

#: Stages of learned models and hashed orders are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
