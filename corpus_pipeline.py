"""A corpus for training, from documents to packed sequences: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import exact_dedup, jaccard, language, mixing, packing
from fleetlens.llm.queries import tokenizer_path
from fleetlens.llm.text import stored


def _decided(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The documents that have a decision, by id; a null id meets a null id."""
    decisions = decisions.withColumnRenamed("doc_id", "_id")
    return docs.join(decisions, F.col("doc_id").eqNullSafe(F.col("_id")), "inner")


# A language is decided if its parse weighs at least as much as all others together.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is decided: the predicted one has a score of LEAST_SCORE or more.

    What no language parses more cheaply than the others goes (texts of a word or two that several languages share, and
    what is no language), as does what has no letter. Labels of the held-out fold are not learned from, and a
    document's own label does not count. The language found does not replace the column ``lang``. Where no label can be
    learned from, every text with a letter stays.
    """
    model = language.fit(docs, ~language.held_out())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model, docs.columns, pred_col="_lang", score_col="_score")
    decided = (F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)
    return found.where(decided).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space: the one with the smallest id."""
    middle = exact_dedup.middle_id(docs)
    found = exact_dedup.exact_dedup(docs, F.col("doc_id") <= F.lit(middle))
    kept = found.where("kept").select("doc_id", "text_sha256")
    digest = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    return _one_each(_decided(docs.withColumn("_sum", digest), kept).where(F.col("_sum") == F.col("text_sha256")), docs)


def _one_each(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Of repeated rows one. ``rows`` has one text per id and digest, so only repetitions share both."""
    return rows.dropDuplicates(["doc_id", "_sum"]).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of likeness 0.8 on five-word shingles: the one with the smallest id.

    Rows without an id come after all others and are told apart by a number that is stored with them.
    """
    key, largest = jaccard.own_keys(docs)
    keyed = docs.withColumn("_key", key)
    keyed = keyed if largest is None else stored(keyed, "near-keys")
    found = jaccard.jaccard_components(keyed, id_col="_key")
    kept = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept")).distinct()
    return keyed.join(kept, F.col("_key") == F.col("_kept"), "inner").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to twice. Rows that share an id share the smallest number."""
    found = mixing.mix_sources(docs)
    copies = found.groupBy("doc_id").agg(F.min("copies").cast("int").alias("copies")).where("copies > 0")
    repeated = _decided(docs, copies).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

# SQL can not learn languages or solve the mix; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number + 1}")
    return docs
