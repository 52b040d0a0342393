"""From raw documents to packed training sequences, a stage at a time.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns
is written as Parquet and read again as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import save, unused
from clickloom.llm.op1_minhash import near_duplicates
from clickloom.llm.op3_substring import substring_dedup
from clickloom.llm.op4_decontaminate import contamination
from clickloom.llm.op5_toxicity import without_toxic
from clickloom.llm.op8_packing import pack_documents, tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.

    Null and empty texts stay; without labels of both classes all stay; texts of any length are scored whole; rows
    with one id, or null ids, are scored each; extra columns stay, whatever their names; an empty table stays empty.
    """
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group (similar by 80 percent or more) stays; of rows equal in every column, one.

    Null and empty texts link with nothing and stay; rows without an id are documents of their own and all stay, equal or
    not; rows with one id are one document: they stay or go together, as their texts link, and rows of an id that differ
    in any column all stay; texts of any length are hashed whole; an empty table stays empty.
    """
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Only rows whose id comes again can be equal; texts of all others are not compared.
    again = kept.groupBy("doc_id").count().filter("count > 1 AND doc_id IS NOT NULL").select("doc_id")
    once = kept.join(again, "doc_id", "left_anti").select(*docs.columns)
    return once.union(kept.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates())


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated passages go; a document of which nothing is left goes too. Others keep their text as it is.

    Empty texts stay, null ones as empty; a row is a document of its own, whatever its id; texts of any length are
    searched whole; extra columns stay, whatever their names (n_chars is counted anew where words go); an empty table stays empty.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    left = substring_dedup(docs, others=others, as_it_was=True).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    new = {c: F.col("others").getField(c) for c in others} | {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")}
    if "n_chars" in others:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(new["n_chars"])
    return left.select(*[new[c].alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Null and empty texts hold none and stay; without items all stay; rows with one id, or null ids, are judged each;
    texts of any length are searched whole; extra columns stay, whatever their names; an empty table stays empty.
    """
    name = unused(docs, "was_hits")
    found = contamination(docs.withColumnRenamed("hits", name), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    kept = found.filter(F.size("hits") == 0).drop("hits").withColumnRenamed(name, "hits") if "hits" in docs.columns else found.filter(F.size("hits") == 0)
    return kept.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences.

    A null or empty text is a document of one token; rows with one id, or null ids, are documents each; long texts are
    cut over many sequences; extra columns are not read; an empty table gives no pieces.
    """
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("decontamination", decontaminate),
    ("packing", packing),
]

#: Fitting, hashing and tokenising are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
