"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept; all but
the last return the columns of documents.  Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import Stages
from rivulet.llm.minhash import near_duplicates
from rivulet.llm.mixing import mix
from rivulet.llm.packing import pack
from rivulet.llm.quality import quality_rules
from rivulet.llm.suffixes import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality_rules(docs, carry=COLUMNS).where("kept").select(COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8 or more.

    Rows without a doc_id stay; of rows with equal ids one stays.
    """
    stages = Stages(spark, "near-copies")
    found = stages.put(near_duplicates(docs, width=5).where("doc_id is not null").select("doc_id", "kept"), "found")
    kept = docs.select(COLUMNS).join(stages.put(found.where("not kept").select("doc_id").distinct(), "dropped"), "doc_id", "left_anti")
    again = stages.put(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return kept.select(COLUMNS)
    once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(again, "doc_id", "left_anti").select(COLUMNS).unionByName(once.select(COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 200 bytes or more that occur anywhere else; a document may become empty."""
    out = remove_repeats(docs, carry_text=True, key=F.struct("doc_id", "lang", "source"))
    return out.select("doc_id.doc_id", F.col("kept").alias("text"), "doc_id.lang", "doc_id.source", F.length("kept").cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, dealt to shards and shuffled within each."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # shards grow with the cluster's setting, so that each stays small
    _, copies, _ = mix(docs, carry=["text", "lang", "source", "n_chars"], n_shards=max(64, n))
    return copies.repartition(n, "shard").sortWithinPartitions("shard", "place_key").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality rules", quality), ("near duplicates", near_copies), ("repeated passages", repeats), ("source mix", mixture), ("packing", packed)]

#: The stages beyond the first are not SQL; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stages.put(docs, name.replace(" ", "-"))
    return docs
