"""From documents to training tokens: toxicity, near-duplicates, repeated substrings, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. A stage's
result is written as Parquet and reread as the next one's ``docs``; the tables that a stage wrote on its way then go.

All stages take null ids, null and empty texts, repeated rows and further columns (which stay, whatever their names, till
the last stage); an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoledger.llm import mixing, pieces, simhash, substrings, toxicity
from geoledger.llm.queries import piece_model
from geoledger.scratch import drop_written_since, tables_so_far, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels outside the held-out fold, scores below 0.7.

    Null texts are scored as empty ones. Repeated rows all stay or all go. Without labels nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.where(toxicity.fold_of(labels["doc_id"], 3) != 1).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.learn(docs, known), keep=tuple(docs.columns))
    return scored.where("score < 0.7").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked at 4 differing bits or fewer: that with the smallest id.

    Null and empty texts are one group. Null ids come after all others. Of equal rows one stays.
    """
    return simhash.representatives(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 35-word windows that are found anywhere else.

    Documents that lose all their words go; null and empty texts, and texts that lose nothing, stay as they are. n_chars
    counts the code points of texts that were cut.
    """
    return substrings.without_repeats(docs, window=35)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 0 to 2 times.

    Null sources are a source of their own. Null and empty texts stay once. Equal rows may be taken differently.
    """
    return mixing.repeated(mixing.mix(docs), docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the best segmentation with the scores of the three best, of every row.

    A null text gives null ids and scores, an empty one no pieces.
    """
    return pieces.encode(docs, piece_model(), nbest=3, keep=("doc_id", "lang", "source"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeats),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

#: Learning, components and iterative mixing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = tables_so_far()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_written_since(mark, docs)
    return docs
