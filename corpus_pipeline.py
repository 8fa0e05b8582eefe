"""A corpus pipeline over ``documents``: toxicity, language, near-duplicates, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept.  All but
the last return the columns of ``documents``; the last returns the digests of the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import bpe, langid, minhash, mixing, toxicity
from changeloom.llm.common import crc32_of, identified, read, stored, word_count


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxic passages make label 1 likelier than not are dropped.

    Rows are judged one by one: repeated rows get one answer.  Null and empty texts have no passage and stay, as does
    everything where no labelled document is left to learn from.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(crc32_of("doc_id") % 5 != 0))
    return toxicity.keep_clean(docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too), or between two languages, are dropped.

    Rows are judged one by one: repeated rows get one answer; without a labelled row nothing is known and all go.
    """
    model = langid.fit(docs.where(crc32_of("doc_id") % 4 != 2))
    return langid.keep_accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest ``doc_id`` stays, with all rows of that id.

    Rows without ``doc_id`` are documents of their own and come after all others; documents without words are alike with none and stay.
    """
    return minhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mixture takes it (0 to 3 times).

    Rows that share an id, or have none, draw one by one; rows without words are taken 0 times or by the draw of their length.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named, _ = identified(docs.select("doc_id", "source", word_count("text").alias("size"), whole.alias("row")))
    copies = mixing.pareto_mix(named.select("row_id", "source", "size"), "row_id").where("copies > 0").select("row_id", "copies")
    taken = named.join(copies, "row_id").select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return taken.select("row.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, one row for each row; null and empty texts have no ids."""
    return bpe.digest(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: Toxicity scores, compressed sizes and byte pair merges aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder before the next begins."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
