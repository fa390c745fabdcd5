"""A corpus pipeline: documents in a known language, exact and near copies removed, benchmark passages kept out, packed.

Each stage but the last returns the columns of its documents, with further ones whatever they are called, as they came.  A null text
counts as empty: language_id rejects it, the stages on copies take it for a text without words, and packing gives it no tokens.  Texts of
any length are read whole.  Equal ids and repeated rows are told in the stages' own docstrings; of an empty table each stage makes an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabletide.llm import exact, jaccard
from tabletide.llm.common import held_out, read
from tabletide.llm.decontaminate import clean
from tabletide.llm.language import fit, known_language
from tabletide.llm.packing import best_fit_texts
from tabletide.llm.queries import tokenizer_path

#: Permitted sequence lengths, in tokens.
SEQUENCE_TOKENS = (256, 512, 1024, 2048, 4096)


def _id() -> Column:
    """What the stages that choose rows take for the id: a null one counts as an id of the text's own that is larger than others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1) - F.pmod(F.xxhash64("text"), F.lit(1 << 48)))


def _free(docs: DataFrame, *wanted: str) -> list[str]:
    """Names like these that no column of `docs` has, whatever the case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _chosen(docs: DataFrame, digest: Column, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose id and digest are those of a row of `kept`, one for each."""
    keys = _free(docs, "chosen_id", "chosen_digest")
    found = docs.withColumns(dict(zip(keys, (_id(), digest)))).join(kept.toDF(*keys), keys, "left_semi")
    return found.dropDuplicates(keys).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model tells; those without letters, and those that two languages fit alike, go.

    The model is fitted on rows that op6_language_id learns from.  Rows with null or repeated ids are each judged by their text.
    """
    return known_language(docs, fit(docs.where(~held_out("doc_id", 5, 0)), "text", "lang"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id; any one of rows that repeat it.

    Of an id with several texts, each text counts as a document.  Null ids come after others; of a text that has null ids only, one
    row is kept.
    """
    [own] = _free(docs, "own_id")
    found = exact.exact_duplicates(docs.withColumn(own, _id()), id_col=own)
    return _chosen(docs, exact.digest(F.col("text")), found.where("kept").select("doc_id", "text_sha256"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar five-word shingles, 0.8 or more, connect, the one with the smallest doc_id.

    Of an id with several texts, each text counts as a document; one that links connect with another of them isn't kept beside it.
    Null ids come after others; of documents with null ids only that links connect, one is kept.
    """
    [own] = _free(docs, "own_id")
    found = jaccard.one_of_each(docs.withColumn(own, _id()), words=5, num=4, den=5, id_col=own)
    return _chosen(docs, jaccard.digest(F.col("text")), found)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur, nor a shorter item."""
    return clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, with their texts and places in bins of the permitted sequence lengths, in tokens."""
    return best_fit_texts(docs, tokenizer_path(), SEQUENCE_TOKENS)


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("packing", packing)]

#: SQL expresses neither the language model nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on `documents`."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
