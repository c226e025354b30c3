"""Corpus pipeline: toxicity, language ID, line dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns they were given.
"""

from pyspark.sql import functions as F

from pricelens.llm.common import table, written
from pricelens.llm.language_id import UNKNOWN, learn, predict
from pricelens.llm.line_dedup import dedup_lines
from pricelens.llm.packing import pack_documents
from pricelens.llm.simhash import keep_one
from pricelens.llm.toxicity import drop_toxic

#: Language ID keeps a document if its share of n-grams known in the predicted
#: language is at least this part of what that language's own texts have (a
#: document in four languages still has as much).
MIN_SCORE = 0.3

#: SQL cannot express the classifier, tokenizer and packing; tests/llm compares
#: the stages with brute force.
ORACLE_SQL = None


def toxicity(spark, docs, sf_dir):
    """Without the documents that the chain, fitted on ``labels``, calls toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def language_id(spark, docs, sf_dir):
    """Without documents of no language: no letters, or mostly unknown n-grams."""
    said = predict(docs, learn(docs), relative=True)
    lang, score = said.columns[-2:]
    return said.where((F.col(lang) != UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    """Texts without the lines that a later document holds too; n_chars follows the text."""
    out = dedup_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def simhash_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate group: the one with the smallest doc_id."""
    return keep_one(docs)


def packing(spark, docs, sf_dir):
    """Pieces of the remaining documents and their places in sequences."""
    return pack_documents(docs, with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("best_fit_packing", packing),
]


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
