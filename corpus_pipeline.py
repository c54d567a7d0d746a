"""From raw documents to token ids: the stages of a training corpus, each over all that the one before kept.

A stage takes the session, its predecessor's documents and the folder of the tables. All but the last return the columns of
``documents``. What a stage decides takes effect:

- ``language_id`` drops documents in which no language has half of the belief, and fills in a missing ``lang``;
- ``line_dedup`` takes boilerplate lines out of the texts and counts ``n_chars`` again;
- ``near_dedup`` keeps one document of each group of near-duplicates, linked from a similarity of 0.80 on (``NEAR_PERCENT``);
- ``decontaminate`` drops documents that hold a benchmark item;
- ``encode_pieces`` returns the ids of each text and whether they decode to it.

Rows with nulls, empty texts, repeats and other columns are treated as the operators define it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontam, langid, linededup, neardup, pieces
from tidemark.llm.common import stash, table

LEAST_BELIEF = 0.5
NEAR_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(docs.where(langid.id_remainder(F.col("doc_id"), 3) != 1))
    known = langid.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_BELIEF))
    filled = F.coalesce("row.lang", "lang_pred")
    return known.select(*[(filled if c == "lang" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.clean_documents(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("encode_pieces", encode_pieces)]

ORACLE_SQL = None  # tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
