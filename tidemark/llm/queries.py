"""The registered queries of this subpackage, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontam, grammar, langid, licenses, linededup, neardup, negatives, pieces, quality, secretscan, topk, turns
from tidemark.llm.common import table
from tidemark.session import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function
    return add


@query(f"""
    WITH pages AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
    totals AS (SELECT source, count(*) AS pages FROM pages WHERE source IS NOT NULL GROUP BY source),
    held AS (SELECT source, line, count(*) AS n FROM (
        SELECT source, unnest(list_distinct(lines)) AS line FROM pages WHERE source IS NOT NULL)
        WHERE trim(line, ' ') <> '' GROUP BY source, line),
    bad AS (SELECT source, list(line) AS drops FROM held JOIN totals USING (source)
        WHERE n >= {linededup.MIN_PAGES} AND n * 100 > pages * {linededup.MAX_PERCENT} GROUP BY source),
    kept AS (SELECT doc_id, text, lines, CASE WHEN drops IS NULL THEN lines
        ELSE list_filter(lines, lambda x: NOT list_contains(drops, x)) END AS kept FROM pages LEFT JOIN bad USING (source))
    SELECT doc_id, array_to_string(kept, chr(10)) AS text, coalesce(len(lines), 0)::BIGINT AS n_lines,
        coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped FROM kept""")
def op5_site_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that stand on more than a tenth of its source's documents."""
    cleaned = linededup.drop_site_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("row.doc_id", cleaned.clean.alias("text"), "n_lines", "n_dropped")


def _license_sql() -> str:
    split = r"list_filter(string_split_regex({0}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
    lowered = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    starts = {label: " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
              for label, phrase in licenses.PHRASES.items()}
    finds = ", ".join(f"list_filter(range(len(words)), lambda i: {test}) AS {label}" for label, test in starts.items())
    templates = ", ".join(f"('{name}', string_split('{text}', ' '))" for name, text in licenses.TEMPLATES.items())
    own = ", ".join(f"CASE WHEN len({label}) > 0 THEN '{label}' END" for label in starts)
    length = licenses.longest(licenses.TEMPLATES)
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {lowered} AS lowered FROM documents),
    words AS (SELECT r, doc_id, {split.format('lowered')} AS words FROM docs),
    found AS (SELECT r, doc_id, len(words) AS n, {finds} FROM words),
    base AS (SELECT r, doc_id, n, {' || '.join(starts)} AS places, list_filter([{own}], lambda x: x IS NOT NULL) AS own FROM found),
    templates AS (SELECT name, list_distinct(tokens) AS tokens FROM (VALUES {templates}) t(name, tokens)),
    blocks AS (SELECT r, list_slice(words, i + 1, i + {2 * length}) AS block FROM (
        SELECT r, words, unnest(range(0, greatest(len(words) - {length}, 1), {length})) AS i FROM words)),
    met AS (SELECT r, list(DISTINCT name) AS names, max(shared / size) AS best FROM (
        SELECT r, name, len(list_intersect(tokens, block)) AS shared, len(tokens) AS size FROM blocks, templates)
        WHERE shared * 100 >= size * {licenses.MIN_PERCENT} GROUP BY r)
    SELECT doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word,
        list_max(places)::BIGINT AS last_word, array_to_string(list_sort(own), ',') AS base_labels,
        array_to_string(list_sort(list_distinct(own || coalesce(names, []))), ',') AS labels,
        CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
    FROM base LEFT JOIN met USING (r)"""


@query()
def op1_repair_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as grammar-compressed shards and read back."""
    path = workspace(spark, "shards")
    grammar.write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return grammar.read_shards(spark, path)


@query()
def op2_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of each document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated documents: the benchmark items in each, and the longest stretch in tokens. Clean documents have no row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("found") > 0).select(
        "row.doc_id", F.array_distinct("found.item_id").alias("item_ids"), F.array_max("found.tokens").alias("longest"))


@query()
def op4_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: fixed patterns, and values in context that are costly to guess."""
    return secretscan.find_secrets(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query()
def op6_unigram_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of each document, and whether they decode to its text."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of each document, learned from three quarters of the labels."""
    docs, held_out = table(spark, sf_dir, "documents"), langid.id_remainder(F.col("doc_id"), 4) == 2
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
    SELECT * FROM ranked WHERE rank <= 5""")
def op9_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of each query."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op10_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from two thirds of them."""
    docs, held_out = table(spark, sf_dir, "documents"), langid.id_remainder(F.col("doc_id"), 3) == 1
    model = langid.learn(docs.where(~held_out))
    found = langid.predict(docs, model, keep=["doc_id"]).select("row.doc_id", "lang_pred", "score", "ambiguous")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query(_license_sql())
def op8_license_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template notices in each document."""
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


@query()
def op11_merge_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the byte-level BPE ids of each document and of the text that they decode to."""
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
        FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10""")
def op12_secondary_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, where every seventh label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


@query()
def op13_weighted_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: what is wrong with each, and its cheapest repair."""
    return turns.repair_conversations(turns.damaged(table(spark, sf_dir, "conversations")))
