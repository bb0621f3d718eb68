"""The operators over whole tables, as registered queries, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import conversation_sql
from tickloom.llm.common import read
from tickloom.llm.conversation_repair import damaged, repair_conversations
from tickloom.llm.conversation_trie import conversation_trie
from tickloom.llm.exact_dedup import exact_dedup
from tickloom.llm.language_id import languages
from tickloom.llm.mix import mix_sources
from tickloom.llm.near_vectors import near_vectors
from tickloom.llm.pack import pack_documents
from tickloom.llm.parity_join import jaccard_classes
from tickloom.llm.pii import KINDS, personal_data
from tickloom.llm.phrase_dedup import remove_repeated_passages
from tickloom.llm.suffix_dedup import remove_repeated_bytes
from tickloom.llm.toxicity import toxicity
from tickloom.llm.url_filter import Rule, filter_urls

# Fixed values.
URL_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]


TOKENIZER = "byte_bpe_50k.json"


def tokenizer_spec(name: str = TOKENIZER) -> str:
    return Path(public_tokenizers.path(name)).read_text()


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_spec(), with_ids=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read(spark, sf_dir, "documents")).withColumn(
        "spans", F.arrays_zip("kind", "start", "end", "base")
    )

    def text(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    base = F.filter("spans", lambda s: s["base"])

    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)

    counts = [number(kind) for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return filter_urls(pages, URL_RULES).withColumnRenamed("id", "page_id").drop("branch")


def op10_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(read(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read(spark, sf_dir, "conversations"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_vectors": op1_near_vectors,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_personal_data": op4_personal_data,
    "op5_mix_sources": op5_mix_sources,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_phrase_dedup": op10_phrase_dedup,
    "op11_language_id": op11_language_id,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op1_near_vectors": """
        WITH RECURSIVE v AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b
          FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(id, c) AS (
          SELECT vec_id, vec_id FROM embeddings
          UNION
          SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id)
        SELECT r.id AS vec_id, coalesce(n.n_links, 0) AS n_links, min(r.c) AS component_id,
               r.id = min(r.c) AS kept
        FROM reach r LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = r.id
        GROUP BY r.id, n.n_links
    """,
    "op7_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS chars,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
          FROM documents)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (SELECT doc_id,
                     first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY norm) AS group_size,
                     sha256(norm) AS text_sha256
              FROM t)
    """,
    "op6_jaccard_join": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x20\x09-\x0D]+') AS words
          FROM documents),
        g AS (
          SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS shingle
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i
                FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        links AS (
          SELECT a, b FROM (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2)
          JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * common >= 90 * (na.n + nb.n - common)),
        reach(id, c) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id)
        SELECT id AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
        FROM reach LEFT JOIN n ON n.doc_id = id GROUP BY id
    """,
    "op8_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        p AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM d),
        s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte,
                CASE WHEN 2 * i + 100 <= length(h) THEN substr(h, 2 * i + 1, 100) END AS string
              FROM p),
        f AS (SELECT string, min(doc_id) AS first FROM s WHERE string IS NOT NULL GROUP BY string),
        r AS (SELECT s.doc_id, i, byte, coalesce(first < s.doc_id, false) AS repeated
              FROM s LEFT JOIN f ON f.string = s.string),
        m AS (SELECT doc_id, i, byte, bool_or(repeated) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM r),
        e AS (SELECT *, gone AND NOT coalesce(
                lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM m),
        k AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed,
                count(*) FILTER (begins) AS spans,
                string_agg(byte, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed,
               coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
    "op10_phrase_dedup": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
          FROM documents),
        s AS (SELECT doc_id, i, words[i] AS word,
                CASE WHEN i + 49 <= len(words) THEN array_to_string(words[i : i + 49], ' ') END AS passage
              FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
        f AS (SELECT passage, min(doc_id) AS first FROM s WHERE passage IS NOT NULL GROUP BY passage),
        r AS (SELECT s.doc_id, i, word, coalesce(first < s.doc_id, false) AS repeated
              FROM s LEFT JOIN f ON f.passage = s.passage),
        m AS (SELECT doc_id, i, word, bool_or(repeated) OVER (
                PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM r),
        k AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed,
                string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON k.doc_id = d.doc_id
    """,
    "op12_conversation_trie": conversation_sql.TRIE,
    "op13_conversation_repair": conversation_sql.REPAIR,
}
