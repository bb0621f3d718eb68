"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Texts are equal when identical after deleting space, tab, line feed, vertical tab,
form feed and carriage return. Rows are split by the length of that text, surviving
groups by a hash of its beginning, those that survive again by its SHA-256. Only
survivors of one step are joined in the next, so most full hashes never leave the
task that made them. The text itself is read once and never shuffled.

Defined results: a null text is empty, so all empty, blank and null texts are one
group. Ties in length go to the smallest id; a null id comes last. A repeated row
(same id, same text) counts in `group_size`; its copies share every decision, and
`drop_copies` returns it once. Extra columns stay as they are; a clash with an
output column of `exact_dedup` cannot happen, as that returns the id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept, only, without_spaces

PREFIX_CHARS = 64


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: `id`, `chars`, `length`, `prefix`, `sha`."""
    slim = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("chars"),
        without_spaces(F.col(text_col)).alias("norm"),
    )
    return slim.select(
        "id",
        "chars",
        F.octet_length("norm").alias("length"),
        F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
        F.unhex(F.sha2("norm", 256)).alias("sha"),
    )


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys occur more than once."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return rows.join(groups, keys, "left_semi")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, keep_id, group_size, kept, text_sha256` for every row of `docs`.

    Of equal texts the one with the most code points before deletion stays, then
    the one with the smallest id.
    """
    rows = kept(fingerprints(docs, id_col, text_col))
    same_length = _shared(rows.drop("sha", "chars"), ["length"])
    same_prefix = _shared(same_length, ["length", "prefix"]).select("id").distinct()
    candidates = rows.join(same_prefix, rows.id.eqNullSafe(same_prefix.id), "left_semi")
    keys = ["length", "prefix", "sha"]
    groups = (
        candidates.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            # the smallest id of the longest; a null id after all others
            F.min(
                F.struct(-F.col("chars"), F.col("id").isNull().alias("none"), F.col("id"))
            ).alias("best"),
        )
        .filter("group_size > 1")
    )
    return rows.join(groups, keys, "left").select(
        "id",
        F.when(F.col("group_size").isNull(), F.col("id"))
        .otherwise(F.col("best.id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("id").eqNullSafe(F.col("best.id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns; one row of each group.

    Of rows that share an id and differ in spaces only, the longest stays, then the one
    whose text is last in order of bytes.
    """
    decisions = kept(exact_dedup(docs, id_col, text_col))
    per_id = decisions.groupBy("id").agg(
        F.count(F.lit(1)).alias("times"), F.max("kept").alias("stays")
    )
    odd = per_id.filter("times > 1 or id is null").select("id")
    gone = per_id.filter("times > 1 or not stays").filter("id is not null")
    out = only(
        docs.filter(F.col(id_col).isNotNull()), kept(gone.select(F.col("id").alias(id_col))), "left_anti"
    )
    if odd.isEmpty():
        return out
    # rows that share an id or have none: each text that stays, once
    odd = odd.withColumnRenamed("id", "_odd")
    more = docs.join(odd, docs[id_col].eqNullSafe(odd["_odd"]), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    norm = without_spaces(F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    firsts = more.groupBy(F.col(id_col).alias("_id"), F.sha2(norm, 256).alias("_sha")).agg(
        F.max_by(row, F.struct(F.length(text), text)).alias("_row")
    )
    stays = decisions.filter("kept").select("id", "text_sha256").distinct()
    right = firsts.join(
        stays, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_sha") == F.col("text_sha256")), "left_semi"
    )
    return out.unionByName(right.select("_row.*"))
