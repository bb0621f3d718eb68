"""Language of texts by prediction by partial matching.

Per language a context tree of bytes (`ppm.py`) is fitted on the driver from a bounded
sample of labelled documents. Every whole text is then coded with each tree, and the
language with the shortest code is its language; the score is that language's share
when each has the probability 2 ** -length.

The sample: of the `LANGUAGES` most frequent languages, some `SAMPLE` documents each, of at
most `SAMPLE_CHARS` characters, chosen by a hash of their id among those whose crc32(id)
mod 3 is not 1. A language without such a document is not learned.

Defined results: a null text, or one without a letter, is `und` with score 0; so is every
text if no language was learned. Of equally short codes the language first in order of
name is taken. Documents without language or id are never in the sample, an id that
stands in several rows is there once. Repeated rows are scored alike; a null id is not held out. An
empty table gives an empty result. Extra columns are ignored; language, source and id are
no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import grams, ppm

LANGUAGES = 200
SAMPLE = 500
SAMPLE_CHARS = 20_000
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> pa.Table:
    """`lang, text` of the training sample, some `SAMPLE` rows a language."""
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(
        F.col("lang").isNotNull()
        & F.col("id").isNotNull()
        & F.col("text").isNotNull()
        & (F.length("text") <= SAMPLE_CHARS)
        & ~held_out(F.col("id"))
    )
    sizes = slim.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return slim.select("lang", "text").limit(0).toArrow()
    # a language keeps the ids whose hash is below its share
    share = F.shiftrightunsigned(F.xxhash64("id"), 1) / F.lit(float(2**63))
    wanted = [
        (F.col("lang") == row["lang"]) & (share < float(SAMPLE) / row["count"]) for row in sizes
    ]
    return (
        slim.filter(reduce(Column.__or__, wanted))
        .groupBy("id", "lang")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", "id")
        .select("lang", "text")
        .toArrow()
    )


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> tuple[list[str], list[tuple[np.ndarray, ...]]]:
    """The learned languages, by name, and their trees."""
    rows = sample(docs, id_col, text_col, lang_col).combine_chunks()
    langs = sorted(set(rows.column("lang").to_pylist()))
    samples = []
    for lang in langs:
        own = rows.filter(pa.compute.equal(rows.column("lang"), lang)).column("text")
        samples.append(grams.text_bytes(pa.concat_arrays(own.chunks)))
    return langs, ppm.fit(samples) if langs else []


def predict(
    docs: DataFrame,
    model: tuple[list[str], list[tuple[np.ndarray, ...]]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, lang_pred, score` for every row of `docs`."""
    langs, levels = model
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    if not langs:
        return slim.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # some 10 MB for four languages, bounded by the sample
    shared = docs.sparkSession.sparkContext.broadcast((langs, levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, trees = shared.value
        names, scorer = np.array([*names, UNKNOWN], dtype=object), ppm.Scorer(trees)
        for batch in batches:
            done = 0
            for ids, raw, offsets in grams.slices(batch):
                letters = batch.column(2).slice(done, len(ids)).to_numpy(zero_copy_only=False)
                done += len(ids)
                lengths = scorer.texts(raw, offsets)
                best = lengths.argmin(axis=1)
                over = (lengths - lengths.min(axis=1, keepdims=True)) / ppm.BIT
                score = np.where(letters, 1 / np.exp2(-over).sum(axis=1), 0.0)
                best = np.where(letters, best, len(names) - 1)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(names[best], pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for every row of `docs`."""
    found = predict(docs, fit(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
