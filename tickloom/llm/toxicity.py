"""Toxicity of texts: a bidirectional gated recurrent network over words.

The network (`gru.py`) is trained on the driver from a bounded sample of labelled
documents, then scores every window of 64 words, half overlapping, of every text.
The score of a text is the highest of its windows, so a short passage in a long
text counts in full.

The sample: at most `SAMPLE` documents per label, of at most `SAMPLE_CHARS`
characters, chosen by a hash of their id among those whose crc32(id) mod 3 is not 1.

Defined results: null and empty texts have one empty window and get the score the
network gives to nothing. Labels that are null are no labels; a document labelled
twice counts as toxic if one label says so. Without labels of both kinds every
score is the share of toxic labels (0 if there are none). Repeated rows are scored
alike. A null id is not held out and never in the sample. An empty table gives an
empty result. Extra columns are ignored; language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import grams, gru

SAMPLE = {1: 1_500, 0: 3_500}
SAMPLE_CHARS = 20_000
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> pa.Table:
    """`text, toxic` of the training sample."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    short = slim.filter(F.length("text") <= SAMPLE_CHARS).select("doc_id").distinct()
    usable = known.join(short, "doc_id")
    chosen = [
        usable.filter(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for kind, n in SAMPLE.items()
    ]
    picked = chosen[0].unionByName(chosen[1])
    rows = slim.filter(F.length("text") <= SAMPLE_CHARS).join(F.broadcast(picked), "doc_id")
    return rows.dropDuplicates(["doc_id"]).orderBy("doc_id").select("text", "toxic").toArrow()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    shape: gru.Shape = gru.Shape(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> gru.Network | float:
    """A trained network, or the share of toxic labels where only one kind exists."""
    rows = sample(docs, labels, id_col, text_col)
    toxic = rows.column("toxic").to_numpy().astype(np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return float(toxic.max()) if len(toxic) else 0.0
    texts = pa.concat_arrays(rows.column("text").chunks)
    raw, offsets = grams.text_bytes(texts)
    return gru.train(gru.Text(raw, offsets, shape), toxic, shape)


def score(
    docs: DataFrame,
    model: gru.Network | float,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, score` for every row of `docs`."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if isinstance(model, float):
        return slim.select("doc_id", F.lit(model).alias("score"))
    # some 2 MB; plain values, as workers may not have this package
    plain = (asdict(model.shape), model.known, model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, known, weights = shared.value
        network = gru.Network(gru.Shape(**shape), known, weights)
        for batch in batches:
            for ids, raw, offsets in grams.slices(batch):
                found = network.scores(gru.Text(raw, offsets, network.shape))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found)], ["doc_id", "score"])

    return slim.mapInArrow(run, "doc_id long, score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs`."""
    scored = score(docs, fit(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, with their columns; each by its own text."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    if isinstance(model, float):
        return docs.filter(F.lit(model) < THRESHOLD)
    plain = (asdict(model.shape), model.known, model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, known, weights = shared.value
        network = gru.Network(gru.Shape(**shape), known, weights)
        for batch in batches:
            found = [
                network.scores(gru.Text(raw, offsets, network.shape))
                for _, raw, offsets in grams.slices(batch, at, at)
            ]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
