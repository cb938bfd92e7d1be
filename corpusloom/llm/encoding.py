"""Problem 8: encode a corpus with a public byte-level tokenizer."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.bytebpe import DEFAULT_VOCABULARY, Shared, worker_encoder
from corpusloom.llm.registry import query
from corpusloom.session import table

#: Ids per Arrow batch that leaves a task; a batch holds at least one text.
BATCH_IDS = 2_000_000


def encode(
    df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", vocabulary: str = DEFAULT_VOCABULARY
) -> DataFrame:
    """Token ids of every text, without special tokens: ``(key, out array<int>)``.

    One row per input row, repeated rows included; an empty and a null text give
    an empty list, and strings that name special tokens are ordinary text.  Null
    keys stay.  No shuffle: each partition is encoded where it is read.
    """
    shared = Shared(df.sparkSession, vocabulary)
    key_type = df.schema[key].dataType

    def run(batches):
        encoder = worker_encoder(shared)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            start, held, flat, sizes = 0, 0, [], []

            def flush(end):
                values = np.fromiter(chain.from_iterable(flat), np.int32, sum(sizes))
                offsets = np.zeros(len(sizes) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                return pa.RecordBatch.from_arrays([keys.slice(start, end - start), ids], names=[key, out])

            for i, ids in enumerate(encoder.ids([t or "" for t in texts.to_pylist()])):
                flat.append(ids)
                sizes.append(len(ids))
                held += len(ids)
                if held > BATCH_IDS:
                    yield flush(i + 1)
                    start, held, flat, sizes = i + 1, 0, [], []
            if sizes:
                yield flush(batch.num_rows)

    schema = f"`{key}` {key_type.simpleString()}, `{out}` array<int>"
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def count_tokens(
    df: DataFrame, keep: list[str], text: str = "text", out: str = "n_tokens", vocabulary: str = DEFAULT_VOCABULARY
) -> DataFrame:
    """The columns ``keep`` with the number of tokens of the text; 0 for an empty or null text."""
    shared = Shared(df.sparkSession, vocabulary)

    def run(batches):
        encoder = worker_encoder(shared)
        for batch in batches:
            counts = encoder.counts([t or "" for t in batch.column(len(keep)).to_pylist()])
            columns = [*batch.columns[: len(keep)], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, out])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{out}` bigint"])
    return df.select(*keep, text).mapInArrow(run, schema)


@query("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
