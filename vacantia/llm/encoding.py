"""Problem 8: the corpus as token ids of a public tokenizer.

Method: ``vacantia.llm.bpe``. The vocabulary file, a fixed 1.5 MB, is read on the driver and broadcast; each
Python worker compiles it once and keeps its transducer for all batches. Texts stay in Arrow on both sides."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from vacantia.llm.bpe import StreamDecoder, Transducer
from vacantia.runtime import ship_package

#: Where the public vocabularies are; a parameter of every function that needs one.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

_LOADED: dict[int, Transducer] = {}


def _transducer(vocabulary: bytes) -> Transducer:
    key = hash(vocabulary)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Transducer(vocabulary)
    return _LOADED[key]


def _shared(df: DataFrame, path: str):
    ship_package(df.sparkSession)
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key`` and ids (array<int>): each text's tokens without special tokens.

    Null and empty texts have an empty list; strings that look like special tokens are ordinary text; texts of any
    length are read whole, in time proportional to their bytes. Other columns of ``df`` are not read."""
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _transducer(shared.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            offsets, flat, size = [0], [], 0
            for start in range(len(texts)):
                ids = own.encode(texts[start].as_py())
                flat.append(pa.array(ids, pa.int32()))
                size += len(ids)
                offsets.append(size)
            values = pa.concat_arrays(flat) if flat else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["k", "ids"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``key`` and n_tokens (int): the sizes of the texts in tokens; 0 for null and empty texts."""
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _transducer(shared.value)
        for batch in batches:
            sizes = [len(own.encode(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32())], names=["k", "n_tokens"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"k {kind}, n_tokens int").withColumnRenamed("k", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str = VOCABULARY) -> DataFrame:
    """``key`` and text: the texts that lists of ids spell; a null list spells an empty text."""
    shared = _shared(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _transducer(shared.value)
        for batch in batches:
            texts = [StreamDecoder(own.bytes_of).decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["k", "text"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.select(key, ids).mapInArrow(run, f"k {kind}, text string").withColumnRenamed("k", key)
