"""Vocabulary files: read once on the driver and sent to the tasks as a broadcast.

The files are of fixed size (about 0.5 to 2 MB), so the broadcast does not grow with the data and
executors need not hold the files.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

_LOADED: dict[tuple[str, int], object] = {}


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def broadcast_file(spark: SparkSession, path: str):
    """The file's bytes as a broadcast variable."""
    with open(path, "rb") as fh:
        return spark.sparkContext.broadcast(fh.read())


def piece_model(data: bytes):
    """A sentencepiece processor, one per Python worker and model."""
    key = ("piece", hash(data))
    if key not in _LOADED:
        import sentencepiece

        _LOADED[key] = sentencepiece.SentencePieceProcessor(model_proto=data)
    return _LOADED[key]


def json_tokenizer(data: bytes):
    """A tokenizers.Tokenizer, one per Python worker and file; its threads are left to Spark."""
    key = ("json", hash(data))
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[key] = Tokenizer.from_str(data.decode())
    return _LOADED[key]
