"""Helpers shared by the training-data operators: scratch tables, Arrow batches and executor-side tokenizers."""

from __future__ import annotations

import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise, scratch_dir

__all__ = ["binary_array", "binary_view", "load_ranks", "load_tokenizer", "located", "materialise", "scratch_dir", "slices", "tokenizer_file"]


def located(docs: DataFrame, id_col: str) -> tuple[DataFrame, str | None]:
    """(``docs``, a long column that tells its rows apart, or None where the ids themselves do).

    If ids repeat or are null, the rows are written once to the shared scratch folder with a number each; the column's
    name is one that ``docs`` does not have.
    """
    if docs.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.count("*").alias("n")).filter("n > 1 or id is null").isEmpty():
        return docs, None
    row = "_row"
    while row in map(str.lower, docs.columns):
        row += "_"
    return materialise(docs.withColumn(row, F.monotonically_increasing_id())), row


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Default place of a public vocabulary file; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """One tokenizer per Python worker, single-threaded, with truncation and padding off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


#: Fixed value: the byte-level pre-token pattern of the published 50k vocabulary.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def load_ranks(path: str):
    """A rank-merging encoder with the vocabulary of the tokenizer file ``path``, or None where it could differ.

    It gives the file's ids only for plain byte-level BPE whose merges are listed in the order of their ids, without
    normalizer, prefix space or dropout. It knows no special tokens.
    """
    import json

    import tiktoken

    spec = json.loads(open(path, encoding="utf-8").read())
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec["normalizer"] is None
    if not plain or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    vocab, added = model["vocab"], {t["content"] for t in spec["added_tokens"]}
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(made):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


def slices(batch: pa.RecordBatch, column: str, max_rows: int = 4096, max_bytes: int = 16 << 20):
    """Cut an Arrow batch into consecutive slices of at most ``max_rows`` rows and about ``max_bytes`` of ``column``.

    A row longer than ``max_bytes`` gets a slice of its own; no row is cut.
    """
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (i - start >= max_rows or total + n > max_bytes):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def binary_array(data: bytes | memoryview, offsets) -> pa.Array:
    """An Arrow binary column over one packed buffer; ``offsets`` are byte offsets, one more than rows."""
    import numpy as np

    offsets = np.asarray(offsets, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])


def binary_view(column: pa.Array):
    """(packed bytes as a numpy uint8 view, int offsets relative to it) of a binary or string column without nulls."""
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = np.int64 if pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
