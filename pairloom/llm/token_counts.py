"""Token counts without materialising ids.

Method: a document is cut into pre-tokens that the tokenizer's merges never cross. Per block of documents the
pre-token frequencies are gathered (one row per block and distinct pre-token, carrying packed document postings),
the rows meet by pre-token in one exchange, each distinct pre-token is encoded once there, and the piece counts are
joined to the frequency rows and summed per document.

Scale: the only large exchange carries about 3 bytes per (document, distinct pre-token). A pre-token of every document
gives one row a block, not one a document; where it is in more than ``_COMMON`` documents of a block, its rows are dealt
by the block to ``_SHARES`` shares, and it is encoded once in each. A task holds the sums of ``_FLUSH`` blocks at most.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, binary_view, load_tokenizer, slices, tokenizer_file

_BLOCK = 16_384
_FLUSH = 128
_COMMON = 512
_SHARES = 1024
_POSTING = [("doc", "<u2"), ("n", "u1")]
_LOOSE = re.compile(r" (?:\s|$)")
_CUT = re.compile(r" (?=\S)")


def pre_tokens(text: str) -> list[str]:
    """Parts of ``text`` between the spaces that precede a non-space character.

    The byte-level BPE pattern always breaks right before such a space, and what it does inside a part depends on
    that part alone, so the pieces of a text are those of its first part and of ``" " + part`` for the others.
    """
    return _CUT.split(text) if _LOOSE.search(text) else text.split(" ")


class _Index(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "text", _BLOCK, 32 << 20):
            led, first, heads = _Index(), _Index(), []
            docs, words, counts = [], [], []
            n_bytes = np.zeros(part.num_rows, np.int64)
            for i, text in enumerate(part.column("text").to_pylist()):
                n_bytes[i] = len(text.encode())
                head, *rest = pre_tokens(text)
                if head:
                    heads.append((first[head], i))
                found = Counter(rest)
                docs.append(len(found))
                words.append(np.fromiter(map(led.__getitem__, found), np.int32, len(found)))
                counts.append(np.fromiter(found.values(), np.int32, len(found)))
            doc = np.repeat(np.arange(part.num_rows, dtype=np.int32), docs)
            word, n = np.concatenate(words), np.concatenate(counts)
            if heads:
                w, d = np.array(heads).T
                word, doc, n = np.r_[word, w + len(led)], np.r_[doc, d], np.r_[n, np.ones(len(w), np.int32)]
            while (big := n > 255).any():  # a posting holds up to 255; the rest goes to further postings
                word, doc, n = np.r_[word, word[big]], np.r_[doc, doc[big]], np.r_[np.where(big, 255, n), n[big] - 255]
            order = np.argsort(word, kind="stable")
            packed = np.empty(len(order), _POSTING)
            packed["doc"], packed["n"] = doc[order], n[order]
            ends = np.cumsum(np.bincount(word, minlength=len(led) + len(first))) * packed.itemsize
            head = np.c_[part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), n_bytes, part.column("doc_id").is_null().to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([None], pa.string()), pa.array([head.astype("<i8").tobytes()])], ["block", "word", "data"])
            if len(ends):
                text = pa.array([f" {w}" for w in led] + list(first), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ends), block)), text, binary_array(packed.tobytes(), np.r_[0, ends])], ["block", "word", "data"])
            block += 1


def _join_counts(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tok = load_tokenizer(tokenizer)
        sums: dict[int, object] = {}
        last = ("", 0)

        def flush():
            keys = list(sums)
            out = [sums[k].astype("<i8").tobytes() for k in keys]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([False] * len(keys), pa.bool_()), pa.array(out, pa.binary())], ["block", "head", "data"])

        for batch in batches:
            is_head = batch.column("word").is_null()
            heads = batch.filter(is_head)
            if heads.num_rows:
                yield pa.RecordBatch.from_arrays([heads.column("block"), pa.array([True] * heads.num_rows), heads.column("data")], ["block", "head", "data"])
            rows = batch.filter(batch.column("word").is_valid())
            if not rows.num_rows:
                continue
            coded = rows.column("word").dictionary_encode()  # rows are sorted: every distinct pre-token is one run
            distinct = coded.dictionary.to_pylist()
            todo = distinct[1:] if distinct[0] == last[0] else distinct
            pieces = [len(e) for e in tok.encode_batch_fast(todo, add_special_tokens=False)]
            if len(todo) < len(distinct):
                pieces.insert(0, last[1])
            last = (distinct[-1], pieces[-1])
            per_row = np.array(pieces, np.int64)[coded.indices.to_numpy()]
            data, at = binary_view(rows.column("data"))
            posting = np.frombuffer(data.tobytes(), _POSTING)
            lengths = np.diff(at) // posting.itemsize
            blocks, slot = np.unique(rows.column("block").to_numpy(), return_inverse=True)
            place, worth, n = np.repeat(slot, lengths), posting["n"] * np.repeat(per_row, lengths), len(blocks)
            for lo in range(0, n, _FLUSH):
                own = slice(None) if n <= _FLUSH else (place >= lo) & (place < lo + _FLUSH)
                total = np.bincount((place[own] - lo) * _BLOCK + posting["doc"][own], worth[own], min(_FLUSH, n - lo) * _BLOCK)
                for b, s in zip(blocks[lo : lo + _FLUSH].tolist(), total.reshape(-1, _BLOCK), strict=True):
                    s = s[: np.flatnonzero(s)[-1] + 1].astype(np.int64)
                    if b in sums and len(sums[b]) >= len(s):
                        sums[b][: len(s)] += s
                    else:
                        if b in sums:
                            s[: len(sums[b])] += sums[b]
                        sums[b] = s
                if len(sums) > _FLUSH:
                    yield flush()
        if sums:
            yield flush()

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    now, head, total = None, None, np.zeros(_BLOCK, np.int64)

    def result():
        h = np.frombuffer(head, "<i8").reshape(-1, 3)
        return pa.RecordBatch.from_arrays([pa.array(h[:, 0], pa.int64(), mask=h[:, 2] != 0), pa.array(h[:, 1]), pa.array(total[: len(h)])], ["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for block, is_head, data in zip(*(batch.column(c).to_pylist() for c in ("block", "head", "data")), strict=True):
            if block != now:
                if head is not None:
                    yield result()
                now, head, total = block, None, np.zeros(_BLOCK, np.int64)
            if is_head:
                head = data
            else:
                s = np.frombuffer(data, "<i8")
                total[: len(s)] += s
    if head is not None:
        yield result()


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    Nulls and empty texts have 0 bytes and 0 tokens; a null id stays null; repeated rows are counted one by one;
    other columns are ignored whatever their names; an empty table gives an empty result. Special strings in a text
    are one token each, as is the library's default.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spread = rows.mapInArrow(_frequencies, "block long, word string, data binary")
    share = F.when(F.octet_length("data") > _COMMON * 3, F.pmod(F.xxhash64("block"), F.lit(_SHARES))).otherwise(F.lit(-1).cast("long"))
    key = F.when(F.col("word").isNull(), F.xxhash64("block")).otherwise(F.xxhash64("word", share))
    met = spread.repartition(key).sortWithinPartitions("word")
    sums = met.mapInArrow(_join_counts(tokenizer or tokenizer_file()), "block long, head boolean, data binary")
    counted = sums.repartition("block").sortWithinPartitions("block").mapInArrow(_add_up, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
