"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each partition keeps ``open[h]``, the number of windows filled to level ``h``.
A document remainder of size ``s`` goes to the level ``h`` (0: a new window) for
which the sum of ``open[h]**2`` afterwards is least; ties go to the fullest level.
Documents longer than a window are first cut into whole windows. When a partition
ends, its partly filled windows are joined end to end and cut at window bounds; the
last remainder is cut at powers of two, which need no padding. Nothing is shuffled.

Defined results: a null or empty text is one end-of-document id. A null doc_id is kept
as null; repeated rows are packed once each; an empty table gives no rows. Other
columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, token_ids binary, doc_tokens long, sequence_id long, offset long"


def _byte_names() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@cache
def encoder(vocabulary: bytes):
    """The byte-level BPE in a ``tokenizers`` file, as ranks for a faster coder; one for all tasks of a Python worker.

    In this kind of vocabulary the merges stand in order of their ids, so both give the same ids.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    source = Tokenizer.from_buffer(vocabulary)
    added = {t.content: i for i, t in source.get_added_tokens_decoder().items()}
    byte = _byte_names()
    ranks = {bytes(byte[c] for c in name): i for name, i in source.get_vocab(with_added_tokens=True).items() if name not in added}
    return tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


def token_ids(coder, text: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit bytes; added tokens that it spells are those tokens."""
    return coder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() if text else b""


class Packer:
    """Level array and open windows of one partition. Pieces: (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, first_id: int):
        self.window, self._next = window, first_id
        self._open = np.zeros(window + 1, np.int64)
        self._at: list[list[list]] = [[] for _ in range(window)]

    def _close(self, pieces: list) -> Iterator[tuple]:
        seq, at = self._next, 0
        self._next += 1
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, ids, total, seq, at
            at += len(ids) // 4

    def level_for(self, size: int) -> int:
        n, w = self._open, self.window
        leave = np.where(n[: w - size + 1] > 0, 1 - 2 * n[: w - size + 1], np.iinfo(np.int64).max // 4)
        leave[0] = 0
        enter = 2 * n[size:] + 1
        enter[-1] = 0
        cost = leave + enter
        return int(w - size - np.argmin(cost[::-1]))

    def add(self, doc, ids: bytes, total: int) -> Iterator[tuple]:
        w, start = self.window, 0
        while len(ids) - 4 * start >= 4 * w:
            yield from self._close([(doc, start, ids[4 * start : 4 * (start + w)], total)])
            start += w
        if size := len(ids) // 4 - start:
            level = self.level_for(size)
            pieces = self._at[level].pop() if level else []
            if level:
                self._open[level] -= 1
            pieces.append((doc, start, ids[4 * start :], total))
            if level + size == w:
                yield from self._close(pieces)
            else:
                self._at[level + size].append(pieces)
                self._open[level + size] += 1

    def finish(self) -> Iterator[tuple]:
        left = [x for level in reversed(range(1, self.window)) for pieces in self._at[level] for x in pieces]
        ahead = sum(len(x[2]) // 4 for x in left)
        room, pieces = 0, []
        for doc, start, ids, total in left:
            while ids:
                if not room:
                    room = self.window if ahead >= self.window else 1 << (ahead.bit_length() - 1)
                n = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n], total))
                start, ids, room, ahead = start + n, ids[4 * n :], room - n, ahead - n
                if not room:
                    yield from self._close(pieces)
                    pieces = []


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048) -> DataFrame:
    """One row per piece, with its token ids (little-endian unsigned 32-bit) and its place.

    The driver reads the vocabulary file, some megabytes whatever the input, and sends it to the executors."""
    with open(tokenizer_path, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("token_ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, coder = Packer(window, TaskContext.get().partitionId() << 36), encoder(sent.value)
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []
        held = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

        def pieces():
            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    ids = token_ids(coder, text.as_py()) + end
                    yield from packer.add(doc.as_py(), ids, len(ids) // 4)
            yield from packer.finish()

        for row in pieces():
            rows.append(row)
            held += row[2] * 4 + 64
            if held > 4 << 20:
                yield flush()
                rows, held = [], 0
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
