"""Packing documents into training sequences: sum-of-squares online packing.

Every task packs the documents it reads, so nothing is shuffled.  A document that fills whole windows
gets them; what remains of it is one item, put into the open window, or a new one, that leaves the smallest
sum of squared counts of partially filled windows.  Those counts are an array by fill level, so a choice
looks at a fixed number of levels, however many windows are open.  When a task ends, the windows still open
fill each other up, the emptiest being cut first: at most one sequence of a task is padded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from corpusflow.llm.common import pick

SEQUENCE_TOKENS = 1024
END_OF_DOCUMENT = 0
#: Bits of a sequence id that count the sequences of one task.
SEQUENCES_PER_TASK_BITS = 40
#: Pieces that a task gathers before it passes them on.
PIECES_AT_ONCE = 4096
#: Fixed value: the split rule of byte-level tokenizer files.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECE_SCHEMA = (
    "doc_id BIGINT, start BIGINT, length BIGINT, ids BINARY, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: itself where it prints, else the next free one."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Encoder:
    """Ids of texts, little-endian unsigned 32-bit, by a tokenizer file.

    A byte-level file whose ids follow the order of its merges is also a table of ranks, for which there is a
    matcher several times as fast; texts with added tokens in them, and files of other kinds, go the usual way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rule = json.loads(self.tokenizer.to_str())
        self.added = [token["content"] for token in rule["added_tokens"]]
        self.matcher = self._matcher(rule)

    @staticmethod
    def _matcher(rule: dict):
        import tiktoken

        cutter, model = rule["pre_tokenizer"] or {}, rule["model"]
        if rule["normalizer"] is not None or cutter.get("type") != "ByteLevel" or not cutter.get("use_regex", True) or cutter["add_prefix_space"]:
            return None
        if model["type"] != "BPE" or any(model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        byte_of, vocab, added = _byte_of(), model["vocab"], {token["id"] for token in rule["added_tokens"]}
        merged = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
        ranks = {bytes(byte_of[c] for c in token): id for token, id in vocab.items() if id not in added}
        if merged != sorted(merged) or len(ranks) != 256 + len(merged) or min(merged, default=256) < 256:
            return None
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.matcher is not None and not any(token in text for token in self.added):
            try:
                return self.matcher.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # its regex gives up on very long runs, of white space above all
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """The sequences of one task."""

    def __init__(self, size: int, first_id: int):
        self.size, self.next_id = size, first_id
        self.count = np.zeros(size + 1, np.int64)  # open windows by fill level
        self.open: list[list[list]] = [[] for _ in range(size)]  # their pieces, by fill level
        self.levels = np.arange(size + 1)
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        tokens, at = len(ids) // 4, 0
        while tokens - at >= self.size:
            self._close([(doc_id, at, self.size, ids[4 * at : 4 * (at + self.size)], tokens)])
            at += self.size
        if tokens > at:
            self._place((doc_id, at, tokens - at, ids[4 * at :], tokens))

    def _place(self, piece: tuple) -> None:
        length, count = piece[2], self.count
        fits = np.flatnonzero(count[1 : self.size - length + 1]) + 1
        # change of the sum of squares: one window fewer at the old level, one more at the new one, unless it is full
        best, change = 0, 2 * count[length] + 1
        if len(fits):
            after = fits + length
            change_by_level = 1 - 2 * count[fits] + np.where(after < self.size, 2 * count[after] + 1, 0)
            k = len(fits) - 1 - int(np.argmin(change_by_level[::-1]))  # of equals the fullest
            if change_by_level[k] <= change:
                best = int(fits[k])
        window = self.open[best].pop() if best else []
        count[best] -= best > 0
        window.append(piece)
        level = best + length
        if level == self.size:
            self._close(window)
        else:
            self.open[level].append(window)
            count[level] += 1

    def _close(self, window: list[tuple]) -> None:
        offset = 0
        for doc_id, start, length, ids, tokens in window:
            self.done.append((doc_id, start, length, ids, tokens, self.next_id, offset))
            offset += length
        self.next_id += 1

    def finish(self) -> None:
        """Fill the fullest open windows up with the pieces of the emptiest, cutting where needed."""
        windows = [(level, w) for level in range(1, self.size) for w in self.open[level]]
        self.open, self.count[:] = [[] for _ in range(self.size)], 0
        low, high = 0, len(windows) - 1
        while low <= high:
            level, window = windows[high]
            high -= 1
            while level < self.size and low <= high:
                given = windows[low][1]
                doc_id, start, length, ids, tokens = given.pop()
                take = min(length, self.size - level)
                window.append((doc_id, start, take, ids[: 4 * take], tokens))
                level += take
                if take < length:
                    given.append((doc_id, start + take, length - take, ids[4 * take :], tokens))
                if not given:
                    low += 1
            self._close(window)

    def take(self) -> pa.RecordBatch:
        rows, self.done = self.done, []
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def pack(documents: DataFrame, tokenizer_path: str, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Pieces of ``documents`` (``doc_id, text``): ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers; every document ends with
    id 0.  ``start`` counts the ids of the document before the piece, ``offset`` those of the sequence.  The
    file at ``tokenizer_path`` has to be there on every worker.  Null and empty texts are the closing id
    alone; ids may be null or repeat, every row is packed by itself; no rows give no rows.  Further
    columns are not looked at.
    """

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(sequence_tokens, TaskContext.get().partitionId() << SEQUENCES_PER_TASK_BITS)
        end, encode = END_OF_DOCUMENT.to_bytes(4, "little"), encoder(tokenizer_path).encode
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                packer.add(doc_id.as_py(), encode(text.as_py() or "") + end)
                if len(packer.done) >= PIECES_AT_ONCE:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    rows = pick(documents, "doc_id", "text")
    return rows.selectExpr("cast(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(pack_task, PIECE_SCHEMA)
