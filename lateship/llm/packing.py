"""Sum-of-squares packing of tokenised documents into fixed windows.

Each task packs the documents of its own partition online: a document (or
what remains of it after whole windows are cut off) goes to the fill level
that keeps the sum of the squared numbers of partly filled windows smallest.
The only state is the level array - how many windows stand open at each fill
- and the pieces of the open windows, at most ``max_open`` of them. What is
still open at the end of a partition, or when that many are open, is levelled
out: the emptiest windows are taken apart to fill the fullest, cutting where
needed, so that at most one window of a partition stays partly filled; that
one is cut into power-of-two sequences, which need no padding.

No shuffle, and nothing passes through the driver. A partition's result
depends on its rows and their order only, so a lost task that is run again
over the same input files gives the same pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

WINDOW = 1024
END_ID = 0
MAX_OPEN = 4096

#: Characters for whose classes (letter, digit, white space) all versions of
#: the Unicode tables agree; texts with others, or with a special token's
#: string, are encoded by the reference library itself.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-ſΑ-ΡΣ-ωА-я"
                    "‐-‧‰-›€、-。ぁ-ゖァ-ヺ一-龥]*")


@lru_cache(maxsize=4)
def encoder(json_path: str, ranks_path: str | None):
    """``text -> ids`` of a byte-level BPE vocabulary.

    ``json_path`` is the vocabulary of the ``tokenizers`` library and defines
    the result. ``ranks_path``, the same vocabulary as ranks, allows a faster
    encoder for texts on which both are known to agree.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(json_path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def exact(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    if ranks_path is None:
        return exact
    import base64

    import public_tokenizers
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not any(s in text for s in special):
            return np.array(fast.encode_ordinary(text), dtype="<u4")
        return exact(text)

    return encode


class Packer:
    """Sum-of-squares packing of one partition's documents."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, first_sequence: int = 0):
        self.window, self.max_open, self.next = window, max_open, first_sequence
        self.level = np.zeros(window + 1, dtype=np.int64)
        self.open: list[list] = [[] for _ in range(window + 1)]
        self.n_open = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def place(self, doc, ids: np.ndarray) -> None:
        """Put one document's ids into windows."""
        w, total = self.window, len(ids)
        whole = total - total % w
        for start in range(0, whole, w):
            self._emit([(doc, start, ids[start:start + w], total)])
        if whole < total:
            self._place_piece((doc, whole, ids[whole:], total))

    def _place_piece(self, piece: tuple) -> None:
        w, level, size = self.window, self.level, len(piece[2])
        # Change of the sum of squares if the piece goes to each fill level.
        top = w - size
        change = 2 * (level[size:w + 1] - level[:top + 1]) + 2
        change[top] -= 2 * level[w] + 1                   # a full window leaves the array
        change[0] = 2 * level[size] + 1                   # a new window
        change[1:][level[1:top + 1] == 0] = np.iinfo(np.int64).max
        at = top - int(np.argmin(change[::-1]))           # ties: the fullest
        if at:
            pieces = self.open[at].pop()
            level[at] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + size == w:
            self._emit(pieces)
            return
        self.open[at + size].append(pieces)
        level[at + size] += 1
        self.n_open += 1
        if self.n_open >= self.max_open:
            self.level_out()

    def level_out(self) -> None:
        """Take the emptiest open windows apart to fill the fullest."""
        windows = [(fill, p) for fill in range(self.window, 0, -1) for p in self.open[fill]]
        self.open = [[] for _ in range(self.window + 1)]
        self.level[:] = 0
        self.n_open = 0
        lo, hi = 0, len(windows) - 1
        loose: list[tuple] = []
        while lo <= hi:
            fill, pieces = windows[lo]
            lo += 1
            while fill < self.window:
                if not loose:
                    if lo > hi:
                        break
                    loose = windows[hi][1][::-1]
                    hi -= 1
                doc, start, ids, total = loose.pop()
                room = self.window - fill
                if len(ids) > room:
                    loose.append((doc, start + room, ids[room:], total))
                    ids = ids[:room]
                pieces.append((doc, start, ids, total))
                fill += len(ids)
            if fill == self.window:
                self._emit(pieces)
            else:
                loose = pieces[::-1]
        fill = 0
        rest: list[tuple] = []
        for p in loose[::-1]:  # what a taken-apart window has left over may exceed nothing: it was one window
            rest.append(p)
            fill += len(p[2])
        if rest:
            self.open[fill].append(rest)
            self.level[fill] = 1
            self.n_open = 1

    def finish(self) -> None:
        """Close everything: at most one window is left, cut into powers of two."""
        self.level_out()
        for fill in range(self.window):
            for pieces in self.open[fill]:
                left = pieces[::-1]
                size = 1 << (self.window.bit_length() - 1)
                while size:
                    if fill & size:
                        room, out = size, []
                        while room:
                            doc, start, ids, total = left.pop()
                            if len(ids) > room:
                                left.append((doc, start + room, ids[room:], total))
                                ids = ids[:room]
                            out.append((doc, start, ids, total))
                            room -= len(ids)
                        self._emit(out)
                    size >>= 1
        self.open = [[] for _ in range(self.window + 1)]
        self.level[:] = 0
        self.n_open = 0


def pack_sequences(docs: DataFrame, json_path: str, ranks_path: str | None = None, id_col: str = "doc_id",
                   text_col: str = "text", window: int = WINDOW, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: ``(id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)``.

    A document is its token ids and one end id. Sequences are gapless from
    offset 0 and exactly full, but for at most one window a partition that is
    cut into power-of-two sequences.

    Defined results: a null text is an empty one (one piece: the end id);
    repeated rows and ids are packed each on their own; a null id stays null;
    very long texts are encoded whole and cut into full windows; an empty
    input gives no row; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = StructType([StructField(id_col, id_type), *[StructField(n, LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode = encoder(json_path, ranks_path)
        packer = Packer(window, max_open, TaskContext.get().partitionId() << 32)
        end = np.array([END_ID], dtype="<u4")
        arrow = None

        def flush() -> pa.RecordBatch:
            cols = list(zip(*packer.rows)) or [()] * 7
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(cols[0], type=arrow), *[pa.array(c, type=pa.int64()) for c in cols[1:]]],
                                              names=[id_col, *names])

        for b in batches:
            arrow = b.schema.field(0).type
            for doc, text in zip(b.column(0), b.column(1)):
                packer.place(doc.as_py(), np.concatenate([encode(text.as_py() or ""), end]))
                if len(packer.rows) >= 50_000:
                    yield flush()
        if arrow is not None:
            packer.finish()
            yield flush()

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)
