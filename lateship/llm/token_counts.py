"""Token counts, with overlap resynchronisation for huge documents.

Texts up to ``chunk_chars`` are encoded whole, in small batches. A longer text
is encoded in overlapping chunks with character offsets; neighbouring chunks
are spliced at a boundary that

* both encodings have in the overlap, and
* is proven stable: it stands before a space that follows a character other
  than a space. No piece of the vocabulary holds a space after another
  character (checked when the model is loaded), so no merge can cross such a
  place and the tokens on either side do not depend on the other side.

If an overlap holds no such boundary it is doubled, and once it covers the
chunk the chunk itself is doubled, up to the rest of the text: the result is
that of encoding the whole text, always.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SPACE = "▁"
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
#: Characters encoded in one call of the library, which bounds a task's memory.
BATCH_CHARS = 1 << 19


class ResyncEncoder:
    """Encodes texts of any length with one sentencepiece model."""

    def __init__(self, model_path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.chunk, self.overlap = chunk, overlap
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        norm = spec.normalizer_spec
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        #: Whether places before a space are proven stable for this model.
        self.stable = (norm.name == "identity" and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
                       and norm.escape_whitespaces and not any(SPACE in p.lstrip(SPACE) for p in pieces))

    def count_batch(self, texts: list[str]) -> list[tuple[int, int]]:
        """``(tokens, splices)`` of each text."""
        out: list = [None] * len(texts)
        batch, size = [], 0

        def flush():
            if batch:
                for i, ids in zip(batch, self.model.encode([texts[i] for i in batch], return_type="numpy", num_threads=1)):
                    out[i] = (len(ids), 0)
            batch.clear()

        for i, t in enumerate(texts):
            if len(t) > self.chunk and self.stable:
                parts = list(self._parts(t))
                out[i] = (sum(len(p) for p in parts), len(parts) - 1)
                continue
            if size + len(t) > BATCH_CHARS:
                flush()
                size = 0
            batch.append(i)
            size += len(t)
        flush()
        return out

    def ids(self, text: str) -> np.ndarray:
        """The token ids of one text."""
        if len(text) <= self.chunk or not self.stable:
            return np.asarray(self.model.encode([text], return_type="numpy", num_threads=1)[0])
        return np.concatenate([np.asarray(p, dtype=np.int32) for p in self._parts(text)])

    def _chunk(self, text: str, start: int, end: int) -> tuple[list[int], np.ndarray]:
        """Ids and the places in ``text`` where they begin."""
        got = self.model.encode(text[start:end], return_type="offset_mapping")
        return got["ids"], np.fromiter((a for a, _ in got["offsets"]), dtype=np.int64, count=len(got["ids"])) + start

    @staticmethod
    def _is_stable(text: str, p: int) -> bool:
        return text[p] == " " and text[p - 1] != " " and text[p - 1] != SPACE

    def _common(self, text: str, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
        """A boundary in ``(low, high)`` that both encodings have and that is stable."""
        for p in np.intersect1d(left[(left > low) & (left < high)], right):
            if self._is_stable(text, int(p)):
                return int(p)
        return None

    def _parts(self, text: str) -> Iterator[list[int]]:
        """The ids of a long text, part by part."""
        n, begin, taken = len(text), 0, 0  # the left chunk starts at begin; its ids count from taken on
        end = min(n, self.chunk)
        ids, at = self._chunk(text, begin, end)
        while end < n:
            overlap, splice = self.overlap, None
            while splice is None:
                start = max(taken + 1, end - overlap)
                right_end = min(n, start + max(self.chunk, 2 * (end - start)))
                right, right_at = self._chunk(text, start, right_end)
                splice = self._common(text, at, right_at, start, end)
                if splice is not None:
                    break
                if start > taken + 1:
                    overlap *= 2
                    continue
                end = min(n, end + (end - begin))   # nothing stable in the whole chunk: make it longer
                ids, at = self._chunk(text, begin, end)
                if end == n:
                    break
                overlap = self.overlap
            if splice is None:
                break
            keep = (at >= taken) & (at < splice) if taken else at < splice
            yield [i for i, k in zip(ids, keep) if k]
            begin, taken, end, ids, at = start, splice, right_end, right, right_at
        yield [i for i, p in zip(ids, at) if p >= taken] if taken else list(ids)


@lru_cache(maxsize=2)
def encoder(model_path: str, chunk: int, overlap: int) -> ResyncEncoder:
    return ResyncEncoder(model_path, chunk, overlap)


def token_counts(df: DataFrame, model_path: str, text_col: str = "text", limit: int = 4096,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_tokens``, ``n_splices`` and ``over_limit``.

    ``n_tokens`` is what the library gives for the whole text, without begin,
    end or added special tokens. One pass, no shuffle.

    Defined results: a null text is an empty one (no bytes, no tokens);
    repeated rows are each counted; an empty input gives an empty result;
    other columns pass through, and one with a result's name is replaced.
    """
    out = ["n_bytes", "n_tokens", "n_splices", "over_limit"]
    schema = StructType([StructField("n_tokens", LongType()), StructField("n_splices", LongType())])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(model_path, chunk_chars, overlap_chars)
        for s in batches:
            yield pd.DataFrame(e.count_batch([t or "" for t in s]), columns=["n_tokens", "n_splices"])

    kept = [F.col(f"`{c}`") for c in df.columns if c not in out]
    text = F.col(f"`{text_col}`")
    counted = df.select(*kept, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                        F.pandas_udf(run, schema)(text).alias("__t"))
    return (counted.select(*kept, "n_bytes", "__t.n_tokens", "__t.n_splices")
            .withColumn("over_limit", F.col("n_tokens") > limit))
