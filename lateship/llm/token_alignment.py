"""Cross-tokenizer alignment with white-space anchors.

1. Each text is encoded whole by both vocabularies, and the bytes of the
   tokens are checked against the text.
2. Anchors: byte offsets where a token of both ends and the next token of both
   begins with a space. The offsets are compared, so an anchor is verified,
   not guessed. Anchors cut a document into windows, about one for each word.
3. A window is known by its two id tuples. The windows of a batch of texts
   are brought together by these tuples, and each different one is aligned
   once: its groups (the finest pieces at whose ends both tokenizations end)
   and its links are shared by all windows with the same tuples.
4. Corpus counts: a pair's count is the number of documents that hold it
   linked. Documents carry distinct pairs, so this is one pre-aggregated count.
5. The counts go back to the documents: the frequent head of the pair table,
   bounded in rows, is broadcast and looked up in place, and only pairs
   outside the head are joined.

Links within a group are products of the distinct ids of both sides, so a
long group without common ends costs its distinct pairs, not all occurrences.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .components import dropped, saved
from .packing import _PLAIN
from .token_counts import ResyncEncoder

#: Windows of up to so many tokens on each side are shared.
SHORT = 8
#: Links of a group that are listed one by one; larger groups by distinct ids.
GROUP_LINKS = 4096
#: Characters encoded, and then returned, at a time, which bounds a task's memory.
BATCH_CHARS = 1 << 20
#: Texts beyond this are encoded by ``ResyncEncoder``, which gives the same ids.
WHOLE_CHARS = 1 << 18
#: Rows of the broadcast head of the pair table.
HEAD_PAIRS = 1_000_000

_COUNTS = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
_LISTS = [StructField(n, ArrayType(IntegerType())) for n in ("link_a", "link_b", "link_n")]


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable Latin-1 characters for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class _Side:
    """Bytes of a vocabulary's tokens."""

    def __init__(self, pieces: list[bytes], end: str):
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        #: An id as text, within a group and at the end of its side of one.
        self.names = np.array([f"{i}," for i in range(len(pieces))], dtype=object)
        self.closing = np.array([f"{i}{end}" for i in range(len(pieces))], dtype=object)
        self.spaced = np.array([p[:1] == b" " for p in pieces])

    def joined(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


class Aligner:
    """Aligns a byte-level vocabulary (A) with a sentencepiece model (B)."""

    def __init__(self, json_path: str, model_path: str, ranks_path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(json_path)
        self.whole.encode_special_tokens = True
        symbols = byte_symbols()
        entries = self.whole.get_vocab()
        pieces = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            pieces[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self.a = _Side(pieces, "|")
        self.fast = None
        if ranks_path is not None:
            import base64

            import public_tokenizers
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.long = ResyncEncoder(model_path, chunk=WHOLE_CHARS)
        self.model = m = self.long.model
        self.b = _Side([bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(m.get_piece_size())], ";")

    def encode_a(self, text: str) -> list[int]:
        if self.fast is not None and _PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(text)
        return self.whole.encode(text, add_special_tokens=False).ids

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        short = [t for t in texts if len(t) <= WHOLE_CHARS]
        got = iter(self.model.encode(short, return_type="numpy", num_threads=1) if short else [])
        return [np.asarray(next(got) if len(t) <= WHOLE_CHARS else self.long.ids(t), dtype=np.int32) for t in texts]

    def _encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of both sides, or None where a text is empty or the tokens'
        bytes are not those of the text."""
        out = []
        for text, ids in zip(texts, self.encode_b(texts)):
            want = b" " + text.encode("utf-8", "surrogatepass")
            a, b = self.encode_a(" " + text) if text else [], ids.tolist()
            out.append((a, b) if text and self.a.joined(a) == want and self.b.joined(b) == want else None)
        return out

    def align(self, texts: list[str]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, groups, a ids, b ids, counts)`` of
        each text; zeros and nothing where it has no tokens.

        The texts are laid end to end: both tokenizations end at the end of
        each, and the first token of each begins with a space, so no window
        reaches over a text's end.
        """
        out = [(0, 0, 0, 0, "", _NONE, _NONE, _NONE)] * len(texts)
        encoded = self._encoded(texts)
        docs = [d for d, e in enumerate(encoded) if e]
        if not docs:
            return out
        ids_a, ids_b = (np.fromiter(chain.from_iterable(encoded[d][k] for d in docs), dtype="<i4") for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        place = np.full(int(ends_a[-1]) + 1, -1, dtype=np.int64)
        place[ends_a] = np.arange(len(ids_a))
        at_a = place[ends_b]
        at_b = np.nonzero(at_a >= 0)[0]                            # ends that both have
        at_a = at_a[at_b]
        next_a, next_b = np.append(self.a.spaced[ids_a[1:]], True), np.append(self.b.spaced[ids_b[1:]], True)
        anchor = next_a[at_a] & next_b[at_b]
        stops = np.stack([at_a[anchor] + 1, at_b[anchor] + 1])     # windows end at anchors
        starts = np.concatenate([np.zeros((2, 1), dtype=np.int64), stops[:, :-1]], axis=1)
        which, first_seen = distinct_windows(ids_a, ids_b, starts, stops)
        size = stops[:, first_seen] - starts[:, first_seen]
        texts_of, groups, links, begin, pair, count = self._aligned(
            ids_a[_ranges(starts[0, first_seen], size[0])], ids_b[_ranges(starts[1, first_seen], size[1])], *np.cumsum(size, axis=1))

        last = np.cumsum([len(encoded[d][0]) for d in docs])
        doc = np.searchsorted(last, stops[0])                      # of each window
        first = np.searchsorted(doc, np.arange(len(docs) + 1))
        n_groups, n_links = np.add.reduceat(groups[which], first[:-1]), np.add.reduceat(links[which], first[:-1])
        many = np.diff(begin)[which]
        take = _ranges(begin[which], many)
        values, back = np.unique(pair, return_inverse=True)
        held, inverse = np.unique(np.repeat(doc, many) * len(values) + back[take], return_inverse=True)
        total = np.zeros(len(held), dtype=np.int64)
        np.add.at(total, inverse, count[take])
        total = np.minimum(total, 2 ** 31 - 1).astype(np.int32)
        linked = values[held % len(values)]
        link_a, link_b = (linked >> 32).astype(np.int32), (linked & 0xFFFFFFFF).astype(np.int32)
        border = np.searchsorted(held, np.arange(len(docs) + 1) * len(values))
        sequence = list(map(texts_of.__getitem__, which.tolist()))
        for k, d in enumerate(docs):
            part = slice(border[k], border[k + 1])
            out[d] = (len(encoded[d][0]), len(encoded[d][1]), int(n_groups[k]), int(n_links[k]), "".join(sequence[first[k]:first[k + 1]])[:-1],
                      link_a[part], link_b[part], total[part])
        return out

    def _aligned(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple:
        """The alignments of distinct windows, laid end to end: their groups as
        text (each ended by ``;``), numbers of groups and of links, and linked
        pairs with counts (those of window k from ``begin[k]`` on)."""
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        place = np.full(int(ends_a[-1]) + 1, -1, dtype=np.int64)
        place[ends_a] = np.arange(len(a))
        stop_b = np.nonzero(place[ends_b] >= 0)[0] + 1
        stop_a = place[ends_b[stop_b - 1]] + 1
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        window = np.searchsorted(cut_a, stop_a)
        groups = np.bincount(window, minlength=len(cut_a))
        links = np.zeros(len(cut_a), dtype=np.int64)
        np.add.at(links, window, n_a * n_b)

        text_a, text_b = self.a.names[a], self.b.names[b]
        text_a[stop_a - 1] = self.a.closing[a[stop_a - 1]]
        text_b[stop_b - 1] = self.b.closing[b[stop_b - 1]]
        group = np.arange(len(n_a))
        mixed = np.empty(len(a) + len(b), dtype=object)
        mixed[np.arange(len(a)) + (stop_b - n_b)[np.repeat(group, n_a)]] = text_a   # after the B tokens of the groups before
        mixed[np.arange(len(b)) + stop_a[np.repeat(group, n_b)]] = text_b
        mixed, cut = mixed.tolist(), [0, *(cut_a + cut_b).tolist()]
        texts = ["".join(mixed[i:j]) for i, j in zip(cut, cut[1:])]

        small = np.nonzero(n_a * n_b <= GROUP_LINKS)[0]
        many = (n_a * n_b)[small]
        of, k = np.repeat(small, many), _ranges(np.zeros(len(small), dtype=np.int64), many)
        pair = a[(stop_a - n_a)[of] + k // n_b[of]].astype(np.int64) << 32 | b[(stop_b - n_b)[of] + k % n_b[of]]
        pairs, counts, owner = [pair], [np.ones(len(pair), dtype=np.int64)], [window[of]]
        for g in np.nonzero(n_a * n_b > GROUP_LINKS)[0]:   # distinct ids of both sides, not all occurrences
            x, s = np.unique(a[stop_a[g] - n_a[g]:stop_a[g]].astype(np.int64), return_counts=True)
            y, t = np.unique(b[stop_b[g] - n_b[g]:stop_b[g]], return_counts=True)
            pairs.append((x[:, None] << 32 | y).ravel())
            counts.append((s[:, None] * t).ravel())
            owner.append(np.full(len(x) * len(y), window[g]))
        values, back = np.unique(np.concatenate(pairs), return_inverse=True)
        held, inverse = np.unique(np.concatenate(owner) * len(values) + back, return_inverse=True)
        count = np.zeros(len(held), dtype=np.int64)
        np.add.at(count, inverse, np.concatenate(counts))
        begin = np.searchsorted(held, np.arange(len(cut_a) + 1) * len(values))
        return texts, groups, links, begin, values[held % len(values)], count


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[k], starts[k] + 1, ...``, ``sizes[k]`` of them, for each k."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def distinct_windows(ids_a: np.ndarray, ids_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(which, first)``: for each window the number of its id tuples, and
    for each number the first window that has them.

    Windows of few tokens are brought together by a hash of their padded id
    tuples, and then the tuples themselves are compared; longer windows (and
    any whose hash another tuple has) stand alone.
    """
    size = stops - starts
    short = np.nonzero((size <= SHORT).all(axis=0))[0]
    step = np.arange(SHORT)
    padded = np.concatenate([
        np.where(step < size[k, short][:, None], ids[np.minimum(starts[k, short][:, None] + step, len(ids) - 1)] + 1, 0)
        for k, ids in ((0, ids_a), (1, ids_b))], axis=1)
    mixed = padded.astype(np.uint64) @ _MIX
    _, first, back = np.unique(mixed ^ (mixed >> np.uint64(29)), return_index=True, return_inverse=True)
    same = (padded == padded[first][back]).all(axis=1)
    which = np.empty(starts.shape[1], dtype=np.int64)
    which[short] = back
    alone = np.concatenate([np.nonzero((size > SHORT).any(axis=0))[0], short[~same]])
    which[alone] = np.arange(len(first), len(first) + len(alone))
    return which, np.concatenate([short[first], alone])


_NONE = np.empty(0, dtype=np.int32)
_MIX = np.random.Generator(np.random.PCG64(1)).integers(1, 1 << 63, 2 * SHORT, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=1)
def aligner(json_path: str, model_path: str, ranks_path: str | None) -> Aligner:
    return Aligner(json_path, model_path, ranks_path)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), type=pa.int32()))


def alignments(docs: DataFrame, json_path: str, model_path: str, ranks_path: str | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``(id, n_a, n_b, n_groups, n_links, groups,
    link_a, link_b, link_n)``.

    ``groups`` lists the id groups in order, as ``a1,a2|b1;a3|b2,b3``; the
    three lists hold the distinct linked id pairs, ordered, and how often each
    is linked. One pass, no shuffle.

    Defined results: texts that are null or empty, or whose tokens' bytes
    differ from a space and the text, have no tokens: zeros, an empty string
    and empty lists; repeated rows and ids each give a row; a null id stays
    null; an empty input gives an empty result; very long texts are aligned
    whole; other columns are not read.
    """
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *_COUNTS, StructField("groups", StringType()), *_LISTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(json_path, model_path, ranks_path)
        for b in batches:
            texts, k = b.column(1).to_pylist(), 0
            while k < len(texts):
                stop, size = k, 0
                while stop < len(texts) and (stop == k or size + len(texts[stop] or "") <= BATCH_CHARS):
                    size += len(texts[stop] or "")
                    stop += 1
                rows = al.align([t or "" for t in texts[k:stop]])
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(k, stop - k), *[pa.array(c, type=pa.int64()) for c in cols[:4]], pa.array(cols[4], type=pa.string()),
                     *[_lists(list(c)) for c in cols[5:]]], names=schema.names)
                k = stop

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def pair_counts(spark: SparkSession, aligned: DataFrame) -> DataFrame:
    """``(a, b, n, best)`` for each linked pair, as a saved table: the number
    of documents that hold it, and whether no other pair of ``a`` has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("link_a", "link_b")).alias("p"))
    counted = saved(spark, pairs.groupBy(F.col("p.link_a").alias("a"), F.col("p.link_b").alias("b")).agg(F.count("*").alias("n")), "counts")
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    out = saved(spark, counted.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    dropped(spark, counted)
    return out


def _head(pairs: DataFrame, limit: int) -> tuple[int, bool]:
    """The smallest power of two ``cut`` with at most ``limit`` pairs of
    ``n >= cut``, and whether that is all of them."""
    sizes = {r["k"]: r["c"] for r in pairs.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("c")).collect()}
    held, cut = 0, 64
    while cut and held + sizes.get(cut - 1, 0) <= limit:
        cut -= 1
        held += sizes.get(cut, 0)
    return 1 << cut, cut == 0


def link_statistics(spark: SparkSession, aligned: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` (a table that reads the same each time) with ``n_best``
    and ``count_sum`` in place of its link lists.

    ``count_sum`` adds up the corpus counts of a row's links; ``n_best``
    counts the links whose pair is one of the most frequent of its A id.
    """
    pairs = pair_counts(spark, aligned)
    cut, all_held = _head(pairs, head_pairs)
    rows = pairs.where(F.col("n") >= cut).toArrow()
    key = rows["a"].to_numpy().astype(np.int64) << 32 | rows["b"].to_numpy()
    order = np.argsort(key)
    head = spark.sparkContext.broadcast((key[order], rows["n"].to_numpy()[order], rows["best"].to_numpy()[order]))
    kept = [f for f in aligned.schema.fields if f.name not in ("link_a", "link_b", "link_n")]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType()),
                         *([] if all_held else [StructField("rest", StructType(_LISTS))])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = head.value
        for b in batches:
            lists = b.column("link_a")
            row = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            x, y, n = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("link_a", "link_b", "link_n"))
            key = x.astype(np.int64) << 32 | y
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            found = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
            at, w, of = at[found], n[found].astype(np.int64), row[found]
            total, top = np.zeros(len(b), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            np.add.at(total, of, w * counts[at])
            np.add.at(top, of, w * best[at])
            out = [b.column(f.name) for f in kept] + [pa.array(top), pa.array(total)]
            if not all_held:
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=len(b)))]).astype(np.int32)
                out.append(pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(v[~found])) for v in (x, y, n)],
                                                      names=["link_a", "link_b", "link_n"]))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    scored = aligned.mapInArrow(run, schema)
    if all_held:
        return scored
    # Pairs outside the head are joined, and summed by row.
    scored = saved(spark, scored.withColumn("__row", F.monotonically_increasing_id()), "scored")
    tail = pairs.where(F.col("n") < cut).select(F.col("a").alias("link_a"), F.col("b").alias("link_b"), F.col("n").alias("__n"), F.col("best").alias("__best"))
    left = scored.select("__row", F.explode(F.arrays_zip("rest.link_a", "rest.link_b", "rest.link_n")).alias("p")).select("__row", "p.*")
    sums = (left.join(tail, ["link_a", "link_b"]).groupBy("__row")
            .agg(F.sum(F.col("link_n") * F.col("__n")).alias("__sum"),
                 F.sum(F.when(F.col("__best"), F.col("link_n")).otherwise(0)).alias("__top")))
    plus = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return scored.join(sums, "__row", "left").select(*[f.name for f in kept], plus("n_best", "__top"), plus("count_sum", "__sum"))
