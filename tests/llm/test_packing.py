import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from lateship.llm.packing import END_ID, Packer, encoder, pack_sequences

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check(rows, docs, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for doc, start, length, crc, total, seq, offset in rows:
        ids = docs[doc]
        assert length > 0 and total == len(ids)
        assert crc == zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
        by_doc[doc].append((start, length))
        by_seq[seq].append((offset, length))
    assert set(by_doc) == set(docs)
    for doc, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == len(docs[doc])
    odd = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        odd += at < window
        assert at & (at - 1) == 0
    return odd


@pytest.mark.parametrize("seed,window,max_open", [(1, 64, 4096), (2, 64, 5), (3, 1024, 4096), (4, 16, 2)])
def test_packer_places_every_id_once(seed, window, max_open):
    rnd = random.Random(seed)
    docs = {i: np.array([rnd.randrange(50_000) for _ in range(rnd.choice((1, 3, window // 2, window - 1, window, window + 1, rnd.randrange(1, 3 * window))))], dtype="<u4")
            for i in range(400)}
    p = Packer(window, max_open)
    for i, ids in docs.items():
        p.place(i, ids)
        assert p.n_open < max_open and p.n_open == p.level.sum() == sum(map(len, p.open))
    p.finish()
    assert check(p.rows, docs, window) <= window.bit_length()


def test_sum_of_squares_rule():
    """Each piece goes where the sum of squared level counts becomes smallest."""
    rnd = random.Random(9)
    p = Packer(32, 10_000)
    for i in range(500):
        size = rnd.randrange(1, 32)
        best = None
        for h in range(0, 33 - size):
            if h and not p.level[h]:
                continue
            n = p.level.copy()
            if h:
                n[h] -= 1
            if h + size < 32:
                n[h + size] += 1
            best = min(best, int((n ** 2).sum())) if best is not None else int((n ** 2).sum())
        p.place(i, np.zeros(size, dtype="<u4"))
        assert int((p.level ** 2).sum()) == best


def test_equal_pieces_do_not_pile_up():
    p = Packer(1024, 100)
    docs = {i: np.full(700, i, dtype="<u4") for i in range(3000)}
    for i, ids in docs.items():
        p.place(i, ids)
        assert p.n_open < 100
    p.finish()
    check(p.rows, docs, 1024)


@pytest.mark.parametrize("text", ["", "plain text, it's fine\n\n  x", "<|endoftext|>a<|endoftext|>", "naïve café ÀÿŸ", "漢字かな、。", "🙂 x‍y",
                                  "a b c　d", "\x00\x1c\x1f\x85 y", "ǅ ʰ ٣ ² ½ Ⅷ", "a" * 5000, " " * 3000 + "\t\n", "Привет, мир Ελλάδα"])
def test_both_encoders_agree(text):
    assert encoder(JSON, RANKS)(text).tolist() == encoder(JSON, None)(text).tolist()


def test_pack_sequences(spark):
    texts = [(1, None), (2, ""), (3, "hello world " * 900), (None, "null id"), (5, "same"), (6, "x " * 40_000)] + [(10 + i, "some words here " * (i % 37)) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, start int").repartition(3)
    rows = [tuple(r) for r in pack_sequences(df, JSON, RANKS).collect()]
    exact = encoder(JSON, None)
    docs = {i: np.append(exact(t or ""), np.uint32(END_ID)).astype("<u4") for i, t in texts}
    assert check(rows, docs, 1024) <= 3 * 10
    assert pack_sequences(df.limit(0), JSON, RANKS).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert len(pack_sequences(twice, JSON, RANKS).where("start = 0").collect()) == 2
