import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from lateship.llm.token_alignment import Aligner, alignments, link_statistics
from pyspark.sql import functions as F
from tokenizers import Tokenizer

A, RANKS, B = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def brute(libraries, text):
    """``(n_a, n_b, groups, links)`` from byte offsets alone."""
    tok, sp = libraries
    none = (0, 0, [], Counter())
    if not text:
        return none
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown}
    of.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    a = tok.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    bytes_a = [bytes(of[c] for c in tok.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return none

    def ends(parts):
        out, n = [], 0
        for p in parts:
            n += len(p)
            out.append(n)
        return out

    ea, eb = ends(bytes_a), ends(bytes_b)
    both = sorted(set(ea) & set(eb))
    groups, links, i, j = [], Counter(), 0, 0
    for e in both:
        x, y = [], []
        while i < len(a) and ea[i] <= e:
            x.append(a[i])
            i += 1
        while j < len(b) and eb[j] <= e:
            y.append(b[j])
            j += 1
        groups.append((x, y))
        links.update((s, t) for s in x for t in y)
    return len(a), len(b), groups, links


def expected(libraries, rows):
    found = [(d, brute(libraries, t)) for d, t in rows]
    n = Counter(p for _, (_, _, _, links) in found for p in links)
    most = {}
    for (a, _), c in n.items():
        most[a] = max(most.get(a, 0), c)
    out = []
    for d, (n_a, n_b, groups, links) in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, n_a, n_b, len(groups), sum(links.values()), sum(c for p, c in links.items() if n[p] == most[p[0]]),
                    sum(c * n[p] for p, c in links.items()), text))
    return sorted(out, key=str)


PARTS = ["a", "the ", "  ", " ", "\n", "\t", "é", "字", "▁", " ▁", "🙂", "xyz" * 3, "ing", ". ", "<s>", "<|endoftext|>", "　", "\x00", "123",
         "word", " another", "don't", "́", "<0x41>", "Ж", "<unk>", "−"]


def texts():
    rnd = random.Random(12)
    out = [None, "", " ", "  two", "one ", "▁", "🙂🙂 🙂", "<|endoftext|> and </s>", "a▁b"]
    out += ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 40))) for _ in range(250)]
    return out + ["the same text again and again. " * 3] * 5 + ["x" * 3000, "aé" * 1500]


def test_windows_match_byte_offsets(libraries):
    al = Aligner(A, B, RANKS)
    several = [t or "" for t in texts()]
    rows = [r for k in range(0, len(several), 20) for r in al.align(several[k:k + 20])]
    assert rows[-1][:5] == al.align(several[-1:])[0][:5]
    for t, got in zip(several, rows, strict=True):
        n_a, n_b, groups, links = brute(libraries, t)
        assert got[:4] == (n_a, n_b, len(groups), sum(links.values())), t
        assert got[4] == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups), t
        assert dict(zip(zip(got[5].tolist(), got[6].tolist()), got[7].tolist())) == dict(links), t


@pytest.mark.parametrize("head", [10 ** 6, 40, 0])
def test_corpus_counts(spark, libraries, head):
    """The whole pair table broadcast, its head, or none of it."""
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts())] + [(7, "word word"), (7, "word word")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_a string").repartition(4)
    path = df.sparkSession
    aligned = alignments(df, A, B, RANKS)
    got = link_statistics(path, aligned, head_pairs=head).collect()
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=str) == \
        expected(libraries, rows)


def test_very_long_text_and_empty_table(spark, libraries, monkeypatch):
    monkeypatch.setattr("lateship.llm.token_alignment.WHOLE_CHARS", 5000)
    rows = [(1, "several ordinary words, né " * 20_000), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = link_statistics(spark, alignments(df, A, B, RANKS)).collect()
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got), key=str) == \
        expected(libraries, rows)
    assert link_statistics(spark, alignments(df.where(F.lit(False)), A, B, RANKS)).count() == 0


def test_query_matches_brute_force(spark, sf_dir, libraries):
    from lateship.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op13_token_alignment"](spark, sf_dir).collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest() if s else ""
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=str) == \
        sorted(((*r[:-1], digest(r[-1])) for r in expected(libraries, rows)), key=str)
