import random

import public_tokenizers
import pytest
from lateship.llm.token_counts import ResyncEncoder, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("chunk,overlap", [(20, 4), (64, 2), (33, 33)])
def test_spliced_ids_equal_the_whole_encoding(chunk, overlap):
    rnd = random.Random(chunk)
    e = ResyncEncoder(MODEL, chunk, overlap)
    assert e.stable
    parts = ["a", "the ", "  ", " ", "\n", "é", "字", "▁", " ▁", "🙂", "x" * 9, "ing", ". ", "<s>", "</s>", "\u3000", "\x00"]
    for _ in range(1500):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 70)))
        want = e.model.encode(s)
        assert e.ids(s).tolist() == want, s
        assert e.count_batch([s])[0][0] == len(want)


@pytest.mark.parametrize("text", ["x" * 500, " " * 500, "▁" * 500, "ab" * 200 + " c", " a" * 300, "\n" * 400])
def test_overlaps_widen_until_aligned(text):
    e = ResyncEncoder(MODEL, 16, 2)
    assert e.ids(text).tolist() == e.model.encode(text)


def test_table(spark):
    long = "word and more, né " * 9000
    rows = [(1, None, 5), (2, "", 5), (3, "hello <s> world", 5), (3, "hello <s> world", 5), (None, long, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    model = ResyncEncoder(MODEL).model
    got = token_counts(df, MODEL).collect()
    assert len(got) == 5
    for r in got:
        t = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096)
        assert (r.n_splices > 0) == (len(t) > 16_384)
    assert token_counts(df.limit(0), MODEL).count() == 0


def test_query_counts_whole_documents(spark, sf_dir):
    from lateship.llm.queries import QUERIES
    model = ResyncEncoder(MODEL).model
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    assert got == {d: len(model.encode(t or "")) for d, t in docs.items()}
