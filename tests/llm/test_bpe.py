import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lavra.llm import bpe

RANKS = os.path.join(os.environ.get("LAVRA_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary here")


@pytest.fixture(scope="module")
def replay():
    return bpe.Replay(bpe.read_ranks(RANKS), memo_words=2000)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.TOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200) | st.text("aab \n'é", max_size=200))
def test_ids_equal_the_reference_encoder(text):
    assert test_ids_equal_the_reference_encoder.replay.encode([text]) == [test_ids_equal_the_reference_encoder.reference.encode_ordinary(text)]


@pytest.fixture(autouse=True, scope="module")
def _bind(replay, reference):
    test_ids_equal_the_reference_encoder.replay, test_ids_equal_the_reference_encoder.reference = replay, reference


def test_long_runs_and_a_full_memo(replay, reference):
    texts = ["a" * 5000, "ab" * 3000, " " * 3000, "<|endoftext|>", *[f"palavra{k} x{k}" for k in range(3000)], "👩🏽‍🏫" * 200]
    assert replay.encode(texts) == [reference.encode_ordinary(t) for t in texts]


def test_operator_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "<|endoftext|>", 0), (4, "olá", 0), (4, "olá", 0)], "doc_id bigint, text string, ids int")
    out = bpe.encode(df, "text", RANKS)
    assert dict(out.dtypes)["ids"] == "array<int>"
    got = sorted((r.doc_id, r.ids) for r in out.collect())
    assert got[0] == (1, []) and got[1] == (2, []) and 50256 not in got[2][1] and got[3] == got[4]
    assert bpe.encode(df.limit(0), "text", RANKS).count() == 0
