import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import encode as en

pytestmark = pytest.mark.skipif(not os.path.exists(en.VOCABULARY), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def other():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(en.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["ab", "ing", "  ", "\n", "ñ", "é", "aaaa", "'s", "--", "12", "𝐀", "<|endoftext|>"]), max_size=30).map("".join))
def test_like_the_merges(other, text):
    assert en.encoder(en.VOCABULARY).encode(text) == other(text)


def test_long_runs(other):
    for text in ("a" * 30_000, "-" * 5001, "ab" * 9000, "ñ" * 3000, " " * 999 + "x"):
        assert en.encoder(en.VOCABULARY).encode(text) == other(text)


def test_table(spark):
    rows = spark.createDataFrame([(1, "Hola mundo", "x"), (2, "", "x"), (3, None, "x"), (1, "Hola mundo", "y"), (None, " ", "z")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in en.encode(rows).collect()), key=str)
    tokens = en.encoder(en.VOCABULARY)
    assert got == sorted([(1, tokens.encode("Hola mundo"))] * 2 + [(2, []), (3, []), (0, tokens.encode(" "))], key=str)
    assert en.encode(rows.limit(0)).count() == 0
    assert "".join(tokens.tokens[i] for i in tokens.encode("añb")).encode("latin-1").decode() == "añb"
