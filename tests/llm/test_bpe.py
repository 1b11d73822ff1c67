import base64
import random

import public_tokenizers
import pytest
import tiktoken

from lahar.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    alphabet = "aeinrst  \n\t\r\x0b\x1c\x85\xa0 　'sdm019.,!?éßñ中文字\U0001f600́‍½²Ⅷ"
    return [None, "", " ", "\n\n  x", "it's we'll", "a" * 3000, *("".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(600))]


def test_matches_tiktoken_and_decodes(spark, reference):
    texts = odd_texts()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, "\n\n  x", "x")], "doc_id long, text string, id string").repartition(3)
    rows = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        t = texts[r.doc_id] or ""
        assert r.ids == reference.encode_ordinary(t), repr(t)
        assert bytes(r.decoded) == t.encode()


def test_long_word_by_heap(reference):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(PATH))}
    rng = random.Random(1)
    for n in (300, 2000):
        w = bytes(rng.choices(b"abcethrno", k=n))
        assert bpe.encode_word(w, ranks) == bpe._encode_long(w, ranks) == reference._encode_single_piece(w)
        assert bpe._encode_long(w[:200], ranks) == bpe.encode_word(w[:200], ranks)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(df, PATH, public_tokenizers.PATTERN).collect() == []
