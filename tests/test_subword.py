"""Subword truncation against an independent encoder, and its cost."""

import base64
import random
import time

import public_tokenizers
import pytest
import tiktoken

from shelfwise.operators import subword
from shelfwise.operators.truncate import ByteTokenizer, truncate_texts_tokenizer
from shelfwise.plans.recplan import RecPlan

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}


@pytest.fixture(scope="module")
def encoder(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_vocabulary_file(spark, ranks):
    assert subword.read_vocabulary(spark, FILE) == ranks


def test_ids_equal_the_other_encoder(ranks, encoder):
    tokenizer, rnd = subword.SubwordTokenizer(ranks, public_tokenizers.PATTERN), random.Random(1)
    texts = ["".join(rnd.choice("ab \u00e9\u6f22\n\t<'s 12ABC") for _ in range(rnd.randrange(200))) for _ in range(600)]
    for text in [*texts, "a" * 3000, "ab" * 2000, "", " " * 300]:
        assert tokenizer.encode(text) == encoder.encode_ordinary(text)
        assert tokenizer.encode(text, 17) == encoder.encode_ordinary(text)[:17]


def test_cost_follows_the_limit(ranks):
    tokenizer = subword.SubwordTokenizer(ranks, public_tokenizers.PATTERN)
    started = time.time()
    assert len(tokenizer.encode(" word" * 4_000_000, 128)) == 128
    assert time.time() - started < 0.5


def test_truncated_texts(spark, encoder):
    plan = RecPlan(spark, SF)
    texts = {r["item_id"]: r["item_text"] for r in plan.views.texts.collect()}
    got = {r["item_id"]: r["item_text"] for r in plan.truncated_texts_subword.collect()}
    assert set(got) == set(texts)
    for k, text in texts.items():
        ids = encoder.encode_ordinary(text)[:128]
        assert got[k] == encoder.decode_bytes(ids).decode("utf-8", errors="ignore") and text.startswith(got[k])


def test_nulls_empties_and_bytes(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "\u00e9\u00e9"), (None, "abc")], "item_id long, item_text string")
    got = [tuple(r) for r in truncate_texts_tokenizer(df, ByteTokenizer, 3).collect()]
    assert got == [(1, None), (2, ""), (3, "\u00e9"), (None, "abc")]
    made = subword.truncate_texts_subword(df, FILE, public_tokenizers.PATTERN, 1).collect()
    assert [(r["item_id"], r["item_text"]) for r in made][:2] == [(1, None), (2, "")] and len(made[2]["input_ids"]) == 1
