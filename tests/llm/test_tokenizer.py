import os

import pytest
from pyspark.sql import functions as F

from helmwake.llm.tokenizer import LONG, TOKENIZERS, decode, document_ids, encode_text, read_ranks, with_ids
from helmwake.session import table

tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    None, "", " ", "\n\n \t x", "Hello world's we'll I'M don't", "ångström naïve 東京タワー 飛行 ภาพหายไป 3 เฟรม", "a" * 300, "<|endoftext|> <|startoftext|>", "x=-3.25e-04 T_w_c @ ①② 👩‍🚀📷", "  　 end \x1c\x1d y", "1234567 ½ Ⅷ", "no​join ‫שלום‬", "tabs\t\ttabs  two  spaces   ", "\r\n\r\n", "ĳ ﬁlter", "\\ \" ' $ {x} \\p{L}",
]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def encode(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r["ids"] for r in document_ids(df).collect()}


def test_against_the_library(spark, reference):
    got = encode(spark, TEXTS)
    assert [got[i] for i in range(len(TEXTS))] == [reference(t) for t in TEXTS]


def test_long_words_and_long_texts(spark, reference):
    texts = ["b" * (LONG * 20), "é" * LONG + " ok", "ab " * 1500, "ภาพหายไป" * 400, " " * 5000 + "x", "x" * (LONG + 1) + " 東京タワー飛行ภาพหายไป " + "x" * (LONG + 1) + "y " + "z" * LONG, "word " * 20_000, "9" * 3000]
    got = encode(spark, texts)
    assert [got[i] for i in range(len(texts))] == [reference(t) for t in texts]


def test_python_form_agrees(reference):
    ranks = read_ranks()
    for t in TEXTS:
        assert encode_text(t, ranks) == reference(t)


def test_documents_repeats_clashes_and_empty(spark, data, clashing, reference):
    t = table(spark, data, "documents")
    rows = {r["doc_id"]: r["ids"] for r in document_ids(clashing(t)).collect()}
    assert rows == {r["doc_id"]: reference(r["text"]) for r in t.collect()}
    assert document_ids(t.limit(0)).count() == 0
    assert document_ids(t.unionAll(t)).count() == 2 * t.count()


def test_decoding_gives_the_text_back(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    back = decode(with_ids(df), "ids", "back")
    assert back.where(~(F.col("back") == F.coalesce("text", F.lit("")))).count() == 0


def test_path_is_a_parameter(spark, tmp_path):
    os.symlink(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", tmp_path / "mine.tiktoken")
    df = spark.createDataFrame([(1, "hello there")], "doc_id bigint, text string")
    assert document_ids(df, "mine", str(tmp_path)).first()["ids"] == document_ids(df).first()["ids"]


def test_random_words_of_all_scripts(spark, reference):
    """Cut into stretches or not, and whether the word is frequent: the library's ids."""
    import random

    rng = random.Random(5)
    blocks = [(0x20, 0x7F), (0xA0, 0x24F), (0x370, 0x52F), (0x5D0, 0x6FF), (0x900, 0x97F), (0xE01, 0xE3A), (0x1000, 0x109F), (0x3041, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x1F300, 0x1F5FF)]
    texts = ["".join(chr(rng.randint(*rng.choice(blocks))) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts += ["".join(chr(rng.randint(*b)) for _ in range(60)) for b in blocks for _ in range(5)] + texts[:40]
    got = encode(spark, texts)
    assert [got[i] for i in range(len(texts))] == [reference(t) for t in texts]
