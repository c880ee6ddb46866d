"""The compiled tokenizer against the library."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from tickbars.llm import op13_token_counts as op13

PATH = public_tokenizers.path(op13.TOKENIZER)
ODD = [
    "",
    "  \t\n",
    "Hello  world",
    "don't 'STOP, we'Ll they'RE I'm",
    "''s !'s '",
    "a'",
    "'re've'l'lll's's",
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|><|endoftext|",
    "İstanbul ẞ Å Σας ΟΔΟΣ é ́x <|endoftext|>́",
    "日本語 テスト 한국어 🙂🙃",
    "12 3a٣ x² Ⅷ",
    "\x00\x85​ a\xa0b c",
    "x" * 5000,
    "ab" * 70_000 + " 'tis",
    "'",
]


@pytest.fixture(scope="module")
def compiled():
    return op13.Compiled(PATH)


def library(compiled, texts):
    return [len(e.ids) for e in compiled.library.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts(compiled):
    assert compiled.counts(ODD).tolist() == library(compiled, ODD)
    assert [compiled.counts([t]).tolist()[0] for t in ODD] == library(compiled, ODD)
    assert compiled.counts([]).tolist() == []


@pytest.mark.parametrize("letters", ["etaoinsrhl", "abcdefghijklmnopqrstuvwxyz'  .,!ABCéßñ1२Σ́ 中\n", "aab ", "0aZ+/="])
def test_random_texts(compiled, letters):
    pick = random.Random(letters)
    texts = ["".join(pick.choices(letters, k=pick.randrange(120))) for _ in range(400)]
    assert compiled.counts(texts).tolist() == library(compiled, texts)


def test_every_token_by_itself_and_in_pairs(compiled):
    """Each entry of the vocabulary that is text, and neighbours that merge or don't."""
    words = [t.removesuffix("</w>") for t in compiled.library.get_vocab() if t.isascii()]
    assert compiled.counts(words).tolist() == library(compiled, words)
    pick = random.Random(1)
    pairs = ["".join(pick.sample(words, 2)) for _ in range(5000)]
    assert compiled.counts(pairs).tolist() == library(compiled, pairs)


@pytest.mark.parametrize(("chunk", "segment", "states"), [(1, 1 << 18, 1 << 18), (7, 50, 1), (64, 200, 40), (3, 3, 1)])
def test_cuts_and_forgetting_change_nothing(chunk, segment, states):
    """Words over many chunks and segments, and tables made anew between them."""
    small = op13.Compiled(PATH, chunk, segment, states)
    texts = ["one two three", "pneumonoultramicroscopic" * 8, "", "l'été déjà vu", "a b c d e f g", "x" * 130]
    assert small.counts(texts).tolist() == library(small, texts)


def test_long_texts_in_parts(compiled):
    text = ODD[8] + " don't " * 30_000
    parts = list(op13.pieces(text, 1000))
    assert "".join(parts) == text and len(parts) > 100 and max(map(len, parts)) < 1100
    assert list(op13.pieces("x" * 5000, 1000)) == ["x" * 5000]
    assert compiled.counts(parts).sum() == library(compiled, [text])[0]
    assert op13.counted(compiled, [text, None, "a", text], 4).tolist() == library(compiled, [text, "", "a", text])


def test_other_kinds_are_refused():
    with pytest.raises(ValueError):
        op13.Compiled(public_tokenizers.path("byte_bpe_50k.json"))


def test_odd_tables(spark, compiled):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(1, None), (None, "a b"), (1, "twice"), (1, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_bytes": F.lit("x"), "n_tokens": F.lit(1)}).repartition(3)
    got = sorted(map(tuple, op13.token_counts(df, PATH, 4).collect()), key=repr)
    counts = library(compiled, [t or "" for _, t in rows])
    assert got == sorted(((i, len((t or "").encode()), n, n > 4) for (i, t), n in zip(rows, counts)), key=repr)
    assert op13.token_counts(df.limit(0), PATH).collect() == []


def test_query(spark, compiled):
    path = "/root/testdata/sf0.01"
    docs = brute.documents(path)
    counts = library(compiled, [d["text"] or "" for d in docs])
    got = sorted(map(tuple, op13.op13_token_counts(spark, path).collect()))
    assert got == sorted((d["doc_id"], len((d["text"] or "").encode()), n, n > 2048) for d, n in zip(docs, counts))
