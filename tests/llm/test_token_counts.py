"""Counts by pieces against the tokenizer's counts of whole texts."""

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tidemark.llm.token_counts import Lengths, load_tokenizer, pieces_of, token_counts  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts(seed, n):
    r = random.Random(seed)
    parts = ["a", "the", " ", " ", "\n", "\t", "'s", "12", "<|endoftext|>", "é", "!", "-", ".", ",", " b.", "x,", "\x1c", "中", "\r\n", " ", "ｗ"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("batch_bytes, piece_chars, memory", [(1 << 20, 1 << 14, 1 << 20), (100, 5, 3)])
def test_lengths_are_those_of_whole_texts(batch_bytes, piece_chars, memory):
    tokenizer = load_tokenizer(PATH)
    lengths = Lengths(tokenizer, batch_bytes, piece_chars, memory)
    plain = [" ".join(words) for words in (t.split() for t in texts(1, 400)) if words] + ["one two, three.\nfour five.", "a.b a. . , .."]
    for batch in (texts(2, 800), plain, texts(3, 100) + [""]):
        assert lengths.of(batch) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in batch]


def test_pieces_make_the_text():
    text = "ab cd " * 50 + "no-blank-" * 40 + " end é x"
    for size in (1, 7, 1000):
        assert "".join(pieces_of(text, size)) == text


def test_table(spark):
    tokenizer = load_tokenizer(PATH)
    rows = [*enumerate(texts(4, 50)), (50, None), (51, ""), (52, "long words " * 20_000), (0, "again"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts(df, PATH).collect()), key=str)
    expected = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t in rows]
    assert got == sorted(expected, key=str)
    assert token_counts(df.limit(0), PATH).count() == 0
