"""Token ids against the ``tokenizers`` file at its default setting."""

import random

import pytest

from pagetally.llm import tokens


@pytest.fixture(scope="module")
def theirs():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_random_spaced_and_special_texts(theirs):
    rng = random.Random(7)
    parts = [" ", "  ", "\n", "\t \n", "\u00a0", "\u2003 ", "don't", "I'LL", "x1y22", "éß", "中文",
             "\U0001f600", "<|endoftext|>", "<|endoftext", "|>", "!?", "\x00", "\x1c", "a" * 50]
    encode = tokens.encoder()
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randrange(12)))
        assert encode(text).tolist() == theirs.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("text", [
    " " * 4095 + "x", " " * 4096 + "x", "x" + "\n" * 5000, "a " + " \t" * 3000 + "b " * 3000,
    "x" * 300_000, "\u00a0" * 9000 + "<|endoftext|>" + " " * 9000])
def test_long_runs(theirs, text):
    assert tokens.encoder()(text).tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_five_megabytes_of_white_space():
    assert len(tokens.encoder()("\n" * 5_000_000)) > 1_000_000
