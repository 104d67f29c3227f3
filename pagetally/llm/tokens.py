"""Byte-level BPE ids of the public 50k vocabulary.

The ids are those of the ``tokenizers`` file at its default setting with
``add_special_tokens=False``; so ``<|endoftext|>`` inside a text is its one id. The rank file of
the same vocabulary gives the same ids for plain text (tested) in a third of the CPU time, but its
pattern matcher runs out of stack on very long runs of white space. Texts with such a run or with
the special string therefore go through the ``tokenizers`` file itself.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: The one added token of the vocabulary file.
SPECIAL = "<|endoftext|>"
#: White space that the pattern of the rank file is not asked to match at once.
_LONG_RUN = re.compile(r"\s{4096}")


@lru_cache(1)
def _exact(path: str | None) -> Callable[[str], np.ndarray]:
    """The function from any text to its ids by the ``tokenizers`` file."""
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(1)
def encoder(path: str | None = None, exact: str | None = None) -> Callable[[str], np.ndarray]:
    """The function from a text to its ids; loaded once in each Python worker.

    ``path`` is the rank file, ``exact`` the ``tokenizers`` file of the same vocabulary.
    """
    import public_tokenizers
    import tiktoken
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank)
                 for token, rank in (line.split() for line in lines)}
    encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text or len(text) >= 4096 and _LONG_RUN.search(text):
            return _exact(exact)(text)
        return np.array(encoding.encode_ordinary(text), np.uint32)
    return encode
