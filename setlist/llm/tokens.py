"""Token ids of whole texts.

The ids are those that ``tokenizers`` gives for ``byte_bpe_50k.json`` without
special tokens (their strings in a text are ordinary text).  They are made by
``tiktoken`` from the same vocabulary as ranks, which gives the same ids about
five times faster; ``tests/llm`` holds one against the other.
"""

from __future__ import annotations

import base64
from functools import lru_cache

#: Vocabulary as ranks, and the id that ends a document.
RANKS = "byte_bpe_50k.tiktoken"
END = 0


@lru_cache(maxsize=4)
def encoder(ranks: str = RANKS):
    """The encoder of a rank file of ``public_tokenizers``."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(ranks), "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def ids(text: str | None) -> list[int]:
    """The text's ids; null text has none."""
    return encoder().encode_ordinary(text) if text else []
