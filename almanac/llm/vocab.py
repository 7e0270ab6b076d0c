"""Reading public tokenizer files: the path is a parameter, nothing is copied or trained."""

from __future__ import annotations

import functools
import os


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def library(file: str):
    """The library's tokenizer for a .json file, once per process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(file)
