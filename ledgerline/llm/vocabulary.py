"""Where the vocabulary files of public tokenizers are."""

from __future__ import annotations


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed vocabulary file, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)
