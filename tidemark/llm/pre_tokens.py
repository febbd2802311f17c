"""Pre-tokens of a text by a tokenizer's pattern, as the tokenizers' own libraries split it."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

OTHER = "￿"  # a noncharacter: neither letter, number nor space in any version of Unicode


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Characters that the module regex already knows as letters or numbers, but the tokenizers don't.

    The libraries carry different versions of Unicode. Each candidate is put
    before a contraction: only after a letter, number or space does the
    contraction stay whole.
    """
    import regex
    import tiktoken

    known = regex.compile(r"[\p{L}\p{N}\s]").match
    ranks = {bytes([b]): b for b in range(256)} | {b"'s": 256}
    probe = tiktoken.Encoding("probe", pat_str=r"'s|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+", mergeable_ranks=ranks, special_tokens={})
    new = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn" and known(chr(c))]
    return "".join(c for c in new if probe.encode_ordinary(c + "'s")[-1] != 256)


@lru_cache(maxsize=4)
def splitter(pattern: str):
    """A function that gives the pre-tokens of a text in order; together they are the text."""
    import regex

    compiled = regex.compile(pattern)
    new = newer_characters()
    odd = regex.compile(f"[{regex.escape(new)}]") if new else None

    def split(text: str) -> list[str]:
        try:
            if not text.isascii():
                text.encode("latin-1")
            return compiled.findall(text)
        except UnicodeEncodeError:
            if odd is None or not odd.search(text):
                return compiled.findall(text)
            return [text[m.start() : m.end()] for m in compiled.finditer(odd.sub(OTHER, text))]

    return split
