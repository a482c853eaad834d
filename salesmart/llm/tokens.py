"""Token ids of texts, equal to those of a public tokenizer file."""

from __future__ import annotations

import base64
import re

import numpy as np

from salesmart.llm.common import per_process

# Characters on which both libraries agree about letters, digits and white space,
# whatever version of Unicode they were built for: printable ASCII, tab, line
# ends, Latin letters with marks.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ɏ]")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a text as little-endian 32-bit numbers.

    ``path`` is a tokenizer file of the tokenizers library; ``ranks`` the same
    vocabulary for tiktoken, which is several times as fast. Texts of plain
    Latin script go to the latter, all others and those that spell a special
    token to the former. Tests compare the two.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        self.path, self.fast = path, ranks and per_process(ranks, lambda: _tiktoken(ranks))

    def encode(self, text: str) -> bytes:
        if self.fast and _SPECIAL not in text and not _OTHER.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        found = per_process(self.path, lambda: _tokenizer(self.path))
        return np.array(found.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _tiktoken(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
