"""Byte-level BPE ids of whole texts, with a bounded memory of pre-tokens.

BPE never crosses the borders of pre-tokens, so the ids of a text are those of
its pre-tokens in a row. Pre-tokens not met before are encoded by the
``tokenizers`` library, a batch at a time. Texts in plain Latin script are cut
by a regular expression that agrees there with the tokenizer's own cutting;
any other text is handed to the tokenizer whole.

With the vocabulary's ranks, ``tiktoken`` encodes whole plain texts. It gives the
same ids, and its time does not hang on how many pre-tokens are new.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

SEPARATOR_ID = 0
MOST_KEPT = 300_000  # pre-tokens; all are dropped when there are more

#: The pre-token pattern of the public byte-level BPE vocabularies,
#: its classes written out for the characters in _PLAIN.
_PRE_TOKEN = re.compile(
    r" ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼½¾]+|'(?:[sdmt]|ll|ve|re)"
    r"| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼½¾]+|\s+(?!\S)|\s+"
)
#: ASCII without the separators 1C to 1F, Latin letters, common punctuation, euro sign.
_PLAIN = re.compile("[\x00-\x1b\x20-\x7e\xa0-ɏ‐-‧‰-⁞₠-₿]*")
_SPECIAL = "<|endoftext|>"
#: White space that ``tiktoken`` might not get through; its other runs take time in proportion.
_LONG_SPACE = re.compile(r"\s{400}")


def rank_encoding(ranks: str):
    """The vocabulary in a file of ranks, as ``tiktoken`` has it; no special tokens."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        pairs = (line.split() for line in lines)
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


class Pieces:
    """Encodes texts with one tokenizer file; one object per Python worker.

    With ``ordinary`` the strings of special tokens are text like any other.
    ``ranks`` may name a file with the same vocabulary as ranks, for whole texts.
    """

    def __init__(self, path: str, ordinary: bool = False, ranks: str | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = ordinary
        self._special = () if ordinary else (_SPECIAL,)
        self._ids: dict[str, bytes] = {}
        self._fast = rank_encoding(ranks) if ranks else None

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text in which special tokens do not count."""
        if _PLAIN.fullmatch(text):
            return _PRE_TOKEN.findall(text)
        spans = self._tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[start:end] for _, (start, end) in spans]

    def look_up(self, parts: list[str]) -> list[bytes]:
        """Ids of pre-tokens, as little-endian 32-bit words."""
        try:
            return [self._ids[part] for part in parts]
        except KeyError:
            pass
        new = list({part for part in parts if part not in self._ids})
        if len(self._ids) + len(new) > MOST_KEPT:
            self._ids = {}
            new = list(set(parts))
        found = self._tokenizer.encode_batch_fast(new, add_special_tokens=False)
        for part, encoded in zip(new, found):
            self._ids[part] = np.array(encoded.ids, "<u4").tobytes()
        return [self._ids[part] for part in parts]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, as little-endian 32-bit words."""
        if _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
            if self._fast and not _LONG_SPACE.search(text):
                return array("I", self._fast.encode_ordinary(text)).tobytes()
            return b"".join(self.look_up(_PRE_TOKEN.findall(text)))
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def pieces_of(path: str, ordinary: bool = False, ranks: str | None = None) -> Pieces:
    return Pieces(path, ordinary, ranks)
