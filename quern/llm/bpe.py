"""Exact byte-level BPE with a public vocabulary.

``Encoder.encode`` gives what the ``tokenizers`` library gives for the vocabulary file, with its
special tokens recognised in text. Most texts go through ``tiktoken``, which holds the same
vocabulary as ranks and is several times as fast; texts outside the characters for which the two
libraries' pattern is known to agree, with a special token's string, or with very long runs
without a blank go through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_OF_TEXT = "<|endoftext|>"
#: Latin letters, general punctuation; no run of a thousand letters or blanks.
_UNUSUAL = re.compile(r"[^\x00-ɏ‐-›]|\S{1000}|\s{1000}")


class Encoder:
    def __init__(self, vocabulary: str, ranks: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.bytes = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for piece, i in table.items():
            self.bytes[i] = piece
        #: Tokens that are a blank and a visible ASCII character first: a word begins there in any context.
        self.begins = [len(b) > 1 and b[0] == 32 and 33 <= b[1] <= 126 for b in self.bytes]

    def usual(self, text: str) -> bool:
        return not _UNUSUAL.search(text)

    def encode(self, text: str) -> list[int]:
        if END_OF_TEXT not in text and self.usual(text):
            return self.fast.encode_ordinary(text)
        return self.library.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """One encoder per worker process."""
    return Encoder(vocabulary, ranks)
