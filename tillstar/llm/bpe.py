"""Token ids of whole texts, as the ``tokenizers`` library gives them for a byte-level BPE file.

A byte-level BPE first splits a text into pieces and never merges across them. A single space that stands between
two other characters begins a piece, a single line feed is one, and a run of letters ends one. So a text is cut
there and each chunk's ids are remembered. Encoding a chunk is left to the library; what this saves is
encoding the same word millions of times.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable

from tillstar.llm.common import Memo

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# White space apart from the space and the line feed: a text that holds any is cut by the general rule.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# Chunks that are remembered.
CACHE_ENTRIES = 1 << 20
# Letters, and some signs that only ``isalpha`` tells from them.
LETTERS = re.compile(r"[^\W\d_]*")
# Byte-level BPE files write printable Latin-1 bytes as themselves and the others from U+0100 on.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LEVEL = {b: 0x100 + n for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
RUNS = ("  ", " \n", "\n ", "\n\n")
BEFORE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file: the tokenizer's version in caches."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class Encoder:
    """``ids(text)``: little-endian 32-bit ids of a whole text, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = Memo(lambda chunk: self.parts(chunk, self.first, ""), CACHE_ENTRIES)
        self.later = Memo(lambda chunk: self.parts(chunk, self.later, " "), CACHE_ENTRIES)
        self.line = self.encode("\n")
        self.model = self.tokenizer.model
        parts = json.loads(self.tokenizer.to_str())
        self.byte_level = parts["normalizer"] is None and (parts["pre_tokenizer"] or {}).get("type") == "ByteLevel"

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def parts(self, chunk: str, memo: Memo, before: str) -> bytes:
        """A run of letters ends a piece of the pre-tokenizer, so what follows the first run is looked up by itself."""
        if self.byte_level and chunk.isalpha():
            # one piece: the model takes it as it is, in the byte-level alphabet
            ids = [t.id for t in self.model.tokenize((before + chunk).encode().decode("latin-1").translate(BYTE_LEVEL))]
            return struct.pack(f"<{len(ids)}I", *ids)
        n = len(LETTERS.match(chunk)[0])
        if 0 < n < len(chunk) and chunk[:n].isalpha():
            return memo[chunk[:n]] + self.first[chunk[n:]]
        return self.encode(before + chunk)

    def words(self, line: str) -> Iterable[bytes]:
        head, *rest = line.split(" ")
        return (self.first[head], *map(self.later.__getitem__, rest))

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self.encode(text)
        ends = text[0] in " \n" or text[-1] in " \n"
        if ends or any(map(text.__contains__, RUNS)) or any(map(text.__contains__, OTHER_SPACES)):
            return b"".join(map(self.first.__getitem__, BEFORE_SPACE.split(text)))
        # every space and line feed stands alone between other characters: a line feed is a piece of its own
        return self.line.join(b"".join(self.words(line)) for line in text.split("\n"))
