"""Ids by the tokenizers library, each distinct piece of a corpus encoded once."""

from __future__ import annotations

import functools
import json
import re

import regex
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from millrace.llm.pieces import PieceIds

#: The byte-level pattern as published with the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


#: Distinct pre-tokens whose ids a worker keeps.
KEPT_WORDS = 300_000

LETTERS = byte_letters()
TO_LETTERS = {i: c for i, c in enumerate(LETTERS)}


#: From here on the library's character classes and those of `regex` may come from different Unicode versions.
CLASSES_AGREE_BELOW = 0x500


class PreTokens:
    """Pre-tokens of pieces, in byte letters, as the library's byte-level pre-tokenizer cuts them."""

    def __init__(self):
        self.findall = regex.compile(PATTERN).findall
        self.library = ByteLevel(add_prefix_space=False)
        self.far = re.compile(f"[^\\x00-{chr(CLASSES_AGREE_BELOW - 1)}]").search

    def __call__(self, piece: str) -> list[str]:
        if not piece:
            return []
        space = piece[0] == " "
        if piece.isascii():
            # most pieces are a word, perhaps with one mark after it
            if (piece[1:] if space else piece).isalpha():
                return ["Ġ" + piece[1:] if space else piece]
            if piece[-1] in ".,;:!?" and (piece[1:-1] if space else piece[:-1]).isalpha():
                return ["Ġ" + piece[1:-1] if space else piece[:-1], piece[-1]]
            return [p.translate(TO_LETTERS) for p in self.findall(piece)]
        if self.far(piece):
            return [p for p, _ in self.library.pre_tokenize_str(piece)]
        return [p.encode().decode("latin-1").translate(TO_LETTERS) for p in self.findall(piece)]


class LibraryIds:
    """Solves pieces with the tokenizers library: its model encodes each distinct pre-token."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        #: Cutting into pieces and pre-tokens holds for plain byte-level BPE only; else the library gets whole pieces.
        self.plain = (
            spec["model"]["type"] == "BPE"
            and spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        if not self.plain:
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        self.pre = PreTokens()
        self.special = [t["content"] for t in spec["added_tokens"] if t["content"]]
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.words: dict[str, list[int]] = {}
        #: One object for each id: those of kept words would take more memory than the words.
        self.ids = list(range(1 + max(self.tokenizer.get_vocab().values())))

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        tokenize, pre, words, known, out = self.tokenizer.model.tokenize, self.pre, self.words, self.ids, []
        together = "\0".join(pieces)
        special = [s for s in self.special if s in together]
        del together
        for piece in pieces:
            if special and any(s in piece for s in special):
                out.append(self.tokenizer.encode(piece, add_special_tokens=False).ids)
                continue
            ids: list[int] = []
            for word in pre(piece):
                got = words.get(word)
                if got is None:
                    got = [known[t.id] for t in tokenize(word)]
                    if len(word) <= 32:
                        words[word] = got
                ids += got
            out.append(ids)
        return out


@functools.lru_cache(maxsize=2)
def library_ids(path: str) -> PieceIds:
    """One cache per worker process and tokenizer file."""
    return PieceIds(LibraryIds(path))


def vocab_size(path: str) -> int:
    return library_ids(path).solve.vocab_size
