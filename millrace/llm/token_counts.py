"""Token counts by the whole-token shortcut (operator 5).

`prove` asks the model once, offline, which strings encode alone as a single token. A text is cut where no token of the
model can pass (before a space that follows something else, and before a line end); a piece that is one proven string is
counted without encoding, and only the rest is merged by the library, each distinct piece once.

Cutting rests on two facts that `prove` checks for the given model, or it raises: no vocabulary string has the word
marker after another character, and none holds a line end, which the model writes as a single byte token.

Null text counts as empty: no bytes, no tokens. Rows are independent; repeated rows and ids, and extra columns, change
nothing. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from millrace.llm.common import bounds, slices, texts
from millrace.llm.pieces import coded

MARK = "▁"
CUT = re.compile(r"\n[^ \n]*| *[^ \n]+| +")
#: The quick way cuts at every space and line end; runs of spaces, and NUL, go the slow way.
UNEVEN = "  |\\x00"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
KEPT = 300_000


class Counter:
    """Tokens of pieces; a piece is a line end or spaces, and what follows."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.proven = self.prove()
        self.known: dict[str, int] = {}

    def prove(self) -> dict[str, int]:
        """Pieces of one vocabulary string, with their tokens: those the model gives that string alone."""
        model = self.model
        vocabulary = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [(i, p) for i, p in enumerate(vocabulary) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(MARK in p.lstrip(MARK) or "\n" in p for _, p in plain):
            raise ValueError("tokens of this model can pass a word marker or a line end")
        line = model.encode("\n")
        if len(line) != 2 or vocabulary[line[0]] != MARK or not model.is_byte(line[1]):
            raise ValueError("this model does not put a word marker before a text and one byte token for a line end")
        found = {" ": 1, "\n": 1}
        alone = [(i, p[1:]) for i, p in plain if p[0] == MARK and p[1:] and MARK not in p[1:] and " " not in p]
        for (i, word), ids in zip(alone, model.encode([w for _, w in alone]), strict=True):
            if ids == [i]:
                found[" " + word] = 1
        inner = [(i, p) for i, p in plain if MARK not in p and " " not in p]
        for (i, word), ids in zip(inner, model.encode(["\n" + w for _, w in inner]), strict=True):
            if ids == [*line, i]:
                found["\n" + word] = 2
        return found

    def merge(self, pieces: list[str]) -> list[int]:
        """By the library; it puts a word marker before each text, which stands for one space of the piece."""
        asked = [p[1:] if p[0] == " " else p for p in pieces]
        less = [1 if p[0] == "\n" else 0 for p in pieces]
        return [len(ids) - x for ids, x in zip(self.model.encode(asked, num_threads=1), less, strict=True)]

    def counts(self, pieces: list[str], repeated: np.ndarray) -> np.ndarray:
        proven, known = self.proven, self.known
        out = np.fromiter((proven.get(p) or known.get(p, -1) for p in pieces), np.int64, len(pieces))
        rest = np.flatnonzero(out < 0)
        if rest.size:
            new = [pieces[i] for i in rest]
            out[rest] = self.merge(new)
            if len(known) + len(new) > KEPT:
                known.clear()
            known.update((pieces[i], int(out[i])) for i in rest if repeated[i] and len(pieces[i]) <= 64)
        return out


def cut(text: str) -> list[str]:
    return CUT.findall(text)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(df: DataFrame, model_path: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row's whole text, tokens as the piece model gives them."""

    def run(batches):
        for part in slices(batches):
            yield count_batch(part)

    def count_batch(part):
        count = counter(model_path)
        column = part.column("text").cast(pa.large_string())
        length = np.asarray(pc.binary_length(column), dtype=np.int64)
        # a text gets the marker of its first word; the empty text gets none
        led = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.replace_substring(column, MARK, " "), pa.scalar("", pa.large_string()))
        pieces = coded(led, cut, UNEVEN)
        repeated = np.bincount(pieces.codes, minlength=len(pieces.values)) > 1
        # the text's own first, empty piece comes before its leading space
        tokens = np.zeros(len(pieces.values), np.int64)
        real = np.flatnonzero(np.fromiter(map(len, pieces.values), np.int64, len(pieces.values)) > 0)
        tokens[real] = count.counts([pieces.values[i] for i in real], repeated[real])
        total = bounds(tokens[pieces.codes])[bounds(pieces.sizes)]
        n = np.where(length > 0, np.diff(total), 0)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(length), pa.array(n), pa.array(n > limit)],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return texts(df, doc_id, text).mapInArrow(run, SCHEMA)
