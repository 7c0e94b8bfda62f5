"""Whole-text encoding with the ``tokenizers`` library, sped up by a word cache.

A byte-level BPE file first splits a text into pieces with a fixed pattern and
merges inside each piece alone, so the ids of a text are the ids of its pieces
in order.  :class:`PieceEncoder` splits with the same pattern, asks the library
once for each piece it has not seen (for ids the library's model alone, as nothing
is left to split), and joins the remembered ids.  A text with
characters on which Python's classes and the library's could differ, or with the
string of an added token, goes to the library whole.  Any file of another kind
also goes to the library whole.  ``tests/llm`` holds the ids against the
library's own.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np

DEFAULT_TOKENIZER = "byte_bpe_50k.json"

#: Letters up to U+024F; splittable texts have no others (see _ODD).
_L = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
#: The library's pattern over such texts, with the commonest case first: no other alternative can start where it does.
_PIECE = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{_L}0-9]+|\s+(?!\S)|\s+")
#: Where \w, \d and \s may differ between the two libraries; such texts go whole.  In ASCII these are few.
_ODD_ASCII = ("\x1c", "\x1d", "\x1e", "\x1f")
_ODD = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧€]")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """The place of a vocabulary file, as the installed package tells it."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """The ids of pieces as bytes; a piece that is not there yet is asked of the library's model."""

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in (*range(0x250), *range(0x2010, 0x2028), 0x20AC) if not _ODD.match(chr(c))}
        self.tokenize = tokenizer.model.tokenize

    def __missing__(self, piece: str) -> bytes:
        ids = [t.id for t in self.tokenize(piece.translate(self.letters))]
        value = self[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return value

    def shrink(self, capacity: int) -> None:
        """Forget the longer pieces, which are the rarer ones; all, if the short ones alone fill half the room."""
        short = {w: v for w, v in self.items() if len(w) <= 7}
        self.clear()
        if len(short) <= capacity // 2:
            self.update(short)


class PieceEncoder:
    """Encodes batches of texts; keeps at most ``capacity`` pieces, for ids and those of one text."""

    def __init__(self, path: str, spans: bool = False, capacity: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.split = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and spec.get("post_processor") is None
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.spans, self.capacity = spans, capacity
        self.known = _Known(self.tokenizer) if self.split and not spans else {}
        self.encode = self.tokenizer.encode_batch if spans else self.tokenizer.encode_batch_fast

    def _value(self, encoding) -> bytes:
        if self.spans:
            return np.array(encoding.offsets, dtype="<i4").reshape(-1, 2).tobytes()
        return np.array(encoding.ids, dtype="<u4").tobytes()

    def _learn_joined(self, words: list[str], text: str, step: int) -> bool:
        """Encode ``words`` as one text, of which they are every ``step``-th piece."""
        (got,) = self.tokenizer.encode_batch([text], add_special_tokens=False)  # the fast form has no word ids
        of = np.array(got.word_ids, dtype=np.int64)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(of)) + 1, [len(of)])) if len(of) else np.array([0])
        if len(edges) - 1 != step * len(words) - (step - 1):
            return False
        first, last = edges[:-1][::step].tolist(), edges[1:][::step].tolist()
        values, at = np.array(got.offsets, dtype="<i4").reshape(-1, 2), 0
        for w, a, b in zip(words, first, last):
            self.known[w] = (values[a:b] - at).astype("<i4").tobytes()
            at += len(w) + (step - 1)
        return True

    def _learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.known))
        if len(self.known) + len(new) > self.capacity:
            self.known = {w: v for w, v in self.known.items() if len(w) <= 7 or w in pieces}  # the short ones are the common ones
            if len(self.known) + len(new) > self.capacity:
                self.known, new = {}, list(pieces)
        spaced, bare, rest = [], [], []
        for w in new:
            (spaced if w[0] == " " and w[1:].isalpha() else bare if w.isalpha() else rest).append(w)
        for words, glue in ((spaced, ""), (bare, "\n")):
            for i in range(0, len(words), 2048):
                part = words[i : i + 2048]
                if not self._learn_joined(part, glue.join(part), 1 + len(glue)):
                    rest += part
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            for w, e in zip(part, self.encode(part, add_special_tokens=False)):
                self.known[w] = self._value(e)

    def _splits(self, text: str) -> bool:
        if not self.split or any(t in text for t in self.added):
            return False
        return not any(c in text for c in _ODD_ASCII) if text.isascii() else not _ODD.search(text)

    def _pieces(self, texts: list[str]) -> list[list[str] | None]:
        pieces = [_PIECE.findall(t) if self._splits(t) else None for t in texts]
        self._learn(set().union(*[p for p in pieces if p]))
        return pieces

    def ids(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        get, out = self.known.__getitem__, []
        for text in texts:
            if not self._splits(text):
                out.append(self._value(self.encode([text], add_special_tokens=False)[0]))
                continue
            out.append(b"".join(map(get, _PIECE.findall(text))))
            if len(self.known) > self.capacity:
                self.known.shrink(self.capacity)
        return out

    def token_spans(self, texts: list[str]) -> list[np.ndarray]:
        """For each text an (n, 2) array of its tokens' character spans."""
        pieces, get, out = self._pieces(texts), self.known.__getitem__, []
        for text, own in zip(texts, pieces):
            if own is None:
                out.append(np.array(self.encode([text], add_special_tokens=False)[0].offsets, dtype=np.int64).reshape(-1, 2))
                continue
            parts = list(map(get, own))
            spans = np.frombuffer(b"".join(parts), dtype="<i4").reshape(-1, 2).astype(np.int64)
            size = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
            count = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 8
            out.append(spans + np.repeat(np.cumsum(size) - size, count)[:, None])
        return out


@lru_cache(maxsize=4)
def encoder(path: str, spans: bool = False) -> PieceEncoder:
    """One encoder for each file and Python worker."""
    return PieceEncoder(path, spans)


def text_slices(texts, limit: int = 4 << 20):
    """Yield (from, texts) of about ``limit`` bytes each from an Arrow string array; null is empty."""
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, n = 0, len(texts)
    total = np.cumsum(size, dtype=np.int64)
    while at < n:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, "right")))
        yield at, ["" if x is None else x for x in texts.slice(at, end - at).to_pylist()]
        at = end
