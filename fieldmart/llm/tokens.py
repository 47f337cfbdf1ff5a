"""Token ids of whole texts with the ``tokenizers`` library.

Texts repeat their words, so a batch is cut into pieces, each distinct piece is
encoded once, and the ids are gathered back in text order. The cuts are places
where the tokenizer's own splitting pattern always ends a pre-token:

* before a run of ASCII white space that follows other text (no alternative of
  the two patterns goes on from text into white space), and
* between an ASCII letter or digit and an ASCII mark other than the apostrophe
  (letters, digits and marks are separate alternatives; only contractions join
  them, and those begin with the apostrophe).

No alternative looks back, so pre-tokens after a cut don't depend on what
stands before it. For the lower-casing tokenizer, A-Z and the white space
characters are folded first, which its normaliser does anyway. A piece that is
one pre-token (an optional space and letters below U+0100) goes straight to the
library's BPE model; any other piece goes through the library's ``encode``.
Tokenizers of other kinds encode whole texts."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa

from fieldmart.llm.common import IS_SPACE, gather

#: Bytes with A-Z in lower case and every space as 0x20.
PLAIN = np.frombuffer(bytes(range(256)).lower(), np.uint8).copy()
PLAIN[IS_SPACE] = 32
#: Distinct pieces that one Python worker remembers; then it starts anew.
REMEMBERED = 500_000

_codes = np.arange(256)
ALNUM = ((_codes >= 48) & (_codes < 58)) | ((_codes >= 65) & (_codes < 91)) | ((_codes >= 97) & (_codes < 123))
MARK = (_codes > 32) & (_codes < 127) & ~ALNUM & (_codes != 39)


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 characters stand for themselves,
    the other bytes for the characters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


class Encoder:
    """Ids of many texts at once, each text followed by ``end_id``."""

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.size = self.tokenizer.get_vocab_size()
        self.end_id = end_id
        self.kind = self._kind(spec)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self._forget()

    @staticmethod
    def _kind(spec: dict) -> str:
        before, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec["model"].get("dropout"):
            return "whole"
        if before is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return "byte"
        steps = [s["type"] for s in (before or {}).get("normalizers", [])]
        if steps == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            return "word"
        return "whole"

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)
        self.used = 0

    def _piece_ids(self, piece: str) -> list[int] | None:
        """Ids of a piece that is one pre-token, else None."""
        core = piece[1:] if piece[0] == " " else piece
        if not core.isalpha() or not (core.isascii() or max(core) < "Ā"):
            return None
        if self.kind == "word":
            piece = core.lower()
        if not piece.isascii() or piece[0] == " ":
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)]

    def _learn(self, pieces: list[str]) -> None:
        ids = [self._piece_ids(p) for p in pieces]
        odd = [i for i, x in enumerate(ids) if x is None]
        for i, e in zip(odd, self.tokenizer.encode_batch([pieces[i] for i in odd], add_special_tokens=False)):
            ids[i] = e.ids
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((t for x in ids for t in x), np.uint32, int(lengths.sum()))
        n, to = len(self.known), self.used + len(flat)
        while len(self.starts) < n + len(ids):
            self.starts, self.lengths = np.append(self.starts, np.zeros_like(self.starts)), np.append(self.lengths, np.zeros_like(self.lengths))
        while len(self.flat) < to:
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        self.flat[self.used:to] = flat
        self.lengths[n:n + len(ids)] = lengths
        self.starts[n:n + len(ids)] = self.used + np.cumsum(lengths) - lengths
        self.known.update(zip(pieces, range(n, n + len(ids))))
        self.used = to

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts data[offsets[i]:offsets[i + 1]],
        one after the other, and where each text's ids end."""
        n_texts = len(offsets) - 1
        if self.kind == "whole":
            raw = data.tobytes()
            found = self.tokenizer.encode_batch([raw[a:b].decode() for a, b in zip(offsets, offsets[1:])], add_special_tokens=False)
            lengths = np.fromiter((len(e.ids) for e in found), np.int64, n_texts)
            ids = np.fromiter((t for e in found for t in e.ids), np.uint32, int(lengths.sum()))
            return self._ended(ids, np.cumsum(lengths))
        if not len(data):
            return self._ended(np.zeros(0, np.uint32), np.zeros(n_texts, np.int64))
        space = IS_SPACE[data]
        if self.kind == "word":
            data = PLAIN[data]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[1:] |= ALNUM[data[:-1]] & MARK[data[1:]]
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) + len(distinct) > REMEMBERED:
            self._forget()
        new = [p for p in distinct if p not in self.known]
        if new:
            self._learn(new)
        at = np.fromiter((self.known[p] for p in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        lengths = self.lengths[at]
        ids = gather(self.flat, self.starts[at], lengths)
        before = np.concatenate([[0], np.cumsum(lengths)])
        return self._ended(ids, before[np.searchsorted(starts, offsets[1:])])

    def _ended(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.end_id is None:
            return ids, ends
        return np.insert(ids, ends, np.uint32(self.end_id)), ends + np.arange(1, len(ends) + 1)


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int | None) -> Encoder:
    """The worker's encoder for a tokenizer file (loaded once)."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]
