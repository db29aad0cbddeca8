"""Token ids of whole texts by a public tokenizer, with a cache of pieces per Python worker.

Encoding a text piece by piece gives the ids of the whole text where the pieces end at places at which byte-level and
word-end BPE split before they merge: before a space that follows a character other than white space, around a single
line end, and between a letter or digit and a comma or full stop that white space follows. Texts with runs of white
space or of marks, where this is not certain, are encoded whole, and so are those in which the letter before the mark is
one that a normaliser's composition or lower case turns into several characters, as it does the dotted capital I.
Some texts at a time, the pieces are numbered by an Arrow dictionary, so that each distinct one is looked up once, and the
ids are gathered by numbers. Pieces that the cache lacks are encoded together if they are plain letters, else alone.

Strings of special tokens in a text, such as ``<|endoftext|>``, are ordinary text, as the tokenizer files' own
description sets it: whoever writes a text must not be able to end a document in it.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa

#: Pieces that a worker keeps in each of two generations; only speed depends on it.
CACHE_PIECES = 500_000
#: Characters of texts whose pieces are numbered together.
SLICE_CHARS = 1 << 22
#: Words that are encoded as one text; only speed depends on it, and longer texts take the library more time a word.
WORDS_TOGETHER = 300
_ENCODERS: dict[str, "Encoder"] = {}
_SPACE, _NO_LETTER, _MARK, _NUL = 1, 2, 4, 8
#: What characters are; the last place stands for all from there on. Letters that become several characters when composed and in lower case count as none.
_KINDS = np.array(
    [_SPACE * c.isspace() | _NO_LETTER * (not c.isalnum() or len(unicodedata.normalize("NFC", c).lower()) > 1) | _MARK * (c in ".,") | _NUL * (c == "\0") for c in map(chr, range(0x30000))], np.uint8
)


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _unsure(texts: list[str]) -> np.ndarray:
    """Which texts are to be encoded whole: those with a space at an end or beside another, a mark after no letter, or a NUL."""
    code = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le"), "<u4")
    kind = _KINDS[np.minimum(code, len(_KINDS) - 1)]
    space = (kind & _SPACE).astype(bool)
    beside = np.flatnonzero(space[1:] & space[:-1]) + 1
    marks = np.flatnonzero(kind & _MARK)
    marks = marks[space[marks + 1] & ((marks == 0) | (kind[marks - 1] & _NO_LETTER != 0))]
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    out = np.zeros(len(texts), bool)
    out[np.searchsorted(ends, np.concatenate([beside, marks, np.flatnonzero(kind & _NUL)]), "right")] = True
    return out | np.array([t[:1].isspace() or not t for t in texts], bool)


def _marked(text: str) -> str:
    """The text's pieces, each with a space after it: NUL leads those with no space before them, the others follow a space."""
    text = text.replace(", ", " \0, ").replace(". ", " \0. ").replace(".\n", " \0.\n").replace("\n", " \0\n \0")
    return f"\0{text} "


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)  # tokens that end a word, where the vocabulary marks that
        self.begins = np.zeros(self.size, bool)  # tokens that begin with a space
        for token, k in vocabulary.items():
            self.ends[k] = token.endswith("</w>")
            self.begins[k] = token.startswith("Ġ")
        self.line_end = np.frombuffer(self._each(["\n"])[0], "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str], lead: str) -> None:
        """Ids of words of plain letters that follow a space, or that nothing precedes."""
        for at in range(0, len(words), WORDS_TOGETHER):
            some = words[at : at + WORDS_TOGETHER]
            joined = lead + lead.join(some) if lead == " " else lead.join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            if self.ends.any():
                stops = np.flatnonzero(self.ends[ids]) + 1
                starts = np.append(0, stops[:-1])
            elif lead == " ":
                starts = np.flatnonzero(self.begins[ids])
                stops = np.append(starts[1:], len(ids))
            else:
                marks = np.flatnonzero(ids == self.line_end[0])
                starts, stops = np.append(0, marks + 1), np.append(marks, len(ids))
            keys = [f"{w} " if lead == " " else f"\0{w} " for w in some]
            if len(starts) == len(some) and stops[-1] == len(ids):
                data = ids.tobytes()
                self.known.update(zip(keys, [data[a:b] for a, b in zip((4 * starts).tolist(), (4 * stops).tolist())]))
            else:
                self.known.update(zip(keys, self._each([" " * (lead == " ") + w for w in some])))

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > CACHE_PIECES:
            self.older, self.known = self.known, {}
        after, first, alone = [], [], []
        for piece in pieces:
            ids = self.older.get(piece)
            if ids is not None:
                self.known[piece] = ids
                continue
            head = piece[:1] == "\0"
            letters = piece[head:-1]
            if letters.isalpha() and (letters.isascii() or max(letters) < "ɐ"):
                (first if head else after).append(letters)
            else:
                alone.append(piece)
        self._together(after, " ")
        self._together(first, "\n")
        self.known.update(zip(alone, self._each([p[1:-1] if p[:1] == "\0" else " " + p[:-1] for p in alone])))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for text in texts:
            if some and size + len(text) > SLICE_CHARS:
                out += self._encoded(some)
                some, size = [], 0
            some.append(text)
            size += len(text)
        return out + self._encoded(some)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        unsure = _unsure(texts).tolist()
        whole = iter(self._each([t for t, u in zip(texts, unsure) if u]))
        parts = iter(self._by_pieces([_marked(t) for t, u in zip(texts, unsure) if not u]))
        return [next(whole if u else parts) for u in unsure]

    def _by_pieces(self, marked: list[str]) -> list[bytes]:
        """Ids of texts that are given as pieces with a space after each."""
        data = "".join(marked).encode()
        stops = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
        offsets = np.append(0, stops)
        numbered = pa.LargeStringArray.from_buffers(len(stops), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        pieces = numbered.dictionary.to_pylist()
        ids = list(map(self.known.get, pieces))
        missing = {p for p, i in zip(pieces, ids) if i is None}
        if missing:
            self._learn(missing)
            get = self.known.get
            ids = [get(p) if i is None else i for p, i in zip(pieces, ids)]
        # Each piece's ids stand once in one array; a text's are gathered from there.
        many = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start, flat = np.cumsum(many) - many, np.frombuffer(b"".join(ids), "<u4")
        which = numbered.indices.to_numpy()
        sizes = many[which]
        ends = np.append(0, np.cumsum(sizes))
        got = flat[np.arange(ends[-1]) + np.repeat(start[which] - ends[:-1], sizes)].tobytes()
        texts = np.append(0, np.cumsum([t.count(" ") for t in marked], dtype=np.int64))
        bounds = (4 * ends[texts]).tolist()
        return [got[a:b] for a, b in zip(bounds, bounds[1:])]
