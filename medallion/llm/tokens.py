"""Token ids of texts, with the pieces already seen kept in memory.

The tokenizer cuts a text into pieces before it merges bytes, and encodes each piece by
itself. Pieces repeat, so each is handed to the tokenizers library once per worker and
looked up afterwards, which gives the library's ids at a fraction of its time.
"""

from __future__ import annotations

import operator
import os
import re

import numpy as np
import regex

# The tokenizer's own cutting rule: a fixed value.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Letters on whose classes all versions of Unicode agree; texts with others go to the library whole.
_ODD = re.compile("[^\\x09-\\x0d\\x20-\\x7e¡-ԯ‐-‧‰-‾ぁ-ゖァ-ヺ一-龥가-힣]")
_NEWLINE = np.uint32(198)
_KEPT_BYTES = 192 << 20
_BATCH = 256  # strings handed over at once; more of them leave the processor's caches
# What a kept string takes besides its characters and ids, its place in the table included.
_ENTRY_BYTES = 140
# A word with punctuation behind it: two pieces, each encoded by itself.
_ENDED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")
_PLAIN_ENDED = re.compile(r"(\n?[A-Za-z]+)([!-&(-/:-@\[-`{-~]+)")  # the same, where a look at each letter is not needed
# Marks of words whose texts can't be encoded word by word, or by pieces either.
_BY_PIECES, _WHOLE = None, 0


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers in bytes.

    ``kept`` bounds the bytes that remembered strings take; the ids don't depend on it.
    """

    def __init__(self, path: str, kept: int = _KEPT_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.library = Tokenizer.from_file(path)
        model = self.library.model
        # Strings are handed over once: the library need not remember them too.
        model._resize_cache(0)
        self.library.model = model
        # For lines that are one piece each: the same, without the search for where pieces end.
        self.uncut = Tokenizer(model)
        self.uncut.pre_tokenizer = Sequence(
            [Split("\n", "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.kept = kept
        self.forget()

    def forget(self) -> None:
        # Words with the line feed that precedes them, or without the blank that does.
        self.words: dict[str, bytes | int | None] = {}
        self.former: dict[str, bytes | int | None] = {}  # those before room was made
        self.ends: dict[str, bytes] = {}  # punctuation behind words
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; words new to several texts are handed over together.

        A blank or line feed between two characters that are not white space always
        starts a piece, so texts can be encoded by words if each word is not empty and
        free of white space.
        """
        cut = [f"\n{text}".replace("\n", " \n").split(" ")[1:] for text in texts]
        self._learn(set().union(*cut))
        known, found = self.words, []
        for text, words in zip(texts, cut):
            try:
                found.append(b"".join(map(known.__getitem__, words))[_NEWLINE.nbytes :])
            except TypeError:
                odd = any(known[w] == _WHOLE for w in words)
                found.append(self._whole(text) if odd else self._encode_pieces(text))
        return found

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _remember(self, where: dict, strings: list[str], ids: list) -> None:
        where.update(zip(strings, ids))
        self.held += _ENTRY_BYTES * len(strings) + sum(map(len, strings)) + sum(map(len, filter(None, ids)))

    def _learn(self, words: set[str]) -> None:
        """Keep the ids of all these words, or the mark of those that spoil a text for it.

        When the memory is half full, what it holds becomes former; of that, what is
        asked for again before the next time moves back, and the rest is forgotten.
        """
        if self.held > self.kept // 2:
            former = self.words
            self.forget()
            self.former = former
        new = words.difference(self.words)
        again = [w for w in new if w in self.former]
        self._remember(self.words, again, [self.former[w] for w in again])
        alone, mixed = [], []  # of letters only, which are one piece, and others
        ended, heads, tails = [], [], []
        for word in new.difference(again) if again else new:
            if word.isascii():
                if word.isalpha():
                    alone.append(word)
                    continue
                parts = _PLAIN_ENDED.fullmatch(word)
                if parts is not None and "<|" not in word:
                    ended.append(word)
                    heads.append(parts[1])
                    tails.append(parts[2])
                    continue
            plain = word[1:] if word[:1] == "\n" else word
            if plain.isascii() and plain.isalpha():
                alone.append(word)
            elif _ODD.search(plain) or "<|" in plain:
                self._remember(self.words, [word], [_WHOLE])
            elif plain.isalpha():
                alone.append(word)
            elif len(plain.split()) != 1 or plain != plain.strip():
                self._remember(self.words, [word], [_BY_PIECES])
            else:
                parts = _ENDED.fullmatch(plain)
                if parts is None or not parts[1].isalpha():
                    mixed.append(word)
                else:
                    ended.append(word)
                    heads.append(word[: -len(parts[2])])
                    tails.append(parts[2])
        self._keep(mixed, self.library)
        self._keep(alone, self.uncut)
        self._keep(list(set(heads).difference(self.words)), self.uncut)
        new_tails = list(set(tails).difference(self.ends))
        self._remember(self.ends, new_tails, self._encode_lines(new_tails, self.library))
        both = map(operator.add, map(self.words.__getitem__, heads), map(self.ends.__getitem__, tails))
        self._remember(self.words, ended, list(both))

    def _keep(self, words: list[str], library) -> None:
        """Keep the ids of words that are free of white space."""
        first, later = [w for w in words if w[0] == "\n"], [w for w in words if w[0] != "\n"]
        newline = _NEWLINE.tobytes()
        self._remember(self.words, first, [newline + ids for ids in self._encode_lines([w[1:] for w in first], library)])
        self._remember(self.words, later, self._encode_lines([" " + w for w in later], library))

    def _encode_lines(self, strings: list[str], library) -> list[bytes]:
        """The ids of each string. Line feeds are pieces of their own, so they mark where each ends."""
        found: list[bytes] = []
        for at in range(0, len(strings), _BATCH):
            some = strings[at : at + _BATCH]
            encoded = library.encode_batch_fast(["\n".join(some)], add_special_tokens=False)
            ids = np.array(encoded[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == _NEWLINE)
            starts, ends = np.append(0, cuts + 1).tolist(), np.append(cuts, len(ids)).tolist()
            found += [ids[start:end].tobytes() for start, end in zip(starts, ends)]
        return found

    def _encode_pieces(self, text: str) -> bytes:
        """Any text, piece by piece; pieces that are all white space are encoded alone."""
        pieces = _PIECE.findall(text)
        new = [p for p in dict.fromkeys(pieces) if p not in self.pieces]
        blank = [p for p in new if p.isspace()]
        plain = [p for p in new if not p.isspace()]
        self._remember(self.pieces, blank, [self._whole(p) for p in blank])
        self._remember(self.pieces, plain, self._encode_lines(plain, self.library))
        return b"".join(map(self.pieces.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist(), skip_special_tokens=False)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
