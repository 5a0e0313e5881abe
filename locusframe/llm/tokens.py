"""Exact token ids of the given tokenizers, piece by piece with a bounded memory of pieces.

A text is cut where the tokenizer itself never merges across (pre-tokens of a
byte-level vocabulary, ASCII white space of a vocabulary that drops white space).
Each distinct piece goes through the library once and is remembered; a text is
the concatenation of its pieces. Tokenizers of any other form get whole texts.
"""

from __future__ import annotations

import json
import re
import struct

#: Words and pre-tokens that a worker remembers in one generation; it keeps two.
WORDS, PIECES = 400_000, 125_000

# The pre-token pattern of the byte-level vocabulary.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same over U+0000 to U+00FF, with the classes of these code points written out.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0"
LATIN = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

# Byte-level vocabularies write a byte as a printable character: itself where it prints, else one from U+0100 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = dict(zip([b for b in range(256) if b not in _PRINTS], map(chr, range(256, 512))))

_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")


_memories: list[Memory] = []


class Memory(dict):
    """What make(key) gives for each key, remembered for two generations of at most `size` keys."""

    def __init__(self, make, size: int = PIECES, fixed: dict | None = None):
        super().__init__(fixed or {})
        self.make, self.size, self.fixed, self.old = make, size, fixed or {}, {}
        _memories.append(self)

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > self.size + len(self.fixed):
            self.old = dict(self)
            self.clear()
            self.update(self.fixed)


def forget(keep: Memory | None = None) -> None:
    """Empty all memories but one: a worker serves many stages, and holds what the present one needs."""
    for memory in _memories:
        if memory is not keep and (memory.old or len(memory) > len(memory.fixed)):
            memory.old = {}
            memory.clear()
            memory.update(memory.fixed)


class Pieces:
    """A tokenizer file and the way its texts may be cut."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        plain = all(x["special"] and not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in spec.get("added_tokens") or [])
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        kinds = [x.get("type") for x in norm.get("normalizers", [])]
        self.kind = "whole"
        if plain and not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self.kind = "byte"
        elif plain and kinds == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]:
            split = pre["pretokenizers"][0]
            # only what the pattern matches is kept, and it has no white space
            if split["invert"] and split["behavior"] == "Removed" and split["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
                self.kind = "word"
        self.any_text, self.latin = regex.compile(BYTE_LEVEL), re.compile(LATIN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.model = self.library.model
        self.memory = Memory(self._word, WORDS) if self.kind == "word" else Memory(self._piece)

    def pre_token(self, piece: str) -> list[int]:
        """Ids of one pre-token of a byte-level vocabulary: the merges alone."""
        return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))]

    def _piece(self, piece: str) -> bytes:
        if piece in self.special:
            ids = [self.special[piece]]
        elif self.kind == "byte":
            ids = self.pre_token(piece)
        else:
            ids = self.library.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """Letters of Latin-1 with marks behind them are two pieces; lower case of these letters depends on no neighbour."""
        m = _PLAIN.fullmatch(word)
        if m and (m[2] or word != word.lower()):
            return self.memory[m[1].lower()] + (self.memory[m[2]] if m[2] else b"")
        if m:
            ids = self.pre_token(word)
            return struct.pack(f"<{len(ids)}I", *ids)
        return self._piece(word)

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii():
            return self.latin.findall(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_text.findall(text)
        return self.latin.findall(text)

    def split(self, text: str) -> list[str]:
        """Pieces whose ids, one after the other, are the ids of the text."""
        if self.kind == "whole":
            return [text] if text else []
        if self.kind == "word":
            return text.replace("\n", " ").split(" ")
        if self.cut is None or not any(s in text for s in self.special):
            return self.pre_tokens(text)
        return [p for part in self.cut.split(text) for p in ([part] if part in self.special else self.pre_tokens(part))]

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.kind == "whole":
            return self._piece(text)
        return b"".join(map(self.memory.__getitem__, self.split(text)))


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One tokenizer for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    forget(_loaded[path].memory)
    return _loaded[path]
