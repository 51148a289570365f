"""Exact token ids by the tokenizers library, with the whole-token shortcut and a bounded memory of chunks.

A pre-tokenizer never lets a piece cross certain places, so a text is cut there first (`str.split`), each distinct chunk is encoded once, and
the rest is a dictionary lookup in C. In a chunk that is new, pieces which the offline proof (`whole_tokens`) knows as one token take
their id directly; only the others go through the library's merges."""

from __future__ import annotations

import contextlib
import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

#: Chunks that one Python worker remembers, in two generations.
REMEMBERED = 500_000
#: Longest chunk that is remembered; longer ones (no space for thousands of characters) are encoded each time.
LONG_CHUNK = 256
#: Marks that often end a word; each is a pre-token there.
ENDS = ",.;:!?"
#: White space as the library's pattern knows it (Unicode White_Space).
SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"


def load(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file's text, read by the driver and broadcast: executors need no local copy. A vocabulary file is a few MB; over 64 MB is refused."""
    with open(path, encoding="utf-8") as f:
        text = f.read(64 * 2**20 + 1)
    if len(text) > 64 * 2**20:
        raise ValueError(f"{path}: over 64 MB, not a vocabulary to broadcast")
    return spark.sparkContext.broadcast(text)


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: printable Latin-1 as itself, the others from U+0100 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in own else chr(256 + extra))
        extra += b not in own
    return out


LETTERS = byte_letters()
BYTES = {c: b for b, c in enumerate(LETTERS)}


class Codec:
    """One tokenizer on one worker. `ids(text)`: little-endian ids of `dtype`, without begin, end or added special tokens."""

    def __init__(self, text: str, dtype: str = "<u4"):
        self.spec, self.library = json.loads(text), Tokenizer.from_str(text)
        self.dtype, self.model = dtype, self.library.model
        self.specials = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.kind = self._kind()
        self.letter = {"<u4": "I", "<u2": "H"}[dtype]
        self.whole = {piece: array(self.letter, (i,)).tobytes() for piece, i in whole_tokens(self.library, self.spec, self.kind).items()}
        self.merge = merges(self.library, self.spec, self.kind)
        self.pattern, self.ascii = PATTERNS[self.kind]
        self.young: dict = Memory(self)
        self.stop = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.same: dict[str, bool] = {}
        del self.spec  # tens of thousands of small objects that nothing needs from here on

    def _kind(self) -> str:
        """The two layouts whose pieces are known here; other tokenizers go to the library whole."""
        m, pre, norm = self.spec["model"], self.spec.get("pre_tokenizer") or {}, self.spec.get("normalizer")
        plain = m["type"] == "BPE" and not m.get("dropout") and not m.get("byte_fallback") and not m.get("continuing_subword_prefix") and not any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in self.spec["added_tokens"])
        if plain and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            return "byte"
        steps = [x["type"] for x in pre.get("pretokenizers", [])]
        split = (pre.get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex")
        if plain and steps == ["Split", "ByteLevel"] and split == WORD_PATTERN and [x["type"] for x in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            return "word"
        return "other"

    def _agreed(self, text: str) -> bool:
        """Whether the library takes all characters of a text for what they are here. It knows another Unicode version: newer letters, numbers and combining
        marks differ. It is asked once for each character beyond BEYOND."""
        for c in set(BEYOND.findall(text)):
            if c not in self.same:
                if self.kind == "byte":
                    self.same[c] = all(len(self.library.pre_tokenizer.pre_tokenize_str(x + c)) == len(self.pattern.findall(x + c)) for x in "a1!")
                else:  # moved by a mark of the lowest class behind it, or before one of the highest
                    self.same[c] = all(self.library.normalizer.normalize_str(x) == normal(x) for x in (c, f"a{c}\u0334", f"a\u0345{c}"))
            if not self.same[c]:
                return False
        return True

    def word(self, piece: str) -> bytes:
        """A pre-token."""
        return self.whole.get(piece) or array(self.letter, self.merge(piece)).tobytes()

    def chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and BEYOND.search(chunk) and (self.kind == "word" or not self._agreed(chunk)):
            # Not encode(): a text that is in normal form already would be normalized again, and lower case may compose further.
            return array(self.letter, [t.id for p, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk) for t in self.model.tokenize(p)]).tobytes()
        return b"".join([self.whole.get(p) or array(self.letter, self.merge(p)).tobytes() for p in (self.ascii if chunk.isascii() else self.pattern).findall(chunk)])

    def ids(self, text: str) -> bytes:
        if self.kind == "other":
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        if self.stop is None or not self.stop.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.stop.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.specials[m[0]]], self.dtype).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        """A text without special strings. A chunk is remembered by what follows its space."""
        if not text:
            return b""
        if self.kind == "word":
            if not text.isascii() and not self._agreed(text):
                return b"".join(map(self.young.__getitem__, self.library.normalizer.normalize_str(text).split(" ")))
            text = folded(text)
            return b"".join(map(self.young.__getitem__, RUN.sub(" ", text).split(" ") if MORE_SPACE.search(text) else text.split()))
        first, *rest = CUT.split(text) if ODD_SPACE.search(text) else text.split(" ")
        return b"".join([self.chunk(first), *map(self.young.__getitem__, rest)])


class Memory(dict):
    """Chunk to ids, in two generations: what is used again moves to the young one, and the old one is forgotten."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.old = codec, {}
        self.space = " " if codec.kind == "byte" else ""
        self.ends = {c: codec.word(c) for c in ENDS} if codec.kind != "other" else {}

    def __missing__(self, chunk: str):
        found = self.old.get(chunk)
        if found is None:
            # A word, or a word and one mark: two pre-tokens that need no pattern. The word alone is often known.
            end = self.ends.get(chunk[-1:], b"")
            word = chunk[:-1] if end else chunk
            if word.isalpha() and (word.isascii() or not BEYOND.search(word)):
                found = end and (self.get(word) or self.old.get(word)) or self.codec.word(self.space + word)
                found += end
            else:
                found = self.codec.chunk(self.space + chunk)
            if len(chunk) > LONG_CHUNK:
                return found
        if len(self) >= REMEMBERED // 2:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_SPACE = r"\t\n\x0b\x0c\r "
PATTERNS: dict[str, tuple] = {
    "byte": (regex.compile(BYTE_PATTERN), re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^A-Za-z0-9" + ASCII_SPACE + r"]+|[" + ASCII_SPACE + r"]+(?![^" + ASCII_SPACE + r"])|[" + ASCII_SPACE + r"]+")),
    "word": (regex.compile(WORD_PATTERN.replace(r"\s", SPACE)), re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^A-Za-z0-9" + ASCII_SPACE + r"]+")),
    "other": (None, None),
}
#: Above, letters of newer Unicode versions are found.
BEYOND = re.compile("[\u0500-\U0010ffff]")
#: A space before white space or the end: there a plain split would cut a run of white space.
ODD_SPACE = re.compile(rf" (?=[{SPACE}]|\Z)")
CUT = re.compile(rf" (?=[^{SPACE}])")
RUN = re.compile(rf"[{SPACE}]+")
#: White space for `str.split`, but not for the library.
MORE_SPACE = re.compile("[\x1c-\x1f]")


def folded(text: str) -> str:
    """NFC, then lower case letter by letter, as the library does it (no rule of final sigma)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def normal(text: str) -> str:
    """The library's normal form of a text: folded, runs of white space as one space."""
    return RUN.sub(" ", folded(text))


def whole_tokens(library: Tokenizer, spec: dict, kind: str) -> dict[str, int]:
    """The offline proof: pieces of text that the library's own merges leave as exactly one token of the vocabulary."""
    if kind == "other":
        return {}
    suffix, model = spec["model"].get("end_of_word_suffix") or "", library.model
    special, out = {t["content"] for t in spec["added_tokens"]}, {}
    for token, i in spec["model"]["vocab"].items():
        if token in special or suffix and not token.endswith(suffix):
            continue
        letters = token[: len(token) - len(suffix)]
        if letters and all(c in BYTES for c in letters) and [t.id for t in model.tokenize(letters)] == [i]:
            with contextlib.suppress(UnicodeDecodeError):  # part of a character: never a piece
                out[bytes(map(BYTES.__getitem__, letters)).decode()] = i
    return out


def merges(library: Tokenizer, spec: dict, kind: str) -> Callable[[str], list[int]]:
    """Piece to ids. The library builds an object for each token; a rank table of the same merges gives the ids alone and is used if it is proven to
    agree: ids rise along the merges, and every vocabulary string, alone and joined to another, comes out as the library has it."""
    model, suffix = library.model, spec["model"].get("end_of_word_suffix") or ""

    def by_library(piece: str) -> list[int]:
        return [t.id for t in model.tokenize("".join(map(LETTERS.__getitem__, piece.encode())))]

    if kind == "other":
        return by_library
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    end = b"\xff" if suffix else b""  # no byte of UTF-8 text; stands for the end of a word
    try:
        ranks = {bytes(map(BYTES.__getitem__, t.removesuffix(suffix) if suffix else t)) + (end if suffix and t.endswith(suffix) else b""): i for t, i in vocab.items()}
        import tiktoken

        table = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    except (AttributeError, KeyError, ValueError, ImportError):
        return by_library
    order = [vocab.get("".join(m if isinstance(m, list) else m.split(" ", 1))) for m in spec["model"]["merges"]]
    if None in order or any(a >= b for a, b in itertools.pairwise(order)) or len(ranks) != len(vocab):
        return by_library

    def by_ranks(piece: str) -> list[int]:
        return table(piece.encode() + end)

    strings = []
    for t in vocab:
        with contextlib.suppress(UnicodeDecodeError):
            strings.append(bytes(map(BYTES.__getitem__, t.removesuffix(suffix) if suffix else t)).decode())
    n = len(strings)
    probes = strings + [strings[k] + strings[(k * 7919 + 13) % n] for k in range(n)]
    return by_ranks if all(not p or by_ranks(p) == by_library(p) for p in probes) else by_library


_CODECS: dict[tuple, Codec] = {}


def codec(text: str, dtype: str = "<u4") -> Codec:
    """The worker's codec for a tokenizer file's text; kept while the worker lives."""
    key = (hash(text), len(text), dtype)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(text, dtype)
    return _CODECS[key]


def encoder(spec: Broadcast, dtype: str = "<u4") -> Callable[[str], bytes]:
    return codec(spec.value, dtype).ids
