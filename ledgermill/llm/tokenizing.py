"""Token ids as the tokenizers library gives them, with ids remembered per piece of text.

Most words of a corpus return often. Where a tokenizer's own rules never look past a blank, the
ids of a text are the ids of its pieces in a row, so a piece is encoded once per Python worker:

* ``words``: white space is dropped and no token reaches over it; pieces are the words. Texts of plain letters,
  digits and signs are cut into the tokenizer's own pre-tokens at once, by its pattern.
* ``blanks``: a blank between two characters other than white space begins a new token; pieces
  begin at such blanks.
* ``texts``: nothing is known; whole texts go to the library.

The kind is read from the tokenizer's file. Texts that hold a special token's string go to the
library whole, unless pieces are words, which special tokens never reach over either.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

# Pieces a worker remembers; at this number it starts anew, which costs time and no result.
REMEMBERED = 800_000
# Words of these letters and marks are cut into the tokenizers' pre-tokens here, which is much faster
# than asking the library for each: no rule of either kind treats them in another way.
_LETTERS, _MARKS = "[a-zA-ZÀ-ÖØ-öø-ÿ]+", "[.,;:!?]"
_PLAIN = re.compile(f"{_LETTERS}{_MARKS}*(?:\n{_LETTERS}{_MARKS}*)*")
_PLAIN_PARTS = re.compile(f"{_LETTERS}|{_MARKS}+|\n")
# Texts of these characters only, in lower case, are cut alike by any library's reading of a tokenizer's pattern.
_SAFE = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_SAFE_CLASSES = {r"\p{L}": "a-zß-öø-ÿ", r"\p{N}": "0-9"}
_WHITE = frozenset(chr(c) for c in range(0x3001) if chr(c).isspace())
_CUT = re.compile(r"(?<=\S) (?=\S)")

_loaded: dict[str, TextEncoder] = {}


def tokenizer_version(path: str) -> tuple[str, str]:
    """The file's content and its SHA-256, which stands for the tokenizer's version."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    return content, hashlib.sha256(content.encode()).hexdigest()


def shared_tokenizer(spark: SparkSession, path: str) -> tuple[Broadcast, str]:
    """The tokenizer's file for all executors (a few MB, whatever the data), and its version."""
    content, version = tokenizer_version(path)
    return spark.sparkContext.broadcast(content), version


def encoder(content: str, version: str, remembered: int = REMEMBERED) -> TextEncoder:
    """The encoder of this worker; loaded once. It remembers at most ``remembered`` pieces from now on."""
    if version not in _loaded:
        _loaded.clear()
        _loaded[version] = TextEncoder(content)
    _loaded[version].remember(remembered)
    return _loaded[version]


def _kind(rules: dict) -> str:
    before = rules.get("pre_tokenizer") or {}
    if rules.get("normalizer") is None and before.get("type") == "ByteLevel":
        if before.get("use_regex") and not before.get("add_prefix_space"):
            return "blanks"
    steps = (rules.get("normalizer") or {}).get("normalizers") or []
    drops = any(s.get("type") == "Replace" and s["pattern"].get("Regex") == r"\s+" for s in steps)
    first, *rest = before.get("pretokenizers") or [{}]
    if drops and first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed":
        if r"[^\s" in first["pattern"].get("Regex", "") and " " not in first["pattern"]["Regex"]:
            if all(s.get("type") == "ByteLevel" and not s.get("use_regex") for s in rest):
                return "words"
    return "texts"


def _safe_pattern(rules: dict) -> re.Pattern | None:
    """The pattern that cuts words into pre-tokens, for texts of ``_SAFE`` characters in lower case."""
    written = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    for name, letters in _SAFE_CLASSES.items():
        written = written.replace(name, letters)
    return None if "\\p" in written or "(" in written else re.compile(written)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself where it is printable."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class _Parts(dict):
    """Ids of pre-tokens as bytes, found out when first asked for."""

    def __init__(self, tokenizer: Tokenizer, dtype: np.dtype) -> None:
        super().__init__()
        self._tokenizer, self._dtype, self.remembered = tokenizer, dtype, REMEMBERED

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        written = part.encode().decode("latin-1").translate(_BYTE_LETTERS)
        self[part] = found = np.array([t.id for t in self._tokenizer.model.tokenize(written)], self._dtype).tobytes()
        return found


class TextEncoder:
    """Ids of texts without added special tokens, truncation or padding."""

    def __init__(self, content: str) -> None:
        rules = json.loads(content)
        self._tokenizer = Tokenizer.from_str(content)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self.kind = _kind(rules)
        added = rules.get("added_tokens") or []
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in added):
            self.kind = "texts"
        self._special = [t["content"] for t in added]
        self._cut = _safe_pattern(rules) if self.kind == "words" else None
        self.vocabulary_size = self._tokenizer.get_vocab_size()
        self._dtype = np.dtype("<u2" if self.vocabulary_size <= 1 << 16 else "<u4")
        self.remembered = REMEMBERED
        self._known: dict = {}
        self._known_parts = _Parts(self._tokenizer, self._dtype)

    def remember(self, n: int) -> None:
        """Keep the ids of at most so many pieces, and of so many pre-tokens, from now on."""
        self.remembered = self._known_parts.remembered = n

    def forget(self) -> None:
        """Free what was learnt, at the end of a task whose worker goes on with other work."""
        self._known = {}
        self._known_parts.clear()

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, text: str) -> list | None:
        """Pieces of a text, or None where it has to stay whole."""
        if self.kind == "words":
            return text.encode().split()
        if self.kind == "texts" or any(s in text for s in self._special):
            return None
        white = _WHITE.intersection(text)
        if text[:1] == " " or text[-1:] == " " or any(f"{w} " in text or f" {w}" in text for w in white):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
        # A text's first piece has no blank before it and so is another piece; marked by its type.
        return [(first,), *rest]

    def _known_cut(self, text: str) -> list[bytes] | None:
        """Ids of the pre-tokens of a text that is safe to cut by the tokenizer's pattern, as bytes; None for others."""
        if self._cut is None or not _SAFE.fullmatch(text) or any(s in text for s in self._special):
            return None
        return list(map(self._known_parts.__getitem__, self._cut.findall(text.lower())))

    def _learn(self, pieces: set) -> None:
        if len(self._known) + len(pieces) > self.remembered:
            self._known = {}
        others, written = [], []
        for piece in pieces:
            if piece in self._known:
                continue
            if isinstance(piece, tuple):
                plain, blank = piece[0], ""
            elif isinstance(piece, bytes):
                plain, blank = piece.decode(), ""
            else:
                plain, blank = piece, " "
            if _PLAIN.fullmatch(plain):
                if self.kind == "words":
                    parts = _PLAIN_PARTS.findall(plain.lower())
                else:
                    parts = _PLAIN_PARTS.findall(plain)
                    parts[0] = blank + parts[0]
                self._known[piece] = b"".join(map(self._known_parts.__getitem__, parts))
            else:
                others.append(piece)
                written.append(blank + plain)
        for at in range(0, len(others), 2048):
            for piece, ids in zip(others[at : at + 2048], self._library(written[at : at + 2048]), strict=True):
                self._known[piece] = np.array(ids, self._dtype).tobytes()

    def _known_pieces(self, texts: list[str]) -> Iterable[list[bytes] | None]:
        """Per text the ids of its pieces, as bytes; None for texts that have to stay whole."""
        for text in texts:
            cut = self._known_cut(text)
            if cut is not None:
                yield cut
                continue
            pieces = self._pieces(text)
            if pieces is None:
                yield None
                continue
            try:
                yield [self._known[p] for p in pieces]
            except KeyError:
                self._learn(set(pieces))
                try:
                    yield [self._known[p] for p in pieces]
                except KeyError:  # forgotten while this text was learnt
                    self._learn(set(pieces))
                    yield [self._known[p] for p in pieces]

    def ids(self, texts: list[str]) -> Iterable[np.ndarray]:
        """Per text its ids as unsigned 32-bit integers."""
        for text, parts in zip(texts, self._known_pieces(texts), strict=True):
            if parts is None:
                yield np.array(self._library([text])[0], "<u4")
            else:
                yield np.frombuffer(b"".join(parts), self._dtype).astype("<u4")

    def counts(self, texts: list[str]) -> Iterable[int]:
        """Per text the number of its ids."""
        width = self._dtype.itemsize
        for text, parts in zip(texts, self._known_pieces(texts), strict=True):
            yield len(self._library([text])[0]) if parts is None else sum(map(len, parts)) // width
