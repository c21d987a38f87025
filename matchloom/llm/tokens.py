"""Encoding whole texts by cached pieces: the text between two single spaces is encoded once while it is remembered."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

Encode = Callable[[list[str]], list[np.ndarray] | list[bytes]]


class PieceCache:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, equal to encoding each text as a whole.

    ``encode`` gives the ids of texts. Its pre-tokens must never run across a single space that stands between two
    characters that are no white space; with ``keep_space`` that space belongs to the piece after it, otherwise it
    gives no ids. A text where a piece is empty or ends in other white space goes to ``encode`` whole. At ``limit``
    pieces the cache forgets all but the short ones, at twice that all, so memory stays bounded whatever the texts are.
    """

    def __init__(self, encode: Encode, keep_space: bool, limit: int = 600_000):
        self.encode, self.space, self.limit = encode, " " if keep_space else "", limit
        self.cache: dict[str, bytes | None] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for first in range(0, len(texts), 256):
            out.extend(self._some(texts[first:first + 256]))
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        cache = self.cache
        if len(cache) > self.limit:
            forget(cache, self.limit)
        split = [text.split(" ") for text in texts]
        heads = [pieces.pop(0) for pieces in split]
        new = set(chain.from_iterable(split)).difference(cache)
        good = [x for x in new if x and not x[0].isspace() and not x[-1].isspace()]
        cache.update(zip(new.difference(good), [None] * len(new)))
        for first in range(0, len(good), 20_000):
            part = good[first:first + 20_000]
            cache.update(zip(part, map(_raw, self.encode([self.space + x for x in part]))))
        begun = map(_raw, self.encode(heads))
        out: list[bytes] = []
        for text, head, pieces, start in zip(texts, heads, split, begun):
            whole = bool(pieces) and (not head or head[-1].isspace())
            if not whole:
                try:
                    out.append(start + b"".join(map(cache.__getitem__, pieces)))
                    continue
                except TypeError:  # one of the pieces is None
                    pass
            out.append(_raw(self.encode([text])[0]))
        return out


def forget(cache: dict, limit: int) -> None:
    """Keep short entries, which are the common ones, if they are less than half of what may be kept."""
    short = {k: v for k, v in cache.items() if len(k) < 6}
    cache.clear()
    if 2 * len(short) < limit:
        cache.update(short)


def _raw(ids: np.ndarray | bytes) -> bytes:
    return ids if isinstance(ids, bytes) else np.asarray(ids, dtype="<u4").tobytes()


# The split pattern and the characters that byte-level vocabularies write bytes with.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[int, str]:
    """Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


#: All characters below have the same class and the same normal form in every version of Unicode.
STABLE = "ɐ"


class LibraryEncoder:
    """``encode`` by the tokenizers library. Strings of added tokens in a text are ordinary text if ``plain``; otherwise
    they become those tokens, as the library does by itself, and a text that holds one goes through it as a whole.

    Other texts whose characters all lie below ``STABLE`` are split here, and the library's model encodes each different
    pre-token, which is remembered. All other texts, and tokenizers of another make, go through the library as a whole.
    """

    def __init__(self, path: str, limit: int = 400_000, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model, self.limit = self.tokenizer.model, limit
        self.known: dict[str, bytes] = {}  # bytes, not lists: Python's collector need not visit them
        self.lower, pattern = _make(json.loads(self.tokenizer.to_str()))
        self.pattern = regex.compile(pattern) if pattern else None
        self.bytes = byte_characters()

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.limit:
            forget(known, self.limit)
        # Letters alone are one pre-token.
        find, lower = self.pattern.findall if self.pattern else None, self.lower
        split = [
            (((x,) if x.isalpha() else find(x)) if find else None) if x.isascii() or max(x) < STABLE else None
            for x in (map(str.lower, texts) if lower else texts)
        ]
        for word in set(chain.from_iterable(filter(None, split))).difference(known):
            if word.isascii() and word.isprintable():
                mapped = word.replace(" ", self.bytes[32])
            else:
                mapped = word.encode().decode("latin-1").translate(self.bytes)
            known[word] = _packed([t.id for t in self.model.tokenize(mapped)])
        get = known.__getitem__
        return [self._whole(x) if words is None else b"".join(map(get, words)) for x, words in zip(texts, split)]

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _make(config: dict) -> tuple[bool, str | None]:
    """Whether texts are lowered first, and the pattern they are split by; no pattern if the make is unknown."""
    before, split = config.get("normalizer"), config.get("pre_tokenizer") or {}
    level = {"type": "ByteLevel", "add_prefix_space": False}
    if before is None and {k: split.get(k) for k in level} == level and split.get("use_regex"):
        return False, BYTE_LEVEL
    steps = [x.get("type") for x in (before or {}).get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    if steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in parts] == ["Split", "ByteLevel"]:
        first, second = parts
        if first["behavior"] == "Removed" and first["invert"] and {k: second.get(k) for k in level} == level and not second["use_regex"]:
            return True, first["pattern"].get("Regex")
    return False, None


class TextEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, equal to the tokenizers library's.

    A byte-level vocabulary whose merges are numbered in their order is the same thing as a rank file, which the tiktoken
    library encodes three times faster; texts below ``STABLE``, where both split alike, take that way. Everything
    else goes through the tokenizers library by cached pieces.
    """

    def __init__(self, path: str, keep_space: bool, plain: bool = False):
        library = LibraryEncoder(path, plain=plain)
        added = [] if plain else [x["content"] for x in json.loads(library.tokenizer.to_str()).get("added_tokens", [])]
        self.library, self.added = library, regex.compile("|".join(map(regex.escape, added)), regex.I) if added else None
        self.pieces = PieceCache(library, keep_space)
        self.ranks = _rank_encoding(json.loads(library.tokenizer.to_str())) if library.pattern else None

    def ids(self, texts: list[str]) -> list[bytes]:
        special = [i for i, x in enumerate(texts) if self.added.search(x)] if self.added else []
        if special:
            texts = list(texts)
            whole = {i: self.library._whole(texts[i]) for i in special}
            for i in special:
                texts[i] = ""
        found = self._plain_ids(texts)
        for i in special:
            found[i] = whole[i]
        return found

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        if self.ranks is None:
            if self.pieces.encode.lower:  # lowered as a whole, texts have fewer different pieces
                texts = [_plain_spaces(x.lower()) if x.isascii() or max(x) < STABLE else x for x in texts]
            return self.pieces.ids(texts)
        return [
            np.asarray(self.ranks.encode_to_numpy(x, disallowed_special=()), "<u4").tobytes() if x.isascii() or max(x) < STABLE
            else self.pieces.ids([x])[0] for x in texts
        ]


# White space to Python but not to every other library.
ODD_SPACE = regex.compile("[\x1c-\x1f\x85\xa0]")


def _plain_spaces(text: str) -> str:
    """The text with single spaces for all white space, where that gives no ids: words beside a line break are then no pieces of their own."""
    return text if ODD_SPACE.search(text) else " ".join(text.split())


@lru_cache(maxsize=4)
def text_encoder(path: str, keep_space: bool, plain: bool = False) -> TextEncoder:
    """One encoder per file and Python worker, so that its pieces are remembered from task to task."""
    return TextEncoder(path, keep_space, plain)


def _rank_encoding(config: dict):
    """A tiktoken encoding of the same vocabulary, if ids number the merges in their order."""
    model = config["model"]
    special = {x["content"] for x in config.get("added_tokens", [])}
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merged = ["".join(x if isinstance(x, list) else x.split(" ")) for x in model["merges"]]
    first = len(vocab) - len(merged)
    if first != 256 or model.get("end_of_word_suffix") or any(vocab.get(x) != first + i for i, x in enumerate(merged)):
        return None
    import tiktoken

    back = {c: b for b, c in byte_characters().items()}
    ranks = {bytes(back[c] for c in token): rank for token, rank in vocab.items()}
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
