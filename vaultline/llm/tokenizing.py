"""Exact token ids and counts of long texts through caches of short chunks.

Both tokenizers treat a text chunk by chunk: no token spans a chunk border.
So a chunk is encoded by its library once per worker and its result looked up
afterwards; texts for which the border rule is not plain go to the library
whole. Results equal the library's on the whole text (tests/llm).
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

CACHE_ENTRIES = 400_000  # of a worker; beyond it the cache starts anew (WordIds: beyond half, keeping the last half)
_LOADED: dict = {}


def resolve(path: str) -> str:
    """A tokenizer file: an existing path, else a name of the public set."""
    import os
    if os.path.exists(path):
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


def version(path: str) -> str:
    """Digest of a tokenizer's file."""
    with open(resolve(path), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


# The steps before the merges of a tokenizer whose plain words go to its merges straight away: visible ASCII and the
# letters of Latin-1 are composed already, and lower-casing and cutting them is the same here.
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
            "Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
PARTS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")  # of a lower-cased plain word


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Ids of a word-level BPE (``tokenizers`` JSON) as little-endian uint32
    bytes. Blanks of ASCII always end a word there, and letters are lower-cased."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(resolve(path))
        # In lower case: lower-casing must not make a special string of one that is none to the library.
        self.specials = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.older_parts: dict[str, bytes] = {}
        with open(resolve(path), encoding="utf-8") as f:
            steps = json.load(f)
        self.straight = steps["model"].get("type") == "BPE" and all(steps.get(k) == v for k, v in STEPS.items())
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelt = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}  # ASCII stands for itself
        self.merge = self.tokenizer.model.tokenize

    def whole(self, text: str) -> bytes:
        import numpy as np
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str | bytes) -> bytes:
        raw = text.encode("utf-8") if isinstance(text, str) else text
        lower = raw.lower()
        if any(s in lower for s in self.specials):  # special strings may span blanks
            return self.whole(raw.decode("utf-8"))
        if b"\xcc" not in raw:  # no combining mark that could join a letter differently by its case
            raw = lower
        words = raw.split()
        found = list(map(self.cache.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self._learn(words[i])
        return b"".join(found)

    def _learn(self, word: bytes) -> bytes:
        """Put a new word into the cache. One call a word: a call for several starts the library's threads,
        which cost more than the few new words of a text, and the cores are Spark's already."""
        ids = self.cache.get(word)  # by now, if the text has it twice
        if ids is None:
            if len(self.cache) > CACHE_ENTRIES // 2:  # what was in use lately is taken over, not made again
                self.cache, self.older = {}, self.cache
            ids = self.older.get(word)
            self.cache[word] = ids = self._encode(word.decode("utf-8")) if ids is None else ids
        return ids

    def _encode(self, word: str) -> bytes:
        """A word's ids. Most of the library's time for a word goes into normalizing and cutting it, which a plain
        word is spared; its parts are cached too, as many words differ by a mark only."""
        if not (self.straight and PLAIN.fullmatch(word)):
            return _pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
        found = []
        for p in PARTS.findall(word.lower()):
            ids = self.parts.get(p)
            if ids is None:
                if len(self.parts) > CACHE_ENTRIES // 2:
                    self.parts, self.older_parts = {}, self.parts
                ids = self.older_parts.get(p)
                if ids is None:
                    ids = _pack([t.id for t in self.merge(p if p.isascii() else p.translate(self.spelt))])
                self.parts[p] = ids
            found.append(ids)
        return found[0] if len(found) == 1 else b"".join(found)


class PieceCounts:
    """Token counts of a ``sentencepiece`` model or a ``tokenizers`` JSON. A
    model piece holds its blank mark only in front, so single blanks cut a text."""

    def __init__(self, path: str):
        self.cache: dict[str, int] = {}
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=resolve(path))
            self.encode = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
            self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
            # The model's own preparation must leave texts alone but for the blank mark in front.
            probe = "a  b c ﬁ"
            self.cuttable &= model.decode(model.encode(probe)) == probe
        else:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(resolve(path))
            self.encode = lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]
            self.cuttable = False

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.cuttable or "  " in text or text[0] == " " or text[-1] == " " or "▁" in text:
            return self.encode([text])[0]
        words = text.split(" ")
        cache = self.cache
        new = [w for w in set(words) if w not in cache]
        if new:
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
                new = list(set(words))
            cache.update(zip(new, self.encode(new)))
        return sum([cache[w] for w in words])


def load(kind: type, path: str):
    """The worker's one instance."""
    if (kind, path) not in _LOADED:
        _LOADED[kind, path] = kind(path)
    return _LOADED[kind, path]
