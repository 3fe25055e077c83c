"""Token ids of texts, through a public tokenizer file and without encoding a word twice.

Where the file is of a word tokenizer that lower-cases, drops white space and splits as ``_SPLIT`` says, a text's ids are
those of its words one after another. Runs of letters and of punctuation are encoded once by each worker and remembered
within a bound; a word with any other character goes through the unchanged tokenizer as a whole. With any other file whole texts do.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tokenwin.llm.spans import Seen, distinct, gather
from tokenwin.llm.textbytes import plain_text, split_words, text_bytes

# The most ids of pieces that a worker remembers, some ten bytes each, before it starts anew.
REMEMBERED = 1 << 21
# The splitting that the piecewise way relies on.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_AT_ONCE = 4096
_LOWER = bytes(range(256)).lower()
_SPACE, _LETTER, _MARK, _WORD = 0, 1, 2, 3
_KIND = bytes(
    _SPACE if b in b"\t\n\x0b\x0c\r " else _LETTER if chr(b).isalpha() or b >= 0x80 else _MARK for b in range(256)
)
# Digits, apostrophes, controls and what may start a special token need the tokenizer's own splitting.
_ODD = bytes(1 if b < 0x80 and (chr(b).isdigit() or b in b"'<\x7f" or (b < 0x20 and b not in b"\t\n\x0b\x0c\r")) else 0 for b in range(256))
_WORD_SALT = np.uint64(0x6A09E667F3BCC909)


def drops_white_space(described: dict) -> bool:
    """Whether the described tokenizer lower-cases, drops white space and splits as ``_SPLIT`` says."""
    kinds = [n["type"] for n in (described["normalizer"] or {}).get("normalizers", [])]
    steps = (described["pre_tokenizer"] or {}).get("pretokenizers", [])
    splits = len(steps) == 2 and steps[0].get("pattern") == {"Regex": _SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    return bool(kinds == ["NFC", "Replace", "Lowercase"] and splits and steps[1]["type"] == "ByteLevel" and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"])


class PieceEncoder:
    """Encodes Arrow texts by the tokenizer described in ``text``; ``end_id`` follows the ids of each text."""

    def __init__(self, text: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        described = json.loads(text)
        self.piecewise = drops_white_space(described)
        # Letters in lower case and punctuation pass the normalizer and the splitting unchanged.
        plain = described | {"normalizer": None, "pre_tokenizer": None, "added_tokens": [], "truncation": None, "padding": None}
        self.plain, self.end_id = Tokenizer.from_str(json.dumps(plain)), end_id
        self.plain.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self._forget()

    def _forget(self) -> None:
        self.seen = Seen()
        self.flat, self.begin, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, texts: list[str], odd: np.ndarray) -> None:
        ids: list[list[int]] = [[]] * len(texts)
        for encoder, chosen in ((self.plain, np.flatnonzero(~odd)), (self.whole, np.flatnonzero(odd))):
            # The library's records take a kilobyte a piece, so few of them are held at a time.
            for at in range(0, len(chosen), _AT_ONCE):
                some = chosen[at : at + _AT_ONCE].tolist()
                for i, e in zip(some, encoder.encode_batch_fast([texts[i] for i in some], add_special_tokens=False)):
                    ids[i] = e.ids
        size = np.array([len(x) for x in ids], np.int32)
        begin = len(self.flat) + np.cumsum(size, dtype=np.int64) - size
        self.seen.add(hashes)
        self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.int32)])
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])

    def _whole_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [[*e.ids, self.end_id] for t in plain_text(texts) for e in [self.whole.encode(t.as_py(), add_special_tokens=False)]]
        return np.array([i for x in found for i in x], np.int32), np.cumsum([0] + [len(x) for x in found])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the bounds of each text in them."""
        if not self.piecewise:
            return self._whole_texts(texts)
        whole, bounds = text_bytes(plain_text(texts))
        words = split_words(whole, bounds)
        raw = words.data
        before = np.concatenate([np.zeros(1, np.uint8), raw[:-1]]) if len(raw) else raw
        tail = (raw >= 0x80) & (raw < 0xC0)
        # Two bytes that start with C3 are a Latin letter, but for the signs of multiplication and division.
        latin = tail & (before == 0xC3) & (raw != 0x97) & (raw != 0xB7)
        odd = np.frombuffer(whole.translate(_ODD), np.bool_) | (tail & ~latin) | ((raw >= 0xC0) & (raw != 0xC3))
        lower = np.frombuffer(whole.translate(_LOWER), np.uint8).copy()
        lower[latin & (raw <= 0x9E)] += 0x20
        kind = np.frombuffer(whole.translate(_KIND), np.uint8).copy()
        odd_words = np.unique(np.searchsorted(words.start, np.flatnonzero(odd), "right") - 1)
        if len(odd_words):
            edge = np.zeros(len(raw) + 1, np.int8)
            edge[words.start[odd_words]] += 1
            edge[words.end[odd_words]] -= 1
            inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
            kind[inside] = _WORD
            lower[inside] = raw[inside]
        begins = kind != _SPACE
        changes = np.ones(len(raw), np.bool_)
        changes[1:] = kind[1:] != kind[:-1]
        changes[bounds[bounds < len(raw)]] = True
        start = np.flatnonzero(begins & changes)
        stop = np.append(np.flatnonzero(changes), len(raw))
        end = stop[np.searchsorted(stop, start, "right")]
        salt = np.where(kind[start] == _WORD, _WORD_SALT, np.uint64(0))
        codes, hashes, first = distinct(lower, start, end, salt)
        slots = self.seen.find(hashes)
        if (slots < 0).any():
            if len(self.flat) > REMEMBERED:
                self._forget()
                slots[:] = -1
            new = np.flatnonzero(slots < 0)
            at = first[new]
            text = lower.tobytes()
            strings = [text[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist())]
            self._learn(hashes[new], strings, kind[start[at]] == _WORD)
            slots = self.seen.find(hashes)
        slots = slots[codes]
        size, begin = self.size[slots].astype(np.int64), self.begin[slots]
        sums = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, bounds)]
        # The end follows each text's pieces.
        return np.insert(gather(self.flat, begin, size), sums[1:], self.end_id), sums + np.arange(len(bounds))
