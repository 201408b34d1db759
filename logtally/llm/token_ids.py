"""Ids of whole texts under a public tokenizer file, worked out once per word.

The tokenizer cuts at white space before anything else, so a text's ids are the ids of its words in order, and a word's
are those of its pieces. Words and then pieces are numbered by Arrow's dictionary encoding, so that only different ones are
looked at; pieces are looked up in a table that a task keeps between batches, of bounded size, and only new ones go through
the tokenizer. The ids of all texts are then gathered by number in one go. A text in which one of the tokenizer's special
strings may stand goes through the tokenizer whole.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of pieces that a task keeps, beside what one call brings; beyond it, it starts afresh.
KEPT_BYTES = 16_000_000
#: What an entry takes besides its bytes, about.
_ENTRY = 180
_IDS = np.dtype("<u2")

# The signs of ASCII.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: The model has bytes as characters: those that can be seen in Latin-1 as themselves, the others behind its end, in order.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
_SEEN = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def _low(word: str) -> str:
    """Letters in lower case, where that and nothing else is what the tokenizer makes of them; else nothing."""
    low = word.lower()
    return low if word.isalpha() and low.isalpha() and "Σ" not in word and unicodedata.is_normalized("NFC", word) else ""


def _list(texts: pa.Array) -> list[str]:
    """As Python's own, by way of numpy, which is much the faster one."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """The tokenizer of a file, which must have ids of 16 bits."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES) -> None:
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        if self._whole.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path} has more than {1 << 16} ids")
        #: What every special string has in it, besides letters of either case.
        added = [token.content for token in self._whole.get_added_tokens_decoder().values()]
        self._signs = sorted({max(re.findall(r"[^\w\s]+", content) or [""], key=len) for content in added})
        #: The model alone, for pieces that need neither normalising nor cutting.
        self._pieces = self._whole.model.tokenize
        self._kept_bytes = kept_bytes
        self.clear()

    def clear(self) -> None:
        self._of_piece: dict[str, bytes] = {}
        self._room = self._kept_bytes

    def _cut(self, words: pa.Array) -> tuple[pa.Array, pa.Array, list[int]]:
        """Letters in lower case and signs of each word, and which words have to go through the tokenizer as they are."""
        core = pc.utf8_rtrim(words, characters=_SIGNS)
        plain = pc.and_(pc.string_is_ascii(words), pc.and_not(pc.ascii_is_alpha(core), pc.match_substring(words, "'")))
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        lows, signs, odd = [], [], []
        for i, word, own in zip(others.tolist(), _list(words.take(others)), _list(core.take(others)), strict=True):
            # Letters and then ASCII signs without an apostrophe: two pieces at most, whatever the tokenizer's pattern.
            low = "" if "'" in word else _low(own)
            lows.append(low)
            signs.append(word[len(own) :] if low else "")
            if not low:
                odd.append(i)
        mask = pc.invert(plain)
        given = pc.replace_with_mask(pc.ascii_lower(core), mask, pa.array(lows, pa.string()))
        return given, pc.replace_with_mask(pc.ascii_ltrim(words, characters=_LETTERS), mask, pa.array(signs, pa.string())), odd

    def _ids_of(self, pieces: list[str]) -> list[bytes]:
        table = self._of_piece
        new = [piece for piece in pieces if piece not in table]
        ids: list[int] = []
        edges = [0]
        for piece in new:
            if piece:
                seen = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(_SEEN)
                ids += [token.id for token in self._pieces(seen)]
            edges.append(2 * len(ids))
        found = np.array(ids, _IDS).tobytes()
        table |= {piece: found[i:j] for piece, i, j in zip(new, edges, edges[1:], strict=False)}
        self._room -= sum(map(len, new)) + len(found) + _ENTRY * len(new)
        return [table[piece] for piece in pieces]

    def _whole_ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(found.ids, _IDS).tobytes() for found in self._whole.encode_batch(texts, add_special_tokens=False)]

    def encoded(self, texts: pa.Array, end: int) -> tuple[np.ndarray, pa.Array]:
        """How many ids each text has, and the ids, little-endian with 16 bits each; the last one ends the text."""
        if self._room < 0:
            self.clear()
        special = np.zeros(len(texts), bool)
        for sign in self._signs:
            special |= pc.match_substring(texts, sign).to_numpy(zero_copy_only=False)
        split = pc.ascii_split_whitespace(pc.if_else(pa.array(~special), texts, ""))
        coded = split.values.dictionary_encode()
        words = coded.dictionary
        lows, signs, odd = self._cut(words)
        # Numbers of pieces: those of the letters, those of the signs, then the odd words, the texts that are whole, the end.
        both = pa.concat_arrays([lows, signs]).dictionary_encode()
        number = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first, second = number[: len(words)].copy(), number[len(words) :]
        own = self._ids_of(_list(both.dictionary))
        first[odd] = len(own) + np.arange(len(odd))
        own += self._whole_ids(_list(words.take(pa.array(odd, pa.int64()))))
        begin = np.full(len(texts), len(own), np.int64)
        begin[special] += 1 + np.arange(special.sum())
        own += [b"", *self._whole_ids(_list(texts.filter(pa.array(special)))), np.array([end], _IDS).tobytes()]
        # Text by text: what is whole, the pieces of each word, the end.
        at = np.asarray(split.offsets)[: len(texts) + 1].astype(np.int64)
        at -= at[0]
        used = np.empty(2 * len(coded) + 2 * len(texts), np.int64)
        starts, ends = 2 * at[:-1] + 2 * np.arange(len(texts)), 2 * at[1:] + 2 * np.arange(len(texts)) + 1
        inner = np.ones(len(used), bool)
        inner[starts] = inner[ends] = False
        used[starts], used[ends] = begin, len(own) - 1
        of_word = coded.indices.to_numpy(zero_copy_only=False)
        used[inner] = np.stack([first[of_word], second[of_word]], 1).ravel()
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 2
        ids = np.frombuffer(b"".join(own), _IDS)
        length = sizes[used]
        behind = np.cumsum(length)
        from_ = np.repeat((np.cumsum(sizes) - sizes)[used] - (behind - length), length)
        gathered = ids[from_ + np.arange(len(from_))]
        edges = np.r_[0, behind[ends]]
        offsets = pa.py_buffer((2 * edges).astype(np.int64).tobytes())
        return np.diff(edges), pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(gathered.tobytes())]).cast(pa.binary())

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        """The ids of each text, little-endian with 16 bits each, and the id that ends it."""
        return self.encoded(pa.array(texts, pa.string()), end)[1].to_pylist()


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, loaded once per Python worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
