"""Token ids of whole text columns by a public vocabulary, each distinct part of a text encoded once.

A text is cut where the vocabulary's own pre-tokenizer always cuts, so the ids
of the parts, joined, are those of the text. A process remembers the ids of parts
by their 64-bit hashes in arrays of bounded size; new parts go to the tokenizers library,
many in one call where nothing can join across them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from netload.llm.wordhash import SLICE_BYTES, byte_codes, range_hashes, slices, text_bytes, words

#: Parts that a process remembers, and ids of theirs, before it starts afresh: 24 and 4 bytes each.
REMEMBERED, REMEMBERED_IDS = 2_000_000, 12_000_000
#: Longer parts (bytes) are encoded each time.
LONGEST = 256
#: Parts that one string for the library is joined from, and such strings in a call.
JOINED, STRINGS = 64, 256

#: Fixed value: the pattern of the byte-level vocabularies' pre-tokenizer.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


_VISIBLE = _bytes_in((0x21, 0x7E))
#: First bytes of characters that can't be white space: visible ASCII, and lead bytes but those of Unicode's blanks.
_BEGINS = _VISIBLE | _bytes_in((0xC3, 0xDF), (0xE4, 0xF4))
_TWO_BYTES = _bytes_in((0xC3, 0xDF))
#: Bytes of words in ASCII and letters of Latin-1, which no normalizer composes.
_PLAIN = _VISIBLE | _bytes_in((0x80, 0xBF), (0xC3, 0xC3))


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranges of ``data``, joined."""
    to = np.cumsum(lengths)
    return data[np.repeat(starts - to + lengths, lengths) + np.arange(to[-1] if len(to) else 0)]


def _within(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many marked bytes each range has."""
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[ends] - total[starts]


class Ids:
    """Ids of texts by one tokenizer file, loaded once per process. Special tokens' literals in a text get their own ids."""

    #: What stands between the parts of one string for the library, where none of them has it itself.
    _BETWEEN = b""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._codes = np.zeros(0, np.uint64)  # sorted
        self._at, self._n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _parts(self, data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the parts of the texts start and end."""
        raise NotImplementedError

    def _alone(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which parts have to be encoded by themselves."""
        raise NotImplementedError

    def _many(self, texts: list[str]) -> list:
        return self._tokenizer.encode_batch(texts, add_special_tokens=False)

    def _joined(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that the library cuts apart in a longer string, by the places it says its tokens have."""
        ids, counts = [], []
        for low in range(0, len(starts), JOINED * STRINGS):
            own = slice(low, low + JOINED * STRINGS)
            lengths = ends[own] - starts[own]
            chars = lengths - _within((data & 0xC0) == 0x80, starts[own], ends[own]) + len(self._BETWEEN)
            raw, at = gathered(data, starts[own], lengths).tobytes(), np.concatenate([[0], np.cumsum(lengths)]).tolist()
            texts = []
            for first in range(0, len(lengths), JOINED):
                last = min(first + JOINED, len(lengths))
                run = raw[at[first] : at[last]] if not self._BETWEEN else self._BETWEEN.join(raw[at[i] : at[i + 1]] for i in range(first, last))
                texts.append(run.decode())
            upto, places = np.cumsum(chars), []
            for k, found in enumerate(self._many(texts)):
                ids.append(np.array(found.ids, np.uint32))
                before = upto[k * JOINED - 1] if k else 0
                places.append(np.array(found.offsets, np.int64).reshape(-1, 2)[:, 1] + before)
            part = np.searchsorted(upto, np.concatenate(places) if places else np.zeros(0, np.int64), "left")
            counts.append(np.bincount(part, minlength=len(lengths)))
        return np.concatenate(ids or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])

    def _by_itself(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())]
        lists = [np.array(found.ids, np.uint32) for found in self._many(texts)] if texts else []
        return np.concatenate(lists or [np.zeros(0, np.uint32)]), np.array([len(x) for x in lists], np.int64)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts in order, and how many each part has."""
        alone = self._alone(data, starts, ends)
        counts, order, flat = np.zeros(len(starts), np.int64), [], []
        for mask, way in ((~alone, self._joined), (alone, self._by_itself)):
            ids, n = way(data, starts[mask], ends[mask])
            counts[mask] = n
            order.append(np.repeat(np.flatnonzero(mask), n))
            flat.append(ids)
        return np.concatenate(flat)[np.argsort(np.concatenate(order), kind="stable")], counts

    def remember(self, codes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Adds parts that are not known yet; ``codes`` are sorted."""
        place = np.searchsorted(self._codes, codes)
        at = len(self._ids) + np.cumsum(counts) - counts
        self._codes, self._at, self._n = (np.insert(a, place, b) for a, b in ((self._codes, codes), (self._at, at), (self._n, counts)))
        self._ids = np.concatenate([self._ids, ids])

    def _looked_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, index, back = np.unique(range_hashes(byte_codes(data), starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[index], ends[index]
        place = np.minimum(np.searchsorted(self._codes, codes), max(len(self._codes) - 1, 0))
        known = self._codes[place] == codes if len(self._codes) else np.zeros(len(codes), bool)
        new = np.flatnonzero(~known)
        ids, counts = self._encode(data, starts[new], ends[new])
        at, n = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
        at[known], n[known] = self._at[place[known]], self._n[place[known]]
        at[new], n[new] = len(self._ids) + np.cumsum(counts) - counts, counts
        found = gathered(np.concatenate([self._ids, ids]), at[back], n[back])
        short = ends[new] - starts[new] <= LONGEST
        self.remember(codes[new[short]], ids[np.repeat(short, counts)], counts[short])
        if len(self._codes) > REMEMBERED or len(self._ids) > REMEMBERED_IDS:
            self._forget()
        return found, n[back]

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and how many each text has."""
        data, where = text_bytes(texts)
        starts, ends = self._parts(data, where)
        runs, low = [], 0
        while low < len(starts):  # parts of up to SLICE_BYTES in all, or one longer part
            high = max(low + 1, int(np.searchsorted(ends, starts[low] + SLICE_BYTES, "right")))
            first, last = int(starts[low]), int(ends[high - 1])
            runs.append(self._looked_up(data[first:last], starts[low:high] - first, ends[low:high] - first))
            low = high
        ids = np.concatenate([r[0] for r in runs] or [np.zeros(0, np.uint32)])
        before = np.concatenate([[0], np.cumsum(np.concatenate([r[1] for r in runs] or [np.zeros(0, np.int64)]))])
        return ids, np.diff(before[np.searchsorted(starts, where, "left")])


def _with_literals(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which parts hold the opening of a special token's literal, `<|`."""
    opening = np.zeros(len(data), bool)
    opening[:-1] = (data[:-1] == 60) & (data[1:] == 124)
    return _within(opening, starts, ends) > 0


class WordIds(Ids):
    """For vocabularies that drop white space and lower the case: parts are the words."""

    _BETWEEN = b" "

    def _parts(self, data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw, offsets = data.tobytes(), pa.py_buffer(where.astype(np.int64).tobytes())
        found = words(pa.LargeStringArray.from_buffers(len(where) - 1, offsets, pa.py_buffer(raw)))
        return found.starts, found.ends

    def _alone(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (_within(_PLAIN[data], starts, ends) < ends - starts) | _with_literals(data, starts, ends)


class ByteIds(Ids):
    """For byte-level vocabularies: a part begins at a blank with a visible character after it.

    The pattern gives that blank to the character's piece and ends the one before, white
    space before it included.
    """

    def _parts(self, data: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = np.zeros(len(data) + 1, bool)
        cut[: max(len(data) - 1, 0)] = (data[:-1] == 32) & _BEGINS[data[1:]]
        cut[where - 1] = False  # a blank that ends its text
        cut[where] = True
        edges = np.flatnonzero(cut)
        return edges[:-1], edges[1:]

    @staticmethod
    def _open(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which parts don't begin with a blank and a visible character and end visibly, so that a neighbour could join them."""
        last = data[ends - 1]
        closed = _VISIBLE[last] | ((last >= 0x80) & (ends - starts > 1) & _TWO_BYTES[data[np.maximum(ends - 2, 0)]])
        led = (data[starts] == 32) & (ends - starts > 1) & _BEGINS[data[np.minimum(starts + 1, len(data) - 1)]]
        return ~(led & closed)

    def _alone(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self._open(data, starts, ends) | _with_literals(data, starts, ends)


@lru_cache(maxsize=4)
def ids_by(kind: type[Ids], path: str) -> Ids:
    return kind(path)


def slices_of(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    return slices(batch, column)
