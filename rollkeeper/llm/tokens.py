"""Token ids of whole texts by the public word-level BPE (``word_bpe_49k.json``).

That tokenizer drops white space, splits letters from other signs and lower-cases, and its
tokens never cross such a split. So each distinct unit of a worker is encoded once, by the
tokenizers library, and texts are put together from their units' ids. A unit is a run of
bytes between ASCII white space, cut once more where an ASCII letter meets an ASCII sign
(behind an apostrophe it isn't cut, for contractions). ASCII capitals of units without
other signs are lowered first, which the tokenizer would do anyway. Texts that hold a
special token literally are encoded whole. Units are told apart by a 64-bit hash.

A worker keeps its units from task to task; when there are too many, it starts anew, which
changes no result.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np

from rollkeeper.llm.common import GRAPH, LOWER, ranges, word_hashes

#: Distinct units that a worker remembers.
CACHED_UNITS = 2_000_000
_TOGETHER = 500

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_OPENS = _SIGN.copy()
_OPENS[0x27] = False


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units, and each text's first unit."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside, letter = GRAPH[data], _LETTER[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[1:] |= letter[:-1] & _SIGN[data[1:]]
    edge[1:] |= _OPENS[data[:-1]] & letter[1:]
    edge[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    at = np.flatnonzero(edge)
    after = np.append(at[1:], len(data))
    kept = inside[at]
    starts, ends = at[kept], after[kept]
    return starts, ends, np.searchsorted(starts, offsets)


class WordEncoder:
    """Use ``encoder(path)``, which keeps one for the worker."""

    def __init__(self, path: str, separator: str = "<|startoftext|>", special: tuple[str, ...] = ("<|startoftext|>", "<|endoftext|>")):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._separator = separator
        self._id = self._tokenizer.token_to_id(separator)
        self._special = [s.encode() for s in special]
        self._clear()

    def _clear(self):
        self._hashes = np.empty(0, np.uint64)  # sorted
        self._slots = np.empty(0, np.int64)
        self._ids = np.empty(0, np.uint32)
        self._starts = np.zeros(1, np.int64)  # one more than there are slots

    def _learn(self, words: list[bytes]):
        joined = [
            self._separator.join(map(bytes.decode, words[k : k + _TOGETHER])) for k in range(0, len(words), _TOGETHER)
        ]
        ids = [np.array([*e.ids, self._id], np.uint32) for e in self._tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(ids)
        ends = np.flatnonzero(ids == self._id)
        counts = np.diff(ends, prepend=-1) - 1
        if len(counts) != len(words):
            raise RuntimeError("a unit holds a special token")
        self._ids = np.concatenate([self._ids, ids[ids != self._id]])
        self._starts = np.concatenate([self._starts, self._starts[-1] + np.cumsum(counts)])

    def _spots(self, data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each unit."""
        lowered = LOWER[data]
        foreign = np.flatnonzero(data >= 128)
        if len(foreign):  # units with other than ASCII bytes stay as they are
            own = np.zeros(len(starts), bool)
            own[np.searchsorted(starts, foreign, "right") - 1] = True
            back = ranges(starts[own], (ends - starts)[own])
            lowered[back] = data[back]
        hashes = word_hashes(lowered, starts, ends)
        order = np.argsort(hashes)
        ranked = hashes[order]
        head = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=head[1:])
        known, sample = ranked[head], order[head]
        at = np.searchsorted(self._hashes, known)
        new = np.ones(len(known), bool)
        if len(self._hashes):
            new = self._hashes[np.minimum(at, len(self._hashes) - 1)] != known
        if new.any():
            low, high = starts[sample[new]].tolist(), ends[sample[new]].tolist()
            first = len(self._starts) - 1
            self._learn([raw[a:b] for a, b in zip(low, high, strict=True)])
            self._hashes = np.insert(self._hashes, at[new], known[new])
            self._slots = np.insert(self._slots, at[new], np.arange(first, first + int(new.sum())))
            at = np.searchsorted(self._hashes, known)
        spots = np.empty(len(order), np.int64)
        spots[order] = self._slots[at][np.cumsum(head) - 1]
        return spots

    def block(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of a block's texts one after the other, and how many each has, with ``end`` behind each."""
        if len(self._hashes) > CACHED_UNITS:
            self._clear()
        raw = data.tobytes()
        starts, ends, first = units(data, offsets)
        whole = self._whole(raw, offsets)
        if whole:
            kept = np.ones(len(starts), bool)
            for row in whole:
                kept[first[row] : first[row + 1]] = False
            starts, ends = starts[kept], ends[kept]
            first = np.concatenate([[0], np.cumsum(kept)])[first]
        spots = self._spots(data, raw, starts, ends) if len(starts) else np.empty(0, np.int64)
        sizes = self._starts[spots + 1] - self._starts[spots]
        ids = self._ids[ranges(self._starts[spots], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])[first]
        counts = np.diff(upto)
        if whole:
            parts, last = [], 0
            for row in whole:
                text = raw[offsets[row] : offsets[row + 1]].decode()
                own = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                parts += [ids[last : upto[row]], own]
                last, counts[row] = upto[row], len(own)
            ids = np.concatenate([*parts, ids[last:]])
        if end is not None:
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end))
            counts = counts + 1
        return ids, counts

    def _whole(self, raw: bytes, offsets: np.ndarray) -> list[int]:
        """Texts in which a special token stands."""
        rows = set()
        for mark in self._special:
            at = raw.find(mark)
            while at >= 0:
                rows.add(int(np.searchsorted(offsets, at, "right")) - 1)
                at = raw.find(mark, at + 1)
        return sorted(rows)


@functools.lru_cache(1)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def crc32s(ids: np.ndarray, counts: np.ndarray) -> list[int]:
    """For each run of ids the unsigned crc32 of their little-endian 32-bit form."""
    raw = memoryview(ids.astype("<u4", copy=False).tobytes())
    ends = (np.cumsum(counts) * 4).tolist()
    return [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
