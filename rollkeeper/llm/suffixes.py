"""Suffix arrays of blocks of texts, by prefix doubling over whole arrays."""

from __future__ import annotations

import numpy as np


def suffix_array(rank: np.ndarray, stop: np.ndarray, depth: int, settle: bool = False) -> np.ndarray:
    """Places in the order of their suffixes, compared over ``depth`` words at least.

    ``rank``: the word's rank from 1, 0 at the stop behind each text; ``stop``: for each
    place the stop of its text. Doubles the compared length, among suffixes still equal.
    ``settle``: those equal to the end are ordered by place, as if each stop were a sign of
    its own, greater than the stops before it.
    """
    n = len(rank)
    place = np.arange(n, dtype=np.int64)
    bits = max(1, int(rank.max(initial=0)).bit_length())
    per_key = max(1, 63 // bits)
    key = np.zeros(n, np.int64)
    for k in range(per_key):
        key = (key << bits) | rank[np.minimum(place + k, stop)]
    order = np.argsort(key)
    done = per_key
    sorted_key = key[order]
    head = np.empty(n, bool)
    head[:1] = True
    np.not_equal(sorted_key[1:], sorted_key[:-1], out=head[1:])
    group = np.empty(n, np.int64)
    group[order] = np.maximum.accumulate(np.where(head, place, 0))
    while done < depth:
        last = np.append(head[1:], True)
        tied = np.flatnonzero(~(head & last))
        if not len(tied):
            break
        at = order[tied]
        ahead = at + done
        nxt = np.where(ahead < stop[at], group[np.minimum(ahead, n - 1)] + 1, 0)
        mine = group[at]
        by = np.argsort((mine << 31) | nxt)
        at, nxt, mine = at[by], nxt[by], mine[by]
        order[tied] = at
        new = np.ones(len(at), bool)
        new[1:] = (mine[1:] != mine[:-1]) | (nxt[1:] != nxt[:-1])
        head[tied] = new
        group[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        done *= 2
    if settle:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        at = order[tied]
        order[tied] = at[np.argsort((group[at] << 31) | at)]
    return order
