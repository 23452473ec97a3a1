"""A cuckoo filter: 16-bit fingerprints in buckets of four, with insertion and deletion."""

from __future__ import annotations

import numpy as np

from tablewright.llm.common import mixed

SLOTS, KICKS = 4, 500


class CuckooFilter:
    """Filter over 64-bit keys. Grows, never refuses: `build` doubles the buckets until every key has a slot."""

    def __init__(self, table: np.ndarray) -> None:
        self.table = table

    @classmethod
    def build(cls, keys: np.ndarray) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * 0.85)))))
        while True:
            made = cls(np.zeros((buckets, SLOTS), np.uint16))
            if made._fill(keys):
                return made
            buckets *= 2

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        spread = mixed(np.asarray(keys, np.uint64))
        prints = (spread >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = spread & mask
        return prints, first.astype(np.int64), (first ^ (mixed(prints.astype(np.uint64)) & mask)).astype(np.int64)

    def _fill(self, keys: np.ndarray) -> bool:
        """Place the keys bucket by bucket; those that find both buckets full are moved about one by one."""
        self.table = np.ascontiguousarray(np.sort(self.table, axis=1)[:, ::-1])  # free slots last, also after deletions
        prints, first, second = self._places(keys)
        left = np.arange(len(keys))
        for side in (first, second):
            order = left[np.argsort(side[left], kind="stable")]
            if not len(order):
                break
            bucket = side[order]
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
            free_from = (self.table != 0).sum(1)[bucket]
            fits = free_from + rank < SLOTS
            self.table[bucket[fits], (free_from + rank)[fits]] = prints[order[fits]]
            left = order[~fits]
        return all(self._kick(int(prints[i]), int(first[i])) for i in left)

    def _kick(self, print_: int, bucket: int) -> bool:
        mask = len(self.table) - 1
        for step in range(KICKS):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = print_
                return True
            slot = step % SLOTS
            print_, self.table[bucket, slot] = int(self.table[bucket, slot]), print_
            bucket = bucket ^ (int(mixed(np.array([print_], np.uint64))[0]) & mask)
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """False means certainly absent."""
        prints, first, second = self._places(keys)
        wanted = prints[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys in place; False when the filter is too full and has to be built anew from the exact table."""
        return self._fill(np.asarray(keys, np.uint64))

    def delete(self, keys: np.ndarray) -> None:
        """Take out one copy each of keys that were inserted."""
        for print_, *buckets in zip(*self._places(keys)):
            for bucket in buckets:
                at = np.flatnonzero(self.table[bucket] == print_)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
