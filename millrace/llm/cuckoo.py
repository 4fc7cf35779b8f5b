"""A cuckoo filter over 64-bit hashes, worked on by whole arrays.

Buckets hold four 16-bit fingerprints.  A fingerprint lies in one of two
buckets, each found from the other and the fingerprint alone.  Arrays of hashes are
placed in rounds: what finds its bucket full pushes one resident out to that
one's other bucket.  What has no place after all rounds goes to a short list
that is searched too, so membership never misses, and everything that was added can
be removed.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
LOAD = 0.84
TURNS = 200


def _ranks(sorted_codes: np.ndarray) -> np.ndarray:
    """0, 1, ... within runs of equal codes."""
    start = np.flatnonzero(np.concatenate([[True], sorted_codes[1:] != sorted_codes[:-1]]))
    return np.arange(len(sorted_codes)) - np.repeat(start, np.diff([*start, len(sorted_codes)]))


class Cuckoo:
    def __init__(self, table: np.ndarray, n: int = 0, extra: np.ndarray | None = None):
        self.table, self.n = table, n
        #: bucket and fingerprint, in one number, of what found no place
        self.extra = np.zeros(0, np.int64) if extra is None else extra

    @classmethod
    def sized(cls, n: int) -> Cuckoo:
        """Empty, with room for ``n`` hashes."""
        buckets = 4
        while buckets * SLOTS * LOAD < n:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @property
    def room(self) -> int:
        return int(len(self.table) * SLOTS * LOAD)

    def _spots(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = hashes.astype(np.int64).view(np.uint64)
        fp = np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.int64)
        return fp, (h & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, fp: np.ndarray) -> np.ndarray:
        return bucket ^ ((fp * 0x5BD1E995 >> 5) & (len(self.table) - 1))

    def add(self, hashes: np.ndarray) -> None:
        fp, bucket = self._spots(hashes)
        self.n += len(fp)
        for turn in range(TURNS):
            if not len(fp):
                return
            order = np.argsort(bucket, kind="stable")
            fp, bucket = fp[order], bucket[order]
            rank = _ranks(bucket)
            taken = self.table[bucket] != 0
            free = SLOTS - taken.sum(1)
            fits = rank < free
            slot = np.argsort(taken[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
            self.table[bucket[fits], slot] = fp[fits]
            push = ~fits & (rank == free) if turn > 1 else np.zeros(len(fp), bool)
            left = ~fits & ~push
            fp_out, at = fp[left], bucket[left]
            if push.any():
                slot = (bucket[push] + turn) % SLOTS
                resident = self.table[bucket[push], slot].astype(np.int64)
                self.table[bucket[push], slot] = fp[push]
                fp_out, at = np.concatenate([fp_out, resident]), np.concatenate([at, bucket[push]])
            fp, bucket = fp_out, self._other(at, fp_out)
        self.extra = np.concatenate([self.extra, bucket << 16 | fp])

    def remove(self, hashes: np.ndarray) -> None:
        """Take out hashes that were added; others raise."""
        fp, bucket = self._spots(hashes)
        self.n -= len(fp)
        for _ in range(2):
            order = np.lexsort((fp, bucket))
            fp, bucket = fp[order], bucket[order]
            same = self.table[bucket] == fp[:, None]
            upto = np.cumsum(same, axis=1)
            hit = same & (upto == _ranks(bucket << 16 | fp)[:, None] + 1) if len(fp) else same
            found = hit.any(1)
            self.table[bucket[found], hit[found].argmax(1)] = 0
            fp, bucket = fp[~found], bucket[~found]
            bucket = self._other(bucket, fp)
        for f, b in zip(fp.tolist(), bucket.tolist()):
            codes = [b << 16 | f, int(self._other(np.array([b]), np.array([f]))[0]) << 16 | f]
            at = np.flatnonzero(np.isin(self.extra, codes))
            if not len(at):
                raise KeyError("a hash to remove is not in the filter")
            self.extra = np.delete(self.extra, at[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """May be true for others, one in about 8,000; always true for what is in."""
        fp, bucket = self._spots(hashes)
        other = self._other(bucket, fp)
        want = fp[:, None].astype(np.uint16)
        found = (self.table[bucket] == want).any(1) | (self.table[other] == want).any(1)
        if len(self.extra):
            found |= np.isin(bucket << 16 | fp, self.extra) | np.isin(other << 16 | fp, self.extra)
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.table), self.n, len(self.extra)], np.int64)
        return head.tobytes() + self.extra.tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        buckets, n, more = np.frombuffer(data, np.int64, 3).tolist()
        extra = np.frombuffer(data, np.int64, more, 24).copy()
        return cls(np.frombuffer(data, np.uint16, buckets * SLOTS, 24 + 8 * more).reshape(-1, SLOTS).copy(), n, extra)
