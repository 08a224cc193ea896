"""Minimal perfect hash with fingerprints, in numpy.

Keys (pairs of unsigned 64-bit numbers, already distinct) are hashed into a
bit array of ``GAMMA`` times their number; keys that are alone at their bit
stay, the others try the next level.  A key's slot is the rank of its bit over
all levels, so the slots are exactly 0 to n - 1.  Each slot keeps a 32-bit
fingerprint, which tells other keys apart (a false match has odds of 1 to 2**32).
"""

from __future__ import annotations

import io

import numpy as np

GAMMA = 2
MAX_LEVELS = 64
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(33))


def key_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of (a, b); distinct pairs with one hash share nothing but a slot try."""
    with np.errstate(over="ignore"):
        return _mix(a.astype(_U) + _mix(b.astype(_U) + _U(0x9E3779B97F4A7C15)))


def _position(a, b, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = _mix(key_hash(a, b) ^ _mix(a.astype(_U) + _U(level * 2 + 1)))
    return (h % _U(size)).astype(np.int64)


def _fingerprint(a, b) -> np.ndarray:
    return (_mix(key_hash(b, a) + _U(0x5851F42D4C957F2D)) >> _U(32)).astype(np.uint32)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray], fingerprints: np.ndarray | None = None):
        self.levels = levels  # bool arrays
        flat = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(flat) - flat
        self.base = np.cumsum([0, *map(len, levels)])
        self.fingerprints = fingerprints

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> "PerfectHash":
        levels, ra, rb = [], a, b
        while len(ra):
            if len(levels) == MAX_LEVELS:
                raise ValueError("keys are not distinct")
            size = GAMMA * len(ra)
            pos = _position(ra, rb, len(levels), size)
            hits = np.bincount(pos, minlength=size)
            levels.append(hits == 1)
            again = hits[pos] > 1
            ra, rb = ra[again], rb[again]
        out = cls(levels)
        marks = np.zeros(len(a), np.uint32)
        marks[out._slots(a, b)] = _fingerprint(a, b)
        out.fingerprints = marks
        return out

    def _slots(self, a, b) -> np.ndarray:
        slot = np.full(len(a), -1, np.int64)
        open_ = np.arange(len(a))
        for k, bits in enumerate(self.levels):
            pos = _position(a[open_], b[open_], k, len(bits))
            hit = bits[pos]
            slot[open_[hit]] = self.rank[self.base[k] + pos[hit]]
            open_ = open_[~hit]
        return slot

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 where the fingerprint does not match."""
        slot = self._slots(a, b)
        if not len(self.fingerprints):
            return np.full(len(a), -1, np.int64)
        ok = (slot >= 0) & (self.fingerprints[np.maximum(slot, 0)] == _fingerprint(a, b))
        return np.where(ok, slot, -1)

    def arrays(self) -> dict[str, np.ndarray]:
        flat = np.concatenate(self.levels) if self.levels else np.zeros(0, bool)
        return {"bits": np.packbits(flat), "sizes": np.array([*map(len, self.levels)], np.int64),
                "fingerprints": self.fingerprints}

    @classmethod
    def from_arrays(cls, z) -> "PerfectHash":
        sizes = z["sizes"]
        flat = np.unpackbits(z["bits"], count=int(sizes.sum())).astype(bool)
        return cls(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [], z["fingerprints"])


def dump(hash_: PerfectHash, **columns: np.ndarray) -> bytes:
    """Bytes of a hash and of columns in slot order."""
    out = io.BytesIO()
    np.savez(out, **hash_.arrays(), **columns)
    return out.getvalue()


def load(data: bytes) -> tuple[PerfectHash, dict[str, np.ndarray]]:
    z = np.load(io.BytesIO(data))
    return PerfectHash.from_arrays(z), {k: z[k] for k in z.files}
