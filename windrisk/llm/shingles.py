"""Word shingles of whole texts as 64-bit hashes, for Arrow batches inside tasks."""

import numpy as np
import xxhash

SHINGLE = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # the first n of eight bytes
_EIGHTS = 256  # longer words are hashed one by one


class _Words(dict):
    """Hashes of recent words; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Words()


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased. bytes.split() cuts at just the bytes 0x20 and 0x09-0x0D."""
    raw = text.encode() if text else b""
    words = (raw.lower() if lower else raw).split()
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than `size` make one shingle, no words none."""
    return shingle_sets([text.encode() if text else None], size)[0]


def _cut_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and hashes of the words of lower-cased bytes that begin with a gap and end with eight or more."""
    data = np.frombuffer(raw, dtype=np.uint8)
    gap = (data == 32) | (data - np.uint8(9) < 5)
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    begins, ends = edges[::2], edges[1::2]
    eights = np.ndarray((len(data) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    left = ends - begins
    with np.errstate(over="ignore"):
        hashes = mix64((eights[begins] & _FIRST[np.minimum(left, 8)]) ^ (left.astype(np.uint64) * _MULTIPLIER))
        long = np.flatnonzero((left > 8) & (left <= _EIGHTS))
        at, left = begins[long] + 8, left[long] - 8
        while len(long):
            hashes[long] = mix64(hashes[long] * _MULTIPLIER ^ (eights[at] & _FIRST[np.minimum(left, 8)]))
            more = left > 8
            long, at, left = long[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(ends - begins > _EIGHTS):
        hashes[i] = xxhash.xxh3_64_intdigest(raw[begins[i]:ends[i]])
    return begins, hashes


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and how many each has. All texts are cut at once."""
    raw = b" ".join([b"", *(t or b"" for t in texts), b" " * 8]).lower()
    begins, words = _cut_words(raw)
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    last = np.searchsorted(begins, ends + 1)
    n = np.diff(last, prepend=0)
    first = last - n
    with np.errstate(over="ignore"):
        rolled = np.full(len(words), np.uint64(size))
        padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
        for i in range(size):
            rolled = rolled * _MULTIPLIER + padded[i:i + len(words)]
        used = np.arange(len(words)) + size <= np.repeat(last, n)
        for k in range(1, size):  # texts of k words
            at = first[n == k]
            short = np.full(len(at), np.uint64(k))
            for i in range(k):
                short = short * _MULTIPLIER + words[at + i]
            rolled[at], used[at] = short, True
        values = mix64(rolled[used])
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    stops = np.cumsum(counts)
    starts = stops - counts
    for a, b in zip(starts.tolist(), stops.tolist()):
        values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[starts[counts > 0]] = True
    counts[counts > 0] = np.add.reduceat(new, starts[counts > 0], dtype=np.int64) if len(values) else 0
    return values[new], counts
