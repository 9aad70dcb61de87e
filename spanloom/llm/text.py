"""Byte-level helpers shared by the text operators; all work on whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: ASCII letters and digits, lower-cased; every other ASCII byte separates words; bytes >= 128 are kept.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def encode(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes (a longer text alone) of a string column: the first row,
    the texts' UTF-8 bytes one behind the other, and where in them each text starts, and the end.
    Nulls are empty."""
    if not len(column):
        return
    column = column.fill_null("") if column.null_count else column
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + size, "right")) - 1)
        yield a, data[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
        a = b


def words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return encode(text).translate(WORD_BYTES).split()


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class SpanHasher:
    """64-bit polynomial hashes of arbitrary spans of a byte string, from one pass of prefix sums.

    The hash of bytes[s:e] is sum(T[b_j] * B**-(j-s)) modulo 2**64 for a random odd B and a random
    value T per byte, so it does not depend on where the span stands.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.byte_values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (int(rng.integers(1, 2**62)) * 8 + 5) % 2**64
        self.inverse = pow(self.base, -1, 2**64)
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        def powers(b: int) -> np.ndarray:
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            return np.multiply.accumulate(steps)

        self.up, self.down = powers(self.base), powers(self.inverse)

    def powers(self, n: int) -> np.ndarray:
        """The first n powers of the base's inverse."""
        if n + 1 > len(self.up):
            self._grow(2 * n + 2)
        return self.down[:n]

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self.powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte_values[data] * self.down[:n], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (sums[ends] - sums[starts]) * self.up[starts]
