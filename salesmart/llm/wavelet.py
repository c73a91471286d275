"""A wavelet matrix of token ids as one compressed file image.

The matrix holds one bit plane for each bit of the largest id, the highest first; each
plane is the ids' bit in the order that all planes above leave behind (zeros before ones,
stable).  A plane is cut into blocks of BLOCK_BITS, each compressed by itself where that
is shorter, with a directory of the ones and the bytes before every block.  So one file
answers, reading only the blocks it needs:

* ``access(i)``: the token at a place (rank on each plane, top down);
* ``count(token, a, b)``: occurrences between two places (rank of both ends);
* ``select(token, k)`` and ``occurrences(token, a, b)``: where a token occurs (top down to
  its run, bottom up by select);
* ``tokens()``: everything, plane by plane for all places at once.

Layout: MAGIC, length of the head (4 bytes), head (JSON), directory, blocks, documents.
The head has the number of tokens, of planes, the zeros of each plane, the crc32 of all
that follows and the lengths of the parts.  Documents are an Arrow stream of their ids
and token counts.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa

MAGIC = b"WVTOKEN1"
BLOCK_BITS = 1 << 15
BLOCK_BYTES = BLOCK_BITS // 8
#: blocks a reader keeps inflated (4.5 KB each with their byte ranks)
KEPT_BLOCKS = 2048
ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _squeezed(raw: bytes) -> bytes:
    """Compressed where that is shorter; a block as long as the original is the original."""
    small = zlib.compress(raw, 1)
    return small if len(small) < len(raw) else raw


def image(ids: np.ndarray, docs: pa.RecordBatch) -> bytes:
    """The file of some documents' ids in a row.  ``docs`` has a row for each document
    with its token count in ``n_tokens`` (their sum is the number of ids) and any other
    columns to be kept.  No ids give a file without blocks."""
    n = len(ids)
    planes = max(1, int(ids.max()).bit_length()) if n else 1
    now = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, sizes, ones, blocks = [], [], [], []
    for level in range(planes - 1, -1, -1):
        bit = ((now >> now.dtype.type(level)) & now.dtype.type(1)).astype(bool)
        raw = np.packbits(bit, bitorder="little").tobytes()
        for at in range(0, len(raw), BLOCK_BYTES):
            part = raw[at:at + BLOCK_BYTES]
            blocks.append(_squeezed(part))
            sizes.append(len(blocks[-1]))
            ones.append(int(ONES[np.frombuffer(part, dtype=np.uint8)].sum()))
        low = now[~bit]
        zeros.append(len(low))
        now = np.concatenate([low, now[bit]])
    directory = zlib.compress(np.array([sizes, ones], dtype="<u4").tobytes(), 6)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_batch(docs)
    listed = zlib.compress(sink.getvalue(), 1)
    body = b"".join([directory, *blocks, listed])
    head = json.dumps({"tokens": n, "planes": planes, "zeros": zeros, "directory": len(directory),
                       "blocks": int(sum(sizes)), "docs": len(listed), "crc32": zlib.crc32(body)}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + body


class WaveletMatrix:
    """Queries on one file image; ``data`` is anything that slices to bytes."""

    def __init__(self, data: bytes):
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        (size,) = struct.unpack("<I", bytes(data[8:12]))
        head = json.loads(bytes(data[12:12 + size]))
        self.n, self.planes, self.zeros, self.crc32 = head["tokens"], head["planes"], head["zeros"], head["crc32"]
        self.data, self.body = data, 12 + size
        first = self.body + head["directory"]
        self.docs_at, self.end = first + head["blocks"], first + head["blocks"] + head["docs"]
        if len(data) != self.end:
            raise ValueError(f"token file of {len(data)} bytes, {self.end} expected")
        sizes, ones = np.frombuffer(zlib.decompress(bytes(data[self.body:first])), dtype="<u4").reshape(2, -1)
        self.per_plane = len(sizes) // self.planes
        self.at = first + np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        before = ones.astype(np.int64).reshape(self.planes, -1)
        self.ones = np.concatenate([np.zeros((self.planes, 1), np.int64), np.cumsum(before, axis=1)], axis=1)
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def checked(self) -> WaveletMatrix:
        """Itself, if all bytes are as written."""
        if zlib.crc32(bytes(self.data[self.body:self.end])) != self.crc32:
            raise ValueError("token file with a wrong checksum")
        return self

    def docs(self) -> pa.Table:
        return pa.ipc.open_stream(zlib.decompress(bytes(self.data[self.docs_at:self.end]))).read_all()

    def _raw(self, number: int) -> bytes:
        """The plain bytes of a block."""
        at = number % self.per_plane
        whole = min(BLOCK_BYTES, (self.n + 7) // 8 - at * BLOCK_BYTES)
        raw = bytes(self.data[self.at[number]:self.at[number + 1]])
        return raw if len(raw) == whole else zlib.decompress(raw)

    def _block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a block, and the ones before each of them in the block."""
        found = self.kept.get(number)
        if found is None:
            raw = np.frombuffer(self._raw(number), dtype=np.uint8)
            ranks = np.cumsum(ONES[raw], dtype=np.int64) - ONES[raw]
            if len(self.kept) >= KEPT_BLOCKS:
                self.kept.pop(next(iter(self.kept)))
            found = self.kept[number] = (raw, ranks)
        return found

    def _bit(self, plane: int, i: int) -> int:
        raw, _ = self._block(plane * self.per_plane + i // BLOCK_BITS)
        i %= BLOCK_BITS
        return int(raw[i >> 3]) >> (i & 7) & 1

    def _rank(self, plane: int, i: int) -> int:
        """Ones of a plane before place i."""
        block, inside = divmod(i, BLOCK_BITS)
        total = int(self.ones[plane, block])
        if inside:
            raw, ranks = self._block(plane * self.per_plane + block)
            byte, bits = inside >> 3, inside & 7
            total += int(ranks[byte]) + int(ONES[raw[byte] & ((1 << bits) - 1)]) if bits else (
                int(ranks[byte]) if byte < len(raw) else int(self.ones[plane, block + 1] - self.ones[plane, block]))
        return total

    def _select(self, plane: int, k: int, bit: int) -> int:
        """Place of the k-th (from 0) one or zero of a plane."""
        directory = self.ones[plane]
        before = directory if bit else np.arange(len(directory)) * BLOCK_BITS - directory
        if not bit:
            before[-1] = self.n - directory[-1]
        block = int(np.searchsorted(before, k, side="right")) - 1
        raw, _ = self._block(plane * self.per_plane + block)
        bits = np.unpackbits(raw, bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The token at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in range(self.planes):
            bit, ones = self._bit(plane, i), self._rank(plane, i)
            token = token << 1 | bit
            i = self.zeros[plane] + ones if bit else i - ones
        return token

    def _run(self, token: int, a: int, b: int) -> tuple[int, int]:
        """Places a to b carried down to the token's run below the last plane."""
        for plane in range(self.planes):
            lo, hi = self._rank(plane, a), self._rank(plane, b)
            if token >> (self.planes - 1 - plane) & 1:
                a, b = self.zeros[plane] + lo, self.zeros[plane] + hi
            else:
                a, b = a - lo, b - hi
        return a, b

    def count(self, token: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of a token from place a to before place b (default: all)."""
        if token < 0 or token >> self.planes:
            return 0
        lo, hi = self._run(token, a, self.n if b is None else b)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        lo, hi = self._run(token, 0, self.n) if token >= 0 and not token >> self.planes else (0, 0)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        return self._up(token, lo + k)

    def _up(self, token: int, i: int) -> int:
        for plane in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - plane) & 1
            i = self._select(plane, i - self.zeros[plane] if bit else i, bit)
        return i

    def occurrences(self, token: int, a: int = 0, b: int | None = None) -> list[int]:
        """All places of a token from place a to before place b, ascending."""
        if token < 0 or token >> self.planes:
            return []
        lo, hi = self._run(token, a, self.n if b is None else b)
        return [self._up(token, i) for i in range(lo, hi)]

    def tokens(self) -> np.ndarray:
        """All tokens in order."""
        out = np.zeros(self.n, dtype=np.uint32)
        # from the last plane up: the order below a plane holds its zeros before its ones
        for plane in range(self.planes - 1, -1, -1):
            raw = b"".join(self._raw(plane * self.per_plane + k) for k in range(self.per_plane))
            bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), count=self.n, bitorder="little").view(bool)
            below, out = out, np.empty_like(out)
            out[~bits] = below[:self.zeros[plane]]
            out[bits] = below[self.zeros[plane]:] | np.uint32(1 << (self.planes - 1 - plane))
        return out
