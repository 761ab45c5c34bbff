"""Words of many texts at once: one pass of array operations over the texts of a record batch.

Words are maximal runs of bytes other than space and 0x09-0x0D and never span two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wakeline.llm.textkernel import _SPACE, word_hashes

PIECE_BYTES = 6 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts take about ``most`` bytes; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, done + most, side="right")), at + 1)
        yield batch.slice(at, stop - at)
        at = stop


class BatchWords:
    """Bounds, owners and hashes of the words of a string array; nulls are texts without words.

    ``starts`` and ``ends`` are offsets in ``data``; ``first[d]`` is the number of words before text d, and
    ``first[-1]`` that of all.
    """

    def __init__(self, texts: pa.Array, fold_case: bool):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low = int(offsets[0]) if len(texts) else 0
        self.offsets = (offsets - low).astype(np.int64)
        size = int(self.offsets[-1]) if len(texts) else 0
        buffer = texts.buffers()[2]
        self.data = memoryview(buffer)[low:low + size] if buffer is not None and size else memoryview(b"")
        inside = ~_SPACE[np.frombuffer(self.data, dtype=np.uint8)]
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.offsets] = True
        begins, stops = inside.copy(), np.zeros(size + 1, dtype=bool)
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[1:] = inside
        stops[1:-1] &= ~inside[1:] | edge[1:-1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops)
        self.first = np.searchsorted(self.starts, self.offsets, side="left")
        self.counts = np.diff(self.first)
        self.hashes = (word_hashes(self.data, self.starts, self.ends, fold_case) if len(self.starts)
                       else np.empty(0, dtype=np.uint64))

    def text(self, d: int) -> bytes:
        return bytes(self.data[self.offsets[d]:self.offsets[d + 1]])
