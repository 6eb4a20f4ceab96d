"""Words of a batch of texts, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; a longer text makes a slice alone.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` of about ``limit`` bytes of ``column``.

    After each, Arrow gives back what it holds unused: workers live on from stage to stage.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            pa.default_memory_pool().release_unused()
            start, size = i, 0
        size += int(n)
    if start < len(sizes):
        yield batch.slice(start)
        pa.default_memory_pool().release_unused()


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word its text's number, and the words in order.

    Words are runs of anything but space and U+0009 to U+000D; null is empty.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    return owner[full], flat.filter(pa.array(full))


def coded(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Words as numbers into the list of distinct words."""
    d = words.dictionary_encode()
    if isinstance(d, pa.ChunkedArray):
        d = d.combine_chunks()
    return d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_numpy(zero_copy_only=False).tolist()


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of non-empty words one after another, and where each word begins."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    text = bytes(memoryview(data)[bounds[0]:bounds[-1]]).decode() if len(words) else ""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), np.cumsum(lengths) - lengths


def shared_beginnings(texts: list[str], block: int = 1 << 14) -> list[int]:
    """How many characters each of ``texts`` shares at its beginning with the one before it.

    Distinct texts that are short; ``block`` of them at once.
    """
    out = [0] * bool(texts)
    for i in range(0, len(texts) - 1, block):
        part = texts[i:i + block + 1]
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        chars = np.array(part, f"U{max(1, sizes.max())}").view(np.uint32).reshape(len(part), -1)
        first = (chars[1:] != chars[:-1]).argmax(axis=1)
        out += np.minimum(first, np.minimum(sizes[1:], sizes[:-1])).tolist()
    return out


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i] : starts[i] + lengths[i]]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Recent:
    """Values by key, of the keys used last: two generations of at most ``limit`` keys."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        """The value, or None."""
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value
