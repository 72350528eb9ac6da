"""Texts gathered into segments of bounded size inside a task, so that what is counted is added up before it is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from tableloom.llm.common import text_batches, text_bytes, word_spans

#: Bytes of text in a segment; a longer text is a segment of its own.
SEGMENT_BYTES = 8 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def gathered(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SEGMENT_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """A task's rows as tables of about ``limit`` bytes of text, each with a number no other task uses."""
    number = TaskContext.get().partitionId() << 32
    held, size = [], 0
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text))
        for start, stop in text_batches(texts, limit):
            part = batch.slice(start, stop - start)
            own = int(text_bytes(part.column(batch.schema.get_field_index(text)))[1][-1])
            if held and size + own > limit:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
            held.append(part)
            size += own
    if held:
        yield number, pa.Table.from_batches(held)


def lowered(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts with A-Z lower-cased, and where each text starts."""
    data, offsets = text_bytes(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
    return LOWER[data], offsets


class Tokens:
    """The words of several texts: maximal runs of the bytes flagged in ``is_word``, numbered by a dictionary of the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.starts, self.ends, self.first = word_spans(data, is_word, offsets)
        sizes = np.zeros(len(self.starts) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=sizes[1:])
        words = pa.StringArray.from_buffers(len(self.starts), pa.py_buffer(sizes), pa.py_buffer(data[is_word[data]]))
        coded = words.dictionary_encode()
        self.words, self.ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)
