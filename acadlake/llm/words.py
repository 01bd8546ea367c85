"""Word splitting inside Python tasks, in blocks, so that a very long text never becomes one list of words."""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(text: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words (runs without ASCII white space) of ``text``, about ``block`` bytes at a time."""
    if len(text) <= block:
        yield text.split()
        return
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + block)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def split_words(texts: list[bytes]):
    """The lower-cased words of texts one after another (Arrow), and the place of each text's first word (and the end)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # the parts before and after a text's outer white space are empty
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.utf8())))
    ends, words = parts.offsets.to_numpy(), parts.values.view(pa.binary())
    filled = pc.not_equal(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)])[ends]
    return words.filter(filled), ends


def utf8(column) -> list:
    """The values of an Arrow text column as UTF-8 bytes (None for null)."""
    import pyarrow as pa

    big = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if big else pa.binary()).to_pylist()
