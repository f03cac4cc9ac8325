"""Words of texts, in whole Arrow columns."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc

# What is dropped from a text besides combining marks (soft hyphen, zero-width characters).
DROPPED = r"[\p{M}\x{00AD}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]+"
_WORD_BYTES = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def folded(texts: pa.Array) -> pa.Array:
    """Texts decomposed (NFKD), without marks and invisible characters, in lower case, hyphens at line ends closed up."""
    texts = texts.cast(pa.large_string())
    texts = pc.utf8_lower(pc.replace_substring_regex(pc.utf8_normalize(texts, "NFKD"), DROPPED, ""))
    return pc.replace_substring(texts, "-\n", "")


def with_bytes(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with every byte exchanged by a table of 256; NULL becomes the empty text."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return texts
    offsets, data = texts.buffers()[1], texts.buffers()[2]
    changed = pa.py_buffer(data.to_pybytes().translate(table)) if data is not None else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(texts), offsets, changed, offset=texts.offset)


def split_words(texts: pa.Array) -> tuple[pa.Array, "object"]:
    """The words of all texts in one array, and the number of words of each text (numpy); words are runs of a-z and 0-9."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(with_bytes(folded(texts), _WORD_BYTES)))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64")
    flat = pc.list_flatten(lists)
    if len(flat) and pc.any(pc.equal(flat, "")).as_py():  # a text without a word gives one empty word
        first = pc.equal(pc.list_element(pc.if_else(pc.equal(pc.list_value_length(lists), 0), pa.scalar([""], lists.type), lists), 0), "")
        counts = counts - (first.to_numpy(zero_copy_only=False) & (counts > 0)).astype("int64")
        flat = flat.filter(pc.not_equal(flat, ""))
    return flat, counts
