"""Evaluation texts in training texts: suffix arrays over shards of the corpus, searched for every suffix of every test item.

A shard is a run of whole documents within one partition. The suffixes that begin with four known words (words of some test
item; no other suffix can match four words of one) are sorted by their first four words, which pack into one exact 64-bit
key: four word numbers of 16 bits, or two numbers of word pairs where the items have more words than that. Every test suffix is found by binary search. Where test suffixes enter, the range is sorted on
to 16 words, and the search narrows to the suffixes that share 13 words, from which the match is followed, forward and
backward, to its full length. All of it happens where the document is read: a document never leaves its partition, and only
what leaked is written. The test items are broadcast, so many bytes of text at a time as is stated, and searched in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm.words import split_words

GRAM, LONG = 4, 13
VOCABULARY = (1 << 16) - 1


class TestSuffixes:
    """The suffixes of a block of items: word numbers, four-word keys, and which item each belongs to."""

    __test__ = False

    def __init__(self, ids: list[int], texts: list[str | None]):
        flat, counts = split_words(pa.array(texts, pa.string()))
        coded = flat.dictionary_encode()
        self.vocabulary = coded.dictionary.cast(pa.large_string())
        self.words = np.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.uint64) + 1, np.zeros(16, np.uint64)) if len(flat) else np.zeros(16, np.uint64)
        self.item = np.append(np.repeat(np.arange(len(ids)), counts), np.full(16, -1))
        self.ids = np.array(ids, np.int64)
        self.pairs = None if len(self.vocabulary) <= VOCABULARY else np.unique(word_pairs(self.words))
        self.keys = four_word_keys(self.words, self.item, self.pairs)
        starts = np.flatnonzero(self.keys)
        self.grams, which = np.unique(self.keys[starts], return_inverse=True)
        pairs = np.unique(np.stack([which, self.item[starts]]), axis=1) if len(starts) else np.zeros((2, 0), np.int64)
        self.gram_items = pairs[1]
        self.gram_at = np.searchsorted(pairs[0], np.arange(len(self.grams) + 1))
        self.distinct = np.bincount(pairs[1], minlength=len(ids))


def word_pairs(words: np.ndarray) -> np.ndarray:
    """For each place but the last the two words from there in one number."""
    return (words[:-1] << np.uint64(32)) | words[1:]


def four_word_keys(words: np.ndarray, text: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
    """For each place the four words from there in one number; 0 where the text ends sooner or a word isn't known.

    ``pairs``: the word pairs of the tests, sorted, if their words are too many for 16 bits; then two pairs make the number.
    """
    n = len(words)
    keys = np.zeros(n, np.uint64)
    if n < GRAM:
        return keys
    m = n - GRAM + 1
    whole = (text[:m] == text[GRAM - 1 :]) & np.logical_and.reduce([words[i : m + i] > 0 for i in range(GRAM)])
    if pairs is None:
        parts = [words[i : m + i] << np.uint64(16 * (GRAM - 1 - i)) for i in range(GRAM)]
        keys[:m] = np.where(whole, parts[0] | parts[1] | parts[2] | parts[3], 0)
        return keys
    two = word_pairs(words)
    at = np.minimum(np.searchsorted(pairs, two), len(pairs) - 1)
    number = np.where(pairs[at] == two, at + 1, 0).astype(np.uint64)
    first, second = number[:m], number[2 : m + 2]
    keys[:m] = np.where(whole & (first > 0) & (second > 0), (first << np.uint64(32)) | second, 0)
    return keys


def _bound(compare, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each query the first place in [lo, hi) whose suffix isn't before it; ``compare(places, queries)`` says 'is before'."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        before = compare(mid, open_)
        lo[open_[before]] = mid[before] + 1
        hi[open_[~before]] = mid[~before]


def search_shard(words: np.ndarray, text: np.ndarray, tests: TestSuffixes, short: bool = False) -> tuple[np.ndarray, ...]:
    """(text, item, longest, text_at, item_at, shared) of one shard; words: numbers in the tests' vocabulary, 0 for others.

    One row for each text and item that share at least ``LONG`` successive words or half of the item's distinct four-word
    runs. Places count words of the shard or of the block of items. With ``short``, pairs without ``LONG`` successive words get
    their longest match too.
    """
    empty = tuple(np.zeros(0, np.int64) for _ in range(6))
    words, text = np.append(words, np.zeros(16, np.uint64)), np.append(text, np.full(16, -1))
    keys = four_word_keys(words, text, tests.pairs)
    suffixes = np.flatnonzero(keys)
    if not len(suffixes) or not len(tests.grams):
        return empty
    first = keys[suffixes]
    order = np.argsort(first)
    suffixes, first = suffixes[order], first[order]
    lo, hi = np.searchsorted(first, tests.grams, "left"), np.searchsorted(first, tests.grams, "right")
    size = hi - lo
    entered = np.repeat(lo - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
    if not len(entered):
        return empty
    gram = np.repeat(np.arange(len(tests.grams)), size)
    places = suffixes[entered]

    # Distinct four-word runs of each item in each text.
    span = int(text.max()) + 1
    seen = np.unique(gram * span + text[places])
    seen_gram, seen_text = seen // span, seen % span
    many = tests.gram_at[seen_gram + 1] - tests.gram_at[seen_gram]
    at = np.repeat(tests.gram_at[seen_gram] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
    n_items = len(tests.ids)
    pair, shared = np.unique(np.repeat(seen_text, many) * n_items + tests.gram_items[at], return_counts=True)

    # The entered ranges sorted on to 16 words; then every test suffix of 13 words is searched.
    tail = [keys[places + 4], keys[places + 8], words[places + 12]]
    tail[1] = np.where(text[places + 11] == text[places], tail[1], 0)
    tail[0] = np.where(text[places + 7] == text[places], tail[0], 0)
    tail[2] = np.where(text[places + 12] == text[places], tail[2], 0)
    order = np.lexsort((tail[2], tail[1], tail[0], gram))
    places, gram, tail = places[order], gram[order], [t[order] for t in tail]
    queries = np.flatnonzero(tests.keys)
    queries = queries[queries + LONG <= len(tests.item)]
    queries = queries[(tests.item[queries + LONG - 1] == tests.item[queries])]
    wanted = [np.searchsorted(tests.grams, tests.keys[queries]), tests.keys[queries + 4], tests.keys[queries + 8], tests.words[queries + 12]]
    columns = [gram, *tail]
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(places))
    for have, want in zip(columns, wanted, strict=True):
        lo, hi = _bound(lambda p, q, h=have, w=want: h[p] < w[q], lo, hi), _bound(lambda p, q, h=have, w=want: h[p] <= w[q], lo, hi)
    size = hi - lo
    i = places[np.repeat(lo - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())] if size.sum() else np.zeros(0, np.int64)
    j = np.repeat(queries, size)
    hit, *found = _longest_matches(words, text, tests, i, j, LONG)
    i, j, length = found

    half = 2 * shared >= tests.distinct[pair % n_items]
    rows = np.union1d(pair[half], hit)
    if short and len(need := np.setdiff1d(pair[half], hit)):
        # Every entered four-word suffix of these pairs.
        near = np.isin(text[places], need // n_items)
        places, gram = places[near], gram[near]
        queries = np.flatnonzero(tests.keys)
        of = np.searchsorted(tests.grams, tests.keys[queries])
        queries = queries[np.argsort(of, kind="stable")]
        begin = np.searchsorted(np.sort(of), np.arange(len(tests.grams) + 1))
        many = begin[gram + 1] - begin[gram]
        j = queries[np.repeat(begin[gram] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())]
        i = np.repeat(places, many)
        wanted = np.isin(text[i] * n_items + tests.item[j], need)
        more = _longest_matches(words, text, tests, i[wanted], j[wanted], GRAM)
        hit, i, j, length = (np.append(x, y) for x, y in zip((hit, *found), more, strict=True))
    out = [rows // n_items, rows % n_items, *(np.full(len(rows), -1) for _ in range(3)), np.zeros(len(rows), np.int64)]
    out[2][:] = 0
    where = np.searchsorted(rows, hit)
    out[2][where], out[3][where], out[4][where] = length, i, j
    where = np.minimum(np.searchsorted(pair, rows), len(pair) - 1)
    out[5][:] = np.where(pair[where] == rows, shared[where], 0)
    return tuple(out)


def _longest_matches(words: np.ndarray, text: np.ndarray, tests: TestSuffixes, i: np.ndarray, j: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(pair, i, j, length) of the longest match of each pair, the first of equals; i and j share ``least`` words."""
    # Only where a match begins: the words before differ, or one text begins.
    begins = (i == 0) | (j == 0)
    begins |= (text[i - 1] != text[i]) | (tests.item[j - 1] != tests.item[j]) | (words[i - 1] != tests.words[j - 1])
    i, j = i[begins], j[begins]
    length = np.full(len(i), least)
    going = np.arange(len(i))
    while len(going):
        a, b = i[going] + length[going], j[going] + length[going]
        same = (text[a] == text[i[going]]) & (tests.item[b] == tests.item[j[going]]) & (words[a] == tests.words[b])
        going = going[same]
        length[going] += 1
    hit = text[i] * len(tests.ids) + tests.item[j]
    order = np.lexsort((j, i, -length, hit))
    hit, i, j, length = hit[order], i[order], j[order], length[order]
    best = np.append(True, hit[1:] != hit[:-1]) if len(hit) else np.zeros(0, bool)
    return hit[best], i[best], j[best], length[best]


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text", block: int = 2000, shard_bytes: int = 8 << 20, most_bytes: int = 64 << 20, short: bool = False) -> DataFrame:
    """Rows (doc_id, item_id, longest, doc_word, item_word, shared_runs, item_runs) of the items that leaked into documents.

    A document leaks an item when 13 successive words of it stand in succession in the document, or at least half of its distinct
    runs of four successive words occur there. ``longest`` is the length in words of the longest verbatim match (0 if none has
    13), ``doc_word`` and ``item_word`` where it begins, counted in words from 0 (NULL if none), the first such place. Items
    of fewer than four words can't leak; an item of many copies leaks under each id. NULL or blank texts and rows with a NULL
    id give nothing; rows of one id are texts of one document each by itself, and an item is reported once for it.

    With ``short``, matches under 13 words count for ``longest`` and its places too.

    Items are broadcast ``most_bytes`` of text at a time, and each such part is one pass over the documents; within a pass they
    are searched in blocks of ``block``. Shards hold whole documents, about ``shard_bytes`` of text. Texts are read whole.
    """
    good = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text")).filter("id is not null and text is not null")
    parts = max(1, -(-(good.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0) // most_bytes))
    found = None
    for part in range(parts):
        rows = sorted({(r[0], r[1]) for r in good.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).collect()})
        one = _pass(documents, rows, doc_id, text, item_id, block, shard_bytes, short)
        found = one if found is None else found.unionByName(one)
    best = F.max(F.struct("longest", -F.coalesce("doc_word", F.lit(0)), "doc_word", "item_word", "shared_runs", "item_runs")).alias("b")
    return found.groupBy(doc_id, item_id).agg(best).select(doc_id, item_id, "b.longest", "b.doc_word", "b.item_word", "b.shared_runs", "b.item_runs")


def _pass(documents: DataFrame, rows: list[tuple[int, str]], doc_id: str, text: str, item_id: str, block: int, shard_bytes: int, short: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.LongType()) for c in (doc_id, item_id, "longest", "doc_word", "item_word", "shared_runs", "item_runs")])
    arrow = pa.schema([(f.name, pa.int64()) for f in schema])

    sent = documents.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for batch in batches:
            blocks = blocks or [TestSuffixes(*map(list, zip(*sent.value[a : a + block], strict=True))) for a in range(0, len(sent.value), block)]
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = np.unique(np.append(np.searchsorted(sizes, np.arange(0, (int(sizes[-1]) if len(sizes) else 0) + 1, shard_bytes), "left"), batch.num_rows))
            for a, b in pairwise(np.unique(np.append(0, cuts)).tolist()):
                flat, counts = split_words(batch.column(1).slice(a, b - a))
                coded = flat.dictionary_encode()
                dictionary = coded.dictionary.cast(pa.large_string())
                indices = coded.indices.to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(b - a), counts)
                begin = np.append(0, np.cumsum(counts))
                ids = batch.column(0).slice(a, b - a).to_numpy(zero_copy_only=False)
                for tests in blocks:
                    numbers = pc.fill_null(pc.add(pc.index_in(dictionary, value_set=tests.vocabulary), 1), 0).to_numpy(zero_copy_only=False).astype(np.uint64)
                    t, item, longest, i, j, shared = search_shard(numbers[indices] if len(indices) else np.zeros(0, np.uint64), owner, tests, short)
                    if not len(t):
                        continue
                    none = pa.array(i < 0)
                    item_begin = np.searchsorted(tests.item[:-16], item)
                    places = [pc.if_else(none, pa.scalar(None, pa.int64()), pa.array(x)) for x in (i - begin[t], j - item_begin)]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[t].astype(np.int64)), pa.array(tests.ids[item]), pa.array(longest), *places, pa.array(shared), pa.array(tests.distinct[item])], schema=arrow)

    return documents.select(F.col(doc_id).cast("bigint"), F.col(text)).filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).mapInArrow(run, schema)
