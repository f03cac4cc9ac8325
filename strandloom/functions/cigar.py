"""CIGAR strings as arrays of operations, and what they say about reference and read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which operations advance along the reference, the read as stored, and the whole read. X and N don't advance along the
# reference here, as in the callers whose numbers these must match; pass other sets to change that.
REFERENCE, READ, WHOLE_READ = "MD=", "MIS=", "MIS=H"


def operations(cigar: Column) -> Column:
    """array<struct<len, op>>; empty for ``*``, NULL for NULL."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)), lambda x: F.struct(F.regexp_extract(x, r"\d+", 0).cast("bigint").alias("len"), F.right(x, F.lit(1)).alias("op")))


def length_over(ops: Column, kinds: str) -> Column:
    """Bases that the operations in ``kinds`` cover."""
    return F.aggregate(F.filter(ops, lambda x: F.lit(kinds).contains(x["op"])), F.lit(0).cast("bigint"), lambda n, x: n + x["len"])


def reference_length(cigar: Column, kinds: str = REFERENCE) -> Column:
    return length_over(operations(cigar), kinds)


def fold(cigar: Column, start: dict[str, Column], step, end) -> Column:
    """Walk the operations once: ``step(state, x)`` gives the new fields of a small state, x being op, len and the offset ``ref``
    after it on the reference; ``end(state)`` is the result. NULL for NULL."""
    def one(a: Column, x: Column) -> Column:
        ref = a["ref"] + F.when(F.lit(REFERENCE).contains(x["op"]), x["len"]).otherwise(F.lit(0).cast("bigint"))
        new = step(a, {"op": x["op"], "len": x["len"], "ref": ref})
        return F.struct(ref.alias("ref"), *[new[k].alias(k) for k in start])

    return F.aggregate(operations(cigar), F.struct(F.lit(0).cast("bigint").alias("ref"), *[v.alias(k) for k, v in start.items()]), one, end)


OPERATIONS = "=DHIMNPSX"  # sorted
OFFSETS = {"ref": REFERENCE, "read": READ, "whole": WHOLE_READ}


def offsets(cigars: pa.Array) -> pa.Array:
    """For each CIGAR its operations with the offsets after them; one pass over the bytes of all of them."""
    texts = pc.fill_null(cigars.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    begin = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[begin[0] : begin[-1]]
    begin = begin - begin[0]
    digit = (data >= 48) & (data <= 57)
    place = np.arange(len(data))
    before = np.zeros(len(data), np.int64)  # the last place up to here that isn't a digit, or where its text begins
    stops = np.where(digit, -1, place)
    first = np.zeros(len(data), bool)
    first[begin[:-1][begin[:-1] < len(data)]] = True
    stops[first & digit] = place[first & digit] - 1
    before = np.maximum.accumulate(stops) if len(data) else before
    known = np.frombuffer(OPERATIONS.encode(), np.uint8)
    at = np.flatnonzero(np.isin(data, known))
    at = at[(at > 0) & ~first[at]]
    at = at[digit[at - 1]]
    size = at - 1 - before[at - 1]
    digits = np.repeat(at - size, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    power = np.repeat(at - 1, size) - digits
    value = (data[digits].astype(np.int64) - 48) * 10 ** np.minimum(power, 18)
    length = np.add.reduceat(value, np.cumsum(size) - size) if len(at) else np.zeros(0, np.int64)
    text = np.searchsorted(begin, at, "right") - 1
    counts = np.bincount(text, minlength=n)
    starts = np.append(0, np.cumsum(counts))
    number = np.arange(len(at)) - starts[text]
    kinds = data[at]
    fields = {"i": number, "op": pa.array(list(OPERATIONS)).take(pa.array(np.searchsorted(known, kinds))), "len": length}
    for name, ops in OFFSETS.items():
        upto = np.append(0, np.cumsum(np.where(np.isin(kinds, np.frombuffer(ops.encode(), np.uint8)), length, 0)))
        fields[name] = upto[1:] - upto[starts[text]]
    walked = pa.StructArray.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), walked, mask=pc.is_null(cigars).combine_chunks() if isinstance(cigars, pa.ChunkedArray) else pc.is_null(cigars))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.StringType() if c == "op" else T.LongType()) for c in ("i", "op", "len", *OFFSETS)])))
def walk(cigars: pa.Array) -> pa.Array:
    """array<struct<i, op, len, ref, read, whole>>: each operation with the offsets after it, on the reference, the stored and the whole read."""
    return offsets(cigars)


def clips_to_insertions(pos: Column, cigar: Column, seq: Column, qual: Column, site: Column, window: Column) -> Column:
    """struct<pos, cigar, seq, qual> with a clip that ends inside [site - window, site + window] rewritten as an insertion.

    A soft clip becomes I; a hard clip becomes I with its bases as N and lowest quality, so lengths agree. One base next to it is
    taken as M at the outer end, so the record still begins and ends aligned, and a left clip moves POS by that base. The right end
    comes first. Records without such a clip, or with NULLs, stay as they are; where qualities don't fit the sequence they become
    the lowest.
    """
    known = pos.isNotNull() & cigar.isNotNull() & seq.isNotNull() & site.isNotNull() & window.isNotNull() & (cigar != "*")
    number = lambda c, pattern: F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).cast("bigint"), F.lit(0))
    tail, head = r"(\d+)[SH]$", r"^(\d+)[SH]"
    n = number(cigar, tail)
    right = (n > 1) & (F.abs(pos + reference_length(cigar) - site) <= window)
    turned = F.when(right, F.concat(F.regexp_replace(cigar, r"\d+[SH]$", ""), (n - 1).cast("string"), F.lit("I1M"))).otherwise(cigar)
    m = number(turned, head)
    left = (m > 1) & (F.abs(pos - site) <= window)
    more = lambda end, of, size, sign: F.when(end & of.rlike(sign), F.repeat(F.lit("N"), size.cast("int"))).otherwise("")
    before, after = more(left, turned, m, r"^\d+H"), more(right, cigar, n, r"H$")
    low = lambda x: F.repeat(F.lit("!"), F.length(x))
    fits = F.when(F.length(qual) == F.length(seq), qual).otherwise(low(seq))
    new = F.struct(
        F.when(left, pos - 1).otherwise(pos).cast("bigint").alias("pos"), F.when(left, F.concat(F.lit("1M"), (m - 1).cast("string"), F.lit("I"), F.regexp_replace(turned, head, ""))).otherwise(turned).alias("cigar"),
        F.concat(before, seq, after).alias("seq"), F.concat(low(before), fits, low(after)).alias("qual"),
    )
    return F.when(known, new).otherwise(F.struct(pos.cast("bigint").alias("pos"), cigar.alias("cigar"), seq.alias("seq"), qual.alias("qual")))
