"""Keys, attributes and formats that are packed into strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCUS_FIELDS = ("chrom", "sv_type", "start", "end", "id", "support", "precision", "idx", "strand")
# Characters that tools downstream can't take in a name.
ILLEGAL = r"""[:/\\|;!?"'&]"""


def field(key: Column, i: int, separator: str = ":") -> Column:
    """The i-th field (from 1) of a packed key; NULL where there are fewer."""
    return F.get(F.split(key, _quoted(separator)), F.lit(i - 1))


def _quoted(separator: str) -> str:
    return "".join(f"\\{c}" if c in r"\.[]{}()*+?^$|" else c for c in separator)


def first_fields(key: Column, n: int, separator: str = ":") -> Column:
    """The key up to its n-th separator."""
    return F.substring_index(key, separator, n)


def locus(key: Column) -> Column:
    """The parts of a variant key chrom:<TYPE>:start:end:tool.TYPE.n:support:PRECISION:idx[:strand] as a struct."""
    parts = F.split(key, ":")
    numbers = {"start", "end", "support"}
    return F.struct(*[(F.get(parts, F.lit(i)).try_cast("bigint") if n in numbers else F.regexp_replace(F.get(parts, F.lit(i)), "[<>]", "")).alias(n) for i, n in enumerate(LOCUS_FIELDS)])


def assembly_key(key: Column) -> Column:
    """The parts of asm_id:strand:type::chrom:start-end[:strand] as a struct."""
    halves = F.split(key, "::")
    head, tail = F.split(F.get(halves, F.lit(0)), ":"), F.split(F.get(halves, F.lit(1)), ":")
    span = F.split(F.get(tail, F.lit(1)), "-")
    at = lambda a, i: F.get(a, F.lit(i))
    return F.struct(at(head, 0).alias("asm_id"), at(head, 1).alias("asm_strand"), at(head, 2).alias("sv_type"), at(tail, 0).alias("chrom"), at(span, 0).try_cast("bigint").alias("start"), at(span, 1).try_cast("bigint").alias("end"), at(tail, 2).alias("strand"))


def strand_of(sstart: Column, send: Column) -> Column:
    return F.when(send < sstart, "-").otherwise("+")


def size_percent(lo: Column, hi: Column, size: Column, digits: int = 2) -> Column:
    """|hi - lo| as a percentage of size, rounded half up; NULL for a size of 0."""
    return F.round(F.abs(hi - lo) / F.nullif(size, F.lit(0)) * 100, digits)


def attributes(text: Column, pairs: str = ";", key_value: str = "=") -> Column:
    """A map of k=v;k=v attributes; of a repeated key the last counts, a flag without value has NULL."""
    entries = F.filter(F.split(text, pairs), lambda x: x != "")
    packed = F.transform(entries, lambda x: F.struct(F.substring_index(x, key_value, 1).alias("k"), F.when(F.instr(x, key_value) > 0, F.substring(x, F.instr(x, key_value) + len(key_value), F.length(x))).alias("v")))
    last = F.filter(packed, lambda x, i: ~F.exists(F.slice(packed, i + 2, F.size(packed)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def attribute(text: Column, name: str) -> Column:
    return F.element_at(attributes(text), F.lit(name))


def present_number(text: Column, kind: str = "double") -> Column:
    """A number kept as text, NULL for signs of missing (``NONE``, ``INSIDER``, ``.``)."""
    return text.try_cast(kind)


def variant_type(ident: Column) -> Column:
    """SOFT, HARD, DEL or INS as named in an identifier; NULL without any."""
    return F.nullif(F.regexp_extract(ident, "(SOFT|HARD|DEL|INS)", 1), F.lit(""))


def si(value: Column) -> Column:
    """A base count in bp, Kb, Mb or Gb with two decimals."""
    scaled = lambda d, u: F.concat(F.format_number(value / d, 2), F.lit(f" {u}"))
    return F.when(value >= 10**9, scaled(10**9, "Gb")).when(value >= 10**6, scaled(10**6, "Mb")).when(value >= 10**3, scaled(10**3, "Kb")).otherwise(F.concat(value.cast("string"), F.lit(" bp")))


def chain_id(text: Column) -> Column:
    """A number for a string from a float32 recurrence over its bytes, c + (7 + i) / (5 - c), as fraction * 1e5 + whole part.

    Single precision and the order of bytes are part of the result. NULL gives NULL; a byte of 5, which divides by zero, NaN.
    """
    single = lambda c: c.cast("float")
    byte = F.transform(F.filter(F.split(F.hex(F.encode(text, "UTF-8")), r"(?<=\G..)"), lambda x: x != ""), lambda x: F.conv(x, 16, 10).cast("int"))
    term = F.transform(byte, lambda c, i: single(c) + single(F.call_function("try_divide", single(7 + i), single(5 - c))))
    total = F.aggregate(F.transform(term, lambda x: x.cast("float")), single(F.lit(0)), lambda a, x: (a + x).cast("float"))
    whole = single(total.cast("bigint"))
    number = (((total - whole).cast("float") * single(F.lit(100_000))).cast("float") + whole).cast("float").cast("double")
    return F.when(text.isNotNull(), F.coalesce(number, F.lit(float("nan"))))


def pseudonyms(names: Sequence[str], prefix: str = "ELEMENT") -> dict[str, str]:
    """Every name -> prefix + its number, if any name holds a character that tools can't take; else no renaming."""
    import re

    return {n: f"{prefix}{i}" for i, n in enumerate(names, 1)} if any(re.search(ILLEGAL, n) for n in names) else {}


def embedded_pieces(seq: Column) -> Column:
    """Identifiers written into a sequence as digits before their piece: array<struct<id, piece, start>>, start 0-based.

    Each is searched from the end of the one before, so a piece that comes twice has two places.
    """
    found = F.regexp_extract_all(seq, F.lit(r"(\d+[A-Za-z]+)"), F.lit(1))
    state = lambda end, out: F.struct(end.alias("end"), out.alias("out"))

    def step(a: Column, x: Column) -> Column:
        at = F.call_function("locate", x, seq, a["end"] + 1)
        one = F.struct(F.regexp_extract(x, r"^\d+", 0).alias("id"), F.regexp_replace(x, r"^\d+", "").alias("piece"), (at - 1).cast("bigint").alias("start"))
        return state(at - 1 + F.length(x), F.concat(a["out"], F.array(one)))

    return F.aggregate(found, state(F.lit(0), F.array().cast("array<struct<id:string,piece:string,start:bigint>>")), step, lambda a: a["out"])


def renamed(df, column: str, names):
    """The rows with ``column`` as its original where ``names`` (original, pseudo) has it as a pseudonym, else unchanged."""
    back = names.select(F.col("pseudo").alias(column), F.regexp_replace("original", r"\\", "_").alias("__original"))
    return df.join(back, column, "left").withColumn(column, F.coalesce("__original", column)).drop("__original")
