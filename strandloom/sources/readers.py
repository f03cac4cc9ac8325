"""Readers of formats whose records can't be told apart by a separator; each partition is one file."""

from __future__ import annotations

import glob
import gzip
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema

BAM = "qname string, flag bigint, rname string, pos bigint, mapq bigint, cigar string, seq string, qual string, nm bigint"
FASTQ = "name string, seq string, qual string"
DELTA = "rid string, qid string, rlen bigint, qlen bigint, rstart bigint, rend bigint, qstart bigint, qend bigint, errors bigint, offsets array<bigint>"


def _open(path: str):
    with open(path, "rb") as f:
        zipped = f.read(2) == b"\x1f\x8b"
    return gzip.open(path, "rt") if zipped else open(path)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Files(DataSourceReader):
    """Files of a path, folder or pattern, local or on a mount all executors share."""

    def __init__(self, options):
        path = options["path"].removeprefix("file://")
        found = sorted(glob.glob(os.path.join(path, "*")) if os.path.isdir(path) else glob.glob(path))
        self.paths = [p for p in found if os.path.isfile(p) and not os.path.basename(p).startswith((".", "_"))]
        if not self.paths:
            raise FileNotFoundError(path)

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition) -> Iterator[tuple]:
        with _open(partition.path) as lines:
            yield from self.records(line.rstrip("\r\n") for line in lines)

    def records(self, lines: Iterator[str]) -> Iterator[tuple]:
        raise NotImplementedError


class Fastq(DataSource):
    @classmethod
    def name(cls):
        return "reads_fastq"

    def schema(self):
        return FASTQ

    def reader(self, schema):
        return _Fastq(self.options)


def _reads(lines: Iterator[str]) -> Iterator[tuple]:
    """A header, sequence lines up to a line that begins with +, then quality until it is as long as the sequence."""
    for line in lines:
        if not line:
            continue
        if not line.startswith("@"):
            raise ValueError(f"a read should begin here: {line[:40]!r}")
        name, seq, qual = line[1:], [], ""
        for line in lines:
            if line.startswith("+"):
                break
            seq.append(line.strip())
        whole = "".join(seq).upper()
        while len(qual) < len(whole):
            part = next(lines, None)
            if part is None:
                break
            qual += part
        yield name, whole, qual


class _Fastq(_Files):
    def records(self, lines):
        return _reads(lines)


class Delta(DataSource):
    @classmethod
    def name(cls):
        return "delta_alignments"

    def schema(self):
        return DELTA

    def reader(self, schema):
        return _Delta(self.options)


def _alignments(lines: Iterator[str]) -> Iterator[tuple]:
    """After two lines of header: a line of names and lengths, then alignments, each with offsets that end in 0."""
    pair = None
    for i, line in enumerate(lines):
        if i < 2 and not line.startswith(">"):
            continue
        if line.startswith(">"):
            rid, qid, rlen, qlen = line[1:].split()[:4]
            pair = rid, qid, int(rlen), int(qlen)
        elif pair and line.strip():
            numbers = [int(x) for x in line.split()]
            offsets = []
            for part in lines:
                if int(part) == 0:
                    break
                offsets.append(int(part))
            yield (*pair, *numbers[:5], offsets)


class _Delta(_Files):
    def records(self, lines):
        return _alignments(lines)


class Bam(DataSource):
    @classmethod
    def name(cls):
        return "bam_alignments"

    def schema(self):
        return BAM

    def reader(self, schema):
        return _Bam(self.options)


class _Bam(_Files):
    def read(self, partition):
        with gzip.open(partition.path, "rb") as f:
            yield from bam_records(f)


# Fixed values of the binary format: letters of bases and operations, and the sizes of the numbers in tags.
BASES, OPERATIONS, WIDTHS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X", {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
_PAIRS = [a + b for a in BASES for b in BASES]


def bam_records(f) -> Iterator[tuple]:
    """Alignments of a decompressed stream, as ``parse_sam`` gives them; records without CIGAR are dropped."""

    def take(n: int) -> bytes:
        data = f.read(n)
        if len(data) != n:
            raise ValueError("the file ends within a record")
        return data

    number = lambda: struct.unpack("<i", take(4))[0]
    if take(4) != b"BAM\x01":
        raise ValueError("not a file of binary alignments")
    take(number())
    names = []
    for _ in range(number()):
        names.append(take(number())[:-1].decode())
        take(4)
    while size := f.read(4):
        data = take(struct.unpack("<i", size)[0])
        ref, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", data)
        at = 32 + n_name
        ops = struct.unpack_from(f"<{n_cigar}I", data, at)
        at += 4 * n_cigar
        seq = "".join(_PAIRS[b] for b in data[at : at + (n_seq + 1) // 2])[:n_seq]
        at += (n_seq + 1) // 2
        qual = data[at : at + n_seq]
        if n_cigar:
            yield (
                data[32 : 31 + n_name].decode(), flag, names[ref] if ref >= 0 else "*", pos, mapq, "".join(f"{o >> 4}{OPERATIONS[o & 15]}" for o in ops),
                seq or "*", "*" if not qual or qual[0] == 255 else bytes(q + 33 for q in qual).decode(), _mismatches(data, at + n_seq),
            )


def _mismatches(data: bytes, at: int) -> int | None:
    """The number in the NM tag, if there is one."""
    while at + 3 <= len(data):
        tag, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if tag == b"NM" and kind in "cCsSiI":
            return int.from_bytes(data[at : at + WIDTHS[kind]], "little", signed=kind.islower())
        if kind in "ZH":
            at = data.index(b"\0", at) + 1
        elif kind == "B":
            at += 5 + WIDTHS[chr(data[at])] * struct.unpack_from("<i", data, at + 1)[0]
        else:
            at += WIDTHS[kind]
    return None


SOURCES = (Fastq, Delta, Bam)


def _of_texts(records, schema: pa.Schema, texts: pa.Array) -> pa.Array:
    """A list of the records of each text; NULL for NULL."""
    rows = [None if t is None else [dict(zip(schema.names, r, strict=True)) for r in records(iter(t.split("\n")))] for t in texts.to_pylist()]
    return pa.array(rows, pa.list_(pa.struct(list(schema))))


_FASTQ = pa.schema([(c, pa.string()) for c in ("name", "seq", "qual")])
_DELTA = pa.schema([*[(c, pa.string()) for c in ("rid", "qid")], *[(c, pa.int64()) for c in ("rlen", "qlen", "rstart", "rend", "qstart", "qend", "errors")], ("offsets", pa.list_(pa.int64()))])


@F.arrow_udf(T.ArrayType(from_arrow_schema(_FASTQ)))
def fastq_records(texts: pa.Array) -> pa.Array:
    return _of_texts(_reads, _FASTQ, texts)


@F.arrow_udf(T.ArrayType(from_arrow_schema(_DELTA)))
def delta_records(texts: pa.Array) -> pa.Array:
    return _of_texts(_alignments, _DELTA, texts)
