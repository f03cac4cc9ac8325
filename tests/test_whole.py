"""Whole queries on tables of a few rows, each with what the shorter ones leave out."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows

from strandloom.operators import viewer
from strandloom.plans import registry
from strandloom.plans.views import HIT_COLUMNS

Q = registry.queries()
EVIDENCE = pa.schema([(c, pa.string() if c in ("chrom", "read_name", "seq") else pa.int64()) for c in ("chrom", "pos", "pos1", "read_name", "seq", "count_read", "count_read_real", "op_len")])

TEXT, WHOLE, REAL = ("chrom", "te_id", "strand", "tsd", "size_te", "freq", "freq_with_clipped", "sv_size", "sv_id", "sv_type"), ("start_pos", "end_pos", "new_pos"), ("pident", "psize_te")
FACTS = pa.schema([(c, t) for cs, t in ((TEXT, pa.string()), (WHOLE, pa.int64()), (REAL, pa.float64())) for c in cs])
HITS = pa.schema([(c, pa.string() if c in ("qseqid", "sseqid") else pa.float64() if c in ("pident", "evalue", "bitscore") else pa.int64()) for c in HIT_COLUMNS])


@pytest.fixture
def write(tmp_path):
    """Writes a table of dictionaries, absent values as NULL, and gives the folder."""

    def put(name, schema, *data):
        pq.write_table(pa.Table.from_pylist([{c: r.get(c) for c in schema.names} for r in data], schema=schema), tmp_path / f"{name}.parquet")
        return str(tmp_path)

    return put


def test_splice_takes_every_insert_whole(spark, write):
    d = write("ins_evidence", EVIDENCE, {"chrom": "A", "pos": 3, "read_name": "r", "seq": "C" * 30}, {"chrom": "A", "pos": 25_000, "read_name": "s", "seq": "G" * 22})
    got = rows(Q["k3_genome_splice"](spark, d).select("piece", "seq", "n_inserts"))
    assert got == [(0, "C" * 60, 1), (2, "G" * 22, 1)]


def test_duplications_of_whole_sequences(spark, write):
    """A stretch of 14 letters that lies behind letter 21 on its right side."""
    w = "ACGTTGCAAGCTCA"
    d = write("ins_evidence", EVIDENCE, {"chrom": "A", "pos": 1000, "read_name": "r", "seq": "GGGGGG" + w + "TT" + "CC" + w + "AAAAAA"})
    assert rows(Q["f3_duplications_genome"](spark, d)) == [("A", 1000, "r", w, 2, 2, 998)]
    assert rows(Q["f4_duplications_reads"](spark, d)) == [("A", 1000, "r", w, 998)]


def test_export_of_all_facts(spark, write):
    """Every fact and column comes out, a missing chromosome with its sign; the question by identifier is the viewer's."""
    d = write("te_infos", FACTS, {"chrom": "A", "start_pos": 5, "pident": 90.5, "strand": "-", "sv_id": "one"}, {"sv_id": "two"})
    got = {r["sv_id"]: r.asDict() for r in Q["k1_export_signs"](spark, d).collect()}
    assert set(got["one"]) == set(FACTS.names) and (got["one"]["chrom"], got["one"]["start_pos"], got["one"]["pident"], got["one"]["strand"], got["one"]["tsd"]) == ("A", "5", "90.5", "-", "NONE")
    assert got["two"] == dict.fromkeys(FACTS.names, "NONE") | {"sv_id": "two", "strand": "."}
    assert [r["chrom"] for r in viewer.facts(Q["k1_export_signs"](spark, d), "one").collect()] == ["A"]


@pytest.mark.parametrize("name", ["f1_reverse_complement", "f2_exact_search", "f10_chain_id", "valid_long_sequences"])
def test_sequences_without_places(spark, write, name):
    """A sequence counts once, whatever its rows miss."""
    seq = "GA" * 16
    d = write("ins_evidence", EVIDENCE, {"seq": seq}, {"chrom": ".", "pos": 4, "seq": seq, "read_name": "r"}, {"chrom": "A", "pos": 4, "op_len": 1, "read_name": "r"})
    assert [r["seq"] for r in Q[name](spark, d).collect()] == [seq]


def test_records_without_chromosome(spark, write):
    d = write("ins_evidence", EVIDENCE, {"pos": 4, "read_name": "r", "seq": "ACGT"}, {"read_name": "s", "seq": "AC"})
    assert rows(Q["sc1_fasta_records"](spark, d)) == [("r 4", "ACGT")]
    assert rows(Q["sc11_sequence_index"](spark, d)) == [("r", 4), ("s", 2)]


def test_families_count_every_line(spark, write):
    """Lines without coordinates, query or score count, copies once, lines of no family not at all."""
    nan = float("nan")
    d = write("blast_hits", HITS, {"line_no": 1, "sseqid": "T"}, {"line_no": 1, "sseqid": "T"}, {"line_no": 2, "sseqid": "T", "bitscore": nan}, {"line_no": 3, "sseqid": "U", "bitscore": -1.0}, {"line_no": 4, "sseqid": "."}, {"sseqid": "U"})
    assert rows(Q["a1_count_per_family"](spark, d)) == [("T", 2), ("U", 1)]


def test_scan_keeps_nan(spark, write):
    d = write("blast_hits", HITS, {"line_no": 1, "bitscore": float("nan")}, {"line_no": 2}, {"line_no": 3, "bitscore": 7.0})
    assert rows(Q["sc4_hit_scan"](spark, d).selectExpr("line_no", "isnan(bitscore)", "bitscore is null", "bitscore_nan")) == [(1, True, False, True), (2, False, True, False), (3, False, False, False)]


def test_hit_lines_keep_odd_names(spark, write):
    """Names that are empty, begin like a comment or hold a tab or a code come out of the lines as they went in; NaN stays NaN."""
    names = ["", "#q", "a\tb", "%", "%%", "%09", "%23", "%2509", "a%", "#%25\t", ".", None]
    d = write("blast_hits", HITS, *[{"line_no": i, "qseqid": n, "sseqid": n, "evalue": 0.5, "bitscore": float("nan")} for i, n in enumerate(names)])
    got = Q["sc4_hit_lines"](spark, d).selectExpr("line_no", "qseqid", "sseqid", "evalue", "isnan(bitscore)", "bitscore_nan", "pident").collect()
    assert sorted(map(tuple, got)) == [(i, n, n, 0.5, True, True, None) for i, n in enumerate(names)]


def test_geometry_outside_the_element(spark, write):
    """A reverse hit that ends 30 beyond an element of 100 bases, and a hit that begins 29 before it."""
    write("te_sizes", pa.schema([("te_name", pa.string()), ("size_bp", pa.int64())]), {"te_name": "T", "size_bp": 100})
    d = write("blast_hits", HITS, {"line_no": 1000, "sseqid": "T", "sstart": 130, "send": 81, "qstart": 1, "qend": 50}, {"line_no": 6000, "sseqid": "T", "sstart": -28, "send": 21, "qstart": -9, "qend": 50})
    assert rows(Q["f20_hit_geometry"](spark, d)) == [(1000, -1, -150, -3, 150, 3, 245, 4), (6000, 1, -145, -2, 145, 2, 245, 4)]


def test_groups_of_all_chromosomes(spark, write):
    hit = {"sseqid": "T", "sstart": 1, "send": 2}
    d = write("blast_hits", HITS, hit | {"line_no": 1, "qseqid": "A2:x", "bitscore": 5.0}, hit | {"line_no": 2, "qseqid": "A1:x", "bitscore": 9.0}, hit | {"line_no": 3, "qseqid": "A1:x", "bitscore": 7.0})
    assert [tuple(r) for r in Q["t2_groups_by_score"](spark, d).collect()] == [("A1:x", "T", 9.0, 2, 2), ("A2:x", "T", 5.0, 1, 1)]
    assert [r["qseqid"] for r in viewer.groups(Q["t2_groups_by_score"](spark, d).selectExpr("qseqid", "sseqid", "best bitscore", "line_no"), "A2").collect()] == ["A2:x"]
