"""Readers and sinks: small files, round trips, odd input."""

import gzip
import re
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandloom import params
from strandloom.sources import formats as fm


def put(folder, name, text):
    p = folder / name
    p.write_text(text)
    return str(p)


def test_fasta(spark, tmp_path):
    p = put(tmp_path, "a.fa", ">one x > y\nacg\nTT\n\n>two\n>three\r\nA C\r\nG\n")
    assert rows(fm.read_fasta(spark, p)) == [("one x > y", "ACGTT"), ("three", "ACG"), ("two", "")]
    assert rows(fm.sequence_index(fm.read_fasta(spark, p))) == [("one x > y", 5), ("three", 3), ("two", 0)]


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT"), ("b", "N" * 5000)], "name string, seq string")
    fm.write_fasta(df, str(tmp_path / "out"))
    assert rows(fm.read_fasta(spark, str(tmp_path / "out"))) == rows(df)


@pytest.mark.parametrize("zipped", [False, True])
def test_fastq(spark, tmp_path, zipped):
    text = "@r1 a\nAC\nGT\n+\n@I\nI+\n\n@r2\nA\n+r2\n@\n@r3\n\n+\n\n"
    p = tmp_path / "r.fastq"
    p.write_bytes(gzip.compress(text.encode()) if zipped else text.encode())
    assert rows(fm.read_fastq(spark, str(p))) == [("r1 a", "ACGT", "@II+"), ("r2", "A", "@"), ("r3", "", "")]


def test_fastq_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGT", "IIII")], "name string, seq string, qual string")
    fm.write_fastq(df, str(tmp_path / "q"))
    assert rows(fm.read_fastq(spark, str(tmp_path / "q"))) == rows(df) == rows(fm.read_fastq(spark, str(tmp_path / "q"), four_lines=True))
    with pytest.raises(Exception, match="four lines"):
        fm.read_fastq(spark, put(tmp_path, "cut.fastq", "@a\nAC\n+\nII\n@b\nA\n"), four_lines=True).collect()


def test_hits_keep_their_lines(spark, tmp_path):
    line = "q:1\tT\t99.5\t10\t0\t0\t1\t10\t20\t11\t1e-5\t44.0"
    p = put(tmp_path, "h.tsv", "\n".join(["# comment", line, "", line.replace("44.0", "x")]) + "\n")
    got = fm.read_hits(spark, p).orderBy("line_no").collect()
    assert [(r.line_no, r.qseqid, r.send, r.evalue, r.bitscore) for r in got] == [(2, "q:1", 11, 1e-5, 44.0), (4, "q:1", 11, 1e-5, None)]


def test_lines_are_numbered_in_every_split(spark, tmp_path):
    for name, n in (("a.tsv", 5000), ("b.tsv", 1), ("c.tsv", 0), ("d.tsv", 3333)):
        put(tmp_path, name, "".join(f"{name} {i}\n" for i in range(1, n + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = fm.read_numbered(spark, str(tmp_path))
        assert got.count() == 8334 and got.filter("value <> concat(substring_index(path, '/', -1), ' ', line_no)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bed_gff_paf(spark, tmp_path):
    assert rows(fm.read_bed(spark, put(tmp_path, "a.bed", "c\t1\t2\tT|i.1\t5\t+\nd\t3\t4\n")).select("chrom", "te", "ident", "strand")) == [("c", "T", "i.1", "+"), ("d", None, None, None)]
    g = fm.read_gff(spark, put(tmp_path, "a.gff", "#h\nc\ts\tf\t10\t20\t.\t+\t.\tID=x;SIDE=L\n")).collect()[0]
    assert (g.start, g.end, g.attributes) == (9, 20, {"ID": "x", "SIDE": "L"})
    assert fm.read_paf(spark, put(tmp_path, "a.paf", "q\t9\t0\t9\t+\tt\t99\t5\t14\t9\t9\t60\ttp:A:P\n")).collect()[0].tend == 14


VCF = "##fileformat=VCFv{}\n##contig=<ID=c>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n{}"
LINES = "c\t5\t1\tN\t{}\t.\tPASS\tSVTYPE=INS;END=6;RE=3;SUPPORT=4;SEQS=AAAA,CC;RNAMES=r1,r2\nc\t9\t2\t{}\t<DEL>\t.\tPASS\tIMPRECISE;SVTYPE=DEL;END=19;RE=2;READS=r3\nshort\n"


def test_vcf_versions(spark, tmp_path):
    body = LINES.format("ACGNT", "ACGTACGT")
    for version, want in (("4.1", [("c:<DEL>:9:19:sniffles.DEL.2:2:IMPRECISE", "ACGTACGT"), ("c:<INS>:5:6:sniffles.INS.1:3:PRECISE", "ACGAT")]), ("4.2", [("c:<INS>:5:6:1:3:PRECISE", "AAAA")]), ("4.3", [("c:<INS>:5:6:sniffles.INS.1:4:PRECISE", "ACGAT")])):
        v, df = fm.read_vcf(spark, put(tmp_path, f"{version}.vcf", VCF.format(version, body)))
        assert v == version and rows(fm.variant_sequences(df, v, least=3, without=[])) == want
        assert rows(fm.variant_sequences(df, v, least=4, most=4, without=[])) == []
        assert rows(fm.supporting_reads(df).select("id", "read_name")) == [("1", "r1"), ("1", "r2"), ("2", "r3")]
    assert rows(fm.contigs(spark.read.text(str(tmp_path / "4.1.vcf")))) == [("c", None)]
    with pytest.raises(ValueError, match="no contig"):
        fm.read_vcf(spark, str(tmp_path / "4.1.vcf"), "x,y")
    with pytest.raises(ValueError, match="unknown"):
        fm.read_vcf(spark, put(tmp_path, "x.vcf", VCF.format("5.0", body)))


SAM = "@SQ\tSN:c\tLN:100\nr1\t0\tc\t11\t60\t5S10M\t*\t0\t0\tACGTACGTACGTACG\tIIIIIIIIIIIIIII\tNM:i:2\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\nr3\t16\tc\t1\t9\t4M2I1M3H\t*\t0\t0\tACGTACG\t*\n"


def test_sam(spark, tmp_path):
    p = put(tmp_path, "a.sam", SAM)
    df = fm.read_sam(spark, p)
    assert [(r.qname, r.pos, r.nm) for r in df.orderBy("qname").collect()] == [("r1", 10, 2), ("r3", 0, None)]
    sizes = fm.parse_sam_sizes(spark.read.text(p))
    assert rows(sizes) == [("c", 100)]
    assert rows(fm.alignment_coords(df, sizes)) == [(0, 5, 10, 3, 100, 10, "c", "r3"), (10, 20, 5, 15, 100, 15, "c", "r1")]
    with pytest.raises(Exception, match="NM"):
        fm.read_sam(spark, p, need_nm=True).collect()


def binary(lines, names):
    """Alignment lines in the binary format, in two compressed members as block compression makes them."""
    out = b"BAM\x01" + struct.pack("<i", 5) + b"@HD\t\n" + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 100) for n in names)
    for line in lines:
        q, flag, r, pos, mapq, cigar, _, _, _, seq, qual, *tags = line.split("\t")
        ops = [int(n) << 4 | "MIDNSHP=X".index(o) for n, o in re.findall(r"(\d+)(.)", cigar)]
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
        body = struct.pack("<iiBBHHHiiii", names.index(r) if r in names else -1, int(pos) - 1, len(q) + 1, int(mapq), 0, len(ops), int(flag), len(seq), -1, -1, 0) + q.encode() + b"\0" + struct.pack(f"<{len(ops)}I", *ops)
        body += bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2)) + (b"\xff" * len(seq) if qual == "*" else bytes(ord(c) - 33 for c in qual))
        body += b"XZZabc\0" + b"XBBs" + struct.pack("<ihh", 2, 1, 2) + b"".join(b"NMC" + bytes([int(t[5:])]) for t in tags)
        out += struct.pack("<i", len(body)) + body
    return gzip.compress(out[: len(out) // 2]) + gzip.compress(out[len(out) // 2 :])


def test_bam(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(binary([x for x in SAM.split("\n") if x and x[0] != "@"], ["c"]))
    assert rows(fm.read_bam(spark, str(tmp_path / "a.bam"))) == rows(fm.read_sam(spark, put(tmp_path, "a.sam", SAM)))
    (tmp_path / "b.bam").write_bytes(gzip.compress(gzip.decompress((tmp_path / "a.bam").read_bytes())[:-3]))
    with pytest.raises(Exception, match="within a record"):
        fm.read_bam(spark, str(tmp_path / "b.bam")).collect()


def test_delta(spark, tmp_path):
    p = put(tmp_path, "a.delta", "/ref /qry\nNUCMER\n>c q 100 90\n1 50 1 49 2 2 0\n10\n-3\n0\n60 70 50 60 0 0 0\n0\n")
    got = fm.read_delta(spark, p).orderBy("rstart").collect()
    assert [(r.rid, r.rend, r.errors, r.offsets) for r in got] == [("c", 50, 2, [10, -3]), ("c", 70, 0, [])]


def test_manifest_sizes_and_missing_files(spark, tmp_path):
    assert fm.read_manifest(spark, put(tmp_path, "m", "d/G17:G17\nd/G11/:G11\n\nd/G2:G2")) == [("d/G2", "G2", 2), ("d/G11", "G11", 11), ("d/G17", "G17", 17)]
    assert fm.read_manifest(spark, put(tmp_path, "n", "a\nb\n")) == [("a", "G1", 1), ("b", "G2", 2)]
    assert rows(fm.read_sizes(spark, put(tmp_path, "a.fai", "c\t10\t1\t2\t3\n"))) == [("c", 10)]
    with pytest.raises(Exception, match="nowhere"):
        fm.read_fastq(spark, str(tmp_path / "nowhere")).collect()


def test_fact_sinks(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, "x"), ("d", 2, None)], "chrom string, start bigint, tsd string")
    fm.write_facts(df, str(tmp_path / "f"))
    one = spark.read.parquet(str(tmp_path / "f")).filter("chrom = 'c'")
    assert rows(one.select("start", "tsd")) == [(1, "x")] and "PartitionFilters: [isnotnull(chrom" in one._jdf.queryExecution().toString()
    fm.write_tabbed(df, str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("c\t1\tx",), ("d\t2\t",)]
    fm.write_json_parts(df, str(tmp_path / "j"), 2)
    assert spark.read.json(str(tmp_path / "j")).filter(F.col("start") == 2).count() == 1


def test_params():
    p = params.params({"chrom_keep": "2L", "detection": {"least_size_percent": 12.0}})
    assert p.chrom_keep == "2L" and p.clusters.reads == 50 and p.sites.least_percent(p.detection) == 5
    assert params.Params().sites.least_percent(params.Detection()) == 70
    with pytest.raises(ValueError, match="unknown"):
        params.params({"colour": 1})
    assert params.merged({"a": {"x": 1}, "DATA": {}}, {"a": {"x": 2, "y": 3}, "b": 4, "DATA": {"k": 1}}) == {"a": {"x": 1, "y": 3}, "b": 4, "DATA": {}}
    assert params.option_string("--min-size 80 -k -x -5") == {"min-size": "80", "k": "", "x": "-5"}
    p = params.with_options(params.Params(), "--min-size-percent 70 -r 3 -k 'INS|DEL'")
    assert (p.detection.least_size_percent, p.detection.least_read_support, p.detection.types, p.detection.least_pident) == (70.0, 3, "INS|DEL", 80.0)
    with pytest.raises(ValueError, match="unknown"):
        params.with_options(p, "--colour red")


def test_settings_act(spark):
    from strandloom.plans import configured

    hit = spark.createDataFrame([(1, "A1:<INS>:5:6:t.INS.1:2:PRECISE:0", "T", 90.0, 50.0, 1, 80, 1, 80), (2, "B1:<INS>:5:6:t.INS.2:2:PRECISE:0", "T", 90.0, 50.0, 1, 80, 1, 80)], "line_no bigint, qseqid string, sseqid string, pident double, bitscore double, sstart bigint, send bigint, qstart bigint, qend bigint")
    size = spark.createDataFrame([("T", 100)], "te_name string, size_bp bigint")
    found = lambda **k: sorted(r.line_no for r in configured.elements(hit, size, params.params(k)).collect())
    assert found(detection={"least_size_percent": 70.0}) == [1, 2] and found(chrom_keep="A1,X", detection={"least_size_percent": 70.0}) == [1]
    flanks = spark.createDataFrame([("GGGGACGTACTT", "TTACGTACAAAA")], "fk_l string, fk_r string")
    near = lambda n: [(r.tsd, r.shift_l, r.shift_r) for r in configured.duplications(flanks, params.params({"sites": {"flank": n}})).collect()]
    assert near(20) == [("ACGTAC", 2, 2)] and near(4) == []
    assert found() == [] and found(detection={"least_size_percent": 70.0, "least_read_support": 3}) == []
