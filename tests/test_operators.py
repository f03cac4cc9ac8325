"""Micro-cases of the operators, each with the result it must have."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from strandloom.functions import cigar as cg
from strandloom.functions import sequence as sq
from strandloom.functions import text as tx
from strandloom.operators import assembly as asm
from strandloom.operators import evidence as ev
from strandloom.operators import generations as gen
from strandloom.operators import genome, report, tsd, viewer
from strandloom.operators import hits as ht
from strandloom.operators import intervals as iv
from strandloom.operators.merge import merge_calls

SPAN = "chrom string, start bigint, end bigint"


def spans(spark, *data, chrom="c"):
    return spark.createDataFrame([(chrom, *d) for d in data], SPAN)


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def value(df, column):
    return df.select(column.alias("v")).collect()[0].v


# -- intervals -----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("width", [4, 1 << 18])
def test_cluster_distances(spark, width):
    df = spans(spark, (0, 1), (51, 52), (103, 104))
    assert [r.cluster for r in iv.cluster(df, ["chrom"], "start", "end", 50, width).orderBy("start").collect()] == [1, 1, 2]
    held = spans(spark, (0, 1000), (10, 20), (1040, 1041))
    assert {r.cluster for r in iv.cluster(held, ["chrom"], "start", "end", 50, width).collect()} == {1}


def test_cluster_of_copies_nulls_and_nothing(spark):
    df = spans(spark, (5, 6), (5, 6), (None, 3), (9, None), (80, 81))
    assert sorted(r.cluster for r in iv.cluster(df, ["chrom"], "start", "end", 50).collect()) == [1, 1, 1 + 1]
    assert iv.merge(df.limit(0), ["chrom"], "start", "end", 5).count() == 0
    assert rows(iv.merge(df, ["chrom"], "start", "end", 50)) == [("c", 5, 6, 2), ("c", 80, 81, 1)]


def test_clusters_do_not_depend_on_order_or_width(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), a := rng.randrange(400), a + rng.randrange(30)) for _ in range(200)]
    want = rows(iv.cluster(spark.createDataFrame(data, SPAN), ["chrom"], "start", "end", 3))
    rng.shuffle(data)
    for width in (1, 10, 100):
        assert rows(iv.cluster(spark.createDataFrame(data, SPAN), ["chrom"], "start", "end", 3, width)) == want


@pytest.mark.parametrize("b,found", [((1101, 1102), False), ((1100, 1101), True)])
def test_window_join_is_strict(spark, b, found):
    right = spans(spark, b).withColumnRenamed("start", "s").withColumnRenamed("end", "e")
    assert iv.window_join(spans(spark, (1000, 1001)), right, ["chrom"], ("start", "end"), ("s", "e"), 100).count() == found


@pytest.mark.parametrize("size", [3, 64, 1 << 14])
def test_window_join_is_brute_force(spark, size):
    rng = random.Random(size)
    make = lambda n: [(rng.choice(["c", "c", "d", None]), a := rng.randrange(-40, 120), a + rng.randrange(0, 25)) for _ in range(n)]
    a, b = make(60), make(60)
    left, right = spark.createDataFrame(a, SPAN), spark.createDataFrame(b, "chrom string, s bigint, e bigint")
    near = lambda x, y: x[0] is not None and x[0] == y[0] and y[1] < x[2] + 5 and y[2] > x[1] - 5
    args = (left, right, ["chrom"], ("start", "end"), ("s", "e"), 5)
    assert rows(iv.window_join(*args, bin_size=size)) == sorted(((*x, *y[1:]) for x in a for y in b if near(x, y)), key=str)
    assert rows(iv.window_join(*args, "left_semi", size)) == sorted((x for x in a if any(near(x, y) for y in b)), key=str)
    assert rows(iv.window_join(*args, "left_anti", size)) == sorted((x for x in a if not any(near(x, y) for y in b)), key=str)


def test_complement_and_merge_make_the_whole(spark):
    rng = random.Random(7)
    data = [(a := rng.randrange(900), a + rng.randrange(1, 60)) for _ in range(20)]
    sizes = spark.createDataFrame([("c", 950), ("empty", 40)], "chrom string, size bigint")
    free = rows(iv.complement(spans(spark, *data), sizes, ["chrom"], "start", "end", "size"))
    covered = {x for a, b in data for x in range(a, min(b, 950))}
    assert {x for c, a, b in free if c == "c" for x in range(a, b)} == set(range(950)) - covered
    assert ("empty", 0, 40) in free


def test_subtract(spark):
    a, b = spans(spark, (0, 10), (20, 30), (40, 40)), spans(spark, (3, 5), (8, 22), (25, 26))
    got = iv.subtract(a, b, ["chrom"]).select("start", "piece_start", "piece_end")
    assert rows(got) == [(0, 0, 3), (0, 5, 8), (20, 22, 25), (20, 26, 30)]
    assert rows(iv.subtract(a, b.limit(0), ["chrom"]).select("piece_start", "piece_end")) == [(0, 10), (20, 30)]


def test_depth(spark):
    points = spark.createDataFrame([("c", 5), ("c", 9), ("c", 5), ("c", None)], "chrom string, at bigint")
    assert rows(iv.depth_at(points, spans(spark, (0, 6), (5, 9), (5, 6)), ["chrom"], "at", ("start", "end"))) == [("c", 5, 3), ("c", 9, 0)]


@pytest.mark.parametrize("width", [3, 1 << 18])
def test_depth_counts_what_holds_a_point(spark, width):
    rng = random.Random(width)
    blocks = [(rng.choice("cd"), a := rng.randrange(60), a + rng.randrange(-2, 12)) for _ in range(80)] + [("c", None, 4)]
    points = [(rng.choice("cde"), rng.randrange(70)) for _ in range(60)]
    got = iv.depth_at(spark.createDataFrame(points, "chrom string, at int"), spark.createDataFrame(blocks, SPAN), ["chrom"], "at", ("start", "end"), width)
    assert rows(got) == sorted({(k, p, sum(c == k and a is not None and a <= p < b for c, a, b in blocks)) for k, p in points}, key=str)


def test_consecutive_dedupe(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate("AABA")] + [(2, 9, None), (2, 10, None)], "cl int, i int, te string")
    assert [r.te for r in iv.consecutive_dedupe(df, ["cl"], "te", ["i"]).orderBy("cl", "i").collect()] == ["A", "B", "A", None]


@pytest.mark.parametrize("width", [6, 1 << 18])
def test_splice_offsets(spark, width):
    df = spark.createDataFrame([("c", 10, 5, "a"), ("c", 20, 5, "b")], "chrom string, start bigint, size bigint, id string")
    assert [r.new_start for r in iv.running_offset(df, ["chrom"], "start", "size", ["id"], width).orderBy("start").collect()] == [10, 25]


def test_unique_anchors(spark):
    df = spark.createDataFrame([("q", 0, 30_000, 1), ("q", 40_000, 10_000, 2), ("r", 0, 25_000, 3), ("r", None, 5, 4)], "qid string, a bigint, b bigint, row int")
    got = iv.unique_anchors(df, "qid", "a", "b", 20_000, "row").select("row", "unique_length", "tag")
    assert rows(got) == [(1, 10_000, "repetitive"), (2, 10_000, "repetitive"), (3, 25_000, "unique")]


@pytest.mark.parametrize("tile", [7, 1 << 16])
def test_slices_over_tiles(spark, tile):
    rng = random.Random(tile)
    text = {"a": "".join(rng.choice("ACGTN") for _ in range(100)), "b": "AC", "c": ""}
    data = [(rng.choice("abcx"), rng.randrange(-5, 110), rng.randrange(-5, 110), rng.choice("+-")) for _ in range(80)]
    data += data[:9] + [("a", None, 4, "+"), (None, 1, 2, "+")]
    got = genome.slices(spark.createDataFrame(data, "name string, s bigint, e bigint, strand string"), spark.createDataFrame(list(text.items()), "name string, seq string"), "name", "s", "e", "strand", tile=tile)
    turn = lambda x: x[::-1].translate(str.maketrans("ACGT", "TGCA"))
    cut = lambda k, s, e: text[k][max(s, 0) : max(e, 0)]
    assert rows(got) == sorted(((k, s, e, d, turn(cut(k, s, e)) if d == "-" else cut(k, s, e)) for k, s, e, d in data if k in text and s is not None), key=str)


# -- hits ----------------------------------------------------------------------------------------------------------------
def hits(spark, *data):
    """(line_no, qseqid, sseqid, bitscore, sstart, send, qstart, qend)"""
    return spark.createDataFrame([(n, q, s, b, 99.0, *xy) for n, q, s, b, *xy in data], "line_no bigint, qseqid string, sseqid string, bitscore double, pident double, sstart bigint, send bigint, qstart bigint, qend bigint")


KEY = "c:<INS>:1:2:t.INS.1:{}:PRECISE:{}"


def test_failing_best_hit_removes_the_locus(spark):
    h = hits(spark, (1, KEY.format(1, 0), "T", 50.0, 1, 99, 1, 99), (2, KEY.format(1, 1), "T", 90.0, 1, 10, 1, 10))
    sizes = spark.createDataFrame([("T", 100)], "te_name string, size_bp bigint")
    assert ht.detect(h, sizes).count() == 0
    assert [r.line_no for r in ht.detect(h.filter("line_no = 1"), sizes).collect()] == [1]
    assert ht.detect(h.limit(0), sizes).count() == 0


def test_ties_go_to_the_first_line(spark):
    h = hits(spark, (4, "q", "T", 50.0, 1, 2, 3, 4), (3, "q", "T", 50.0, 1, 2, 3, 4))
    assert [r.line_no for r in ht.best_hits(h, F.col("qseqid")).collect()] == [3]


@pytest.mark.parametrize("extra,want", [([(250, 300, 250, 300), (10, 90, 10, 90)], (10, 300, 10, 300)), ([(250, 300, 120, 130)], (100, 200, 100, 200))])
def test_fragments_combine(spark, extra, want):
    data = [(1, "q", "T", 90.0, 100, 200, 100, 200)] + [(2 + i, "q", "T", 10.0, *x) for i, x in enumerate(extra)] + [(9, "p", "T", 1.0, 1, 2, 1, 2), (10, "q", "T", 1.0, 400, 500, 400, 500)]
    r = ht.combine(hits(spark, *data), F.col("qseqid")).filter("locus = 'q'").collect()[0]
    assert (r.sstart, r.send, r.qstart, r.qend) == want


def test_fragments_combine_on_the_reverse_strand(spark):
    h = hits(spark, (1, "q", "T", 90.0, 200, 100, 100, 200), (2, "q", "T", 5.0, 300, 250, 20, 60), (3, "q", "T", 5.0, 90, 40, 250, 300))
    r = ht.combine(h, F.col("qseqid")).collect()[0]
    assert (r.sstart, r.send, r.qstart, r.qend, r.n_hits) == (300, 40, 20, 300, 3)


def brute_combine(data):
    """(locus, line, bounds, hits looked at) from hits (line, qseqid, sseqid, bitscore, sstart, send, qstart, qend); locus is qseqid up to the colon."""
    lines = {}
    for h in sorted((h for h in data if h[0] is not None), key=lambda h: h[:3]):
        lines.setdefault(h[0], h)
    line, best = [lines[n] for n in sorted(lines)], {}
    for i, h in enumerate(line):
        locus = h[1].split(":")[0]
        if h[3] is not None and (locus not in best or h[3] > line[best[locus]][3]):
            best[locus] = i
    out = []
    for locus, i in best.items():
        s, e, q, r = line[i][4:]
        up, n = s < e, 1
        while i + n < len(line) and line[i + n][1:3] == line[i][1:3]:
            a, b, c, d = line[i + n][4:]
            low, high = (a < s and b < e), (a > s and b > e)
            if c < q and d < r and (low if up else high):
                s, q = a, c
            elif c > q and d > r and (high if up else low):
                e, r = b, d
            n += 1
        out.append((locus, line[i][0], s, e, q, r, n))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_combining_however_the_file_is_cut(spark, partitions):
    rng = random.Random(partitions)
    data, q, s = [], "a:1", "T"
    for n in range(400):
        if rng.random() < 0.15:
            q, s = rng.choice(["a:1", "a:2", "b:1", "c:1", "d:1"]), rng.choice("TTU")
        a, b = rng.sample(range(1, 400), 2)
        c, d = sorted(rng.sample(range(1, 400), 2))
        data.append((n * 3, q, s, rng.choice([None, 5.0, 7.0, float(n % 50)]), a, b, c, d))
    data += data[::5] + [(None, "a:1", "T", 99.0, 1, 2, 3, 4)]
    got = ht.combine(hits(spark, *data), F.substring_index("qseqid", ":", 1), partitions).select("locus", "line_no", "sstart", "send", "qstart", "qend", "n_hits")
    assert rows(got) == brute_combine(data)
    lines = {h[0] for h in data if h[0] is not None}
    runs = {r[0]: [n for n in sorted(lines) if n >= r[1]][: r[6]] for r in brute_combine(data)}
    assert rows(ht.continuing(hits(spark, *data), F.substring_index("qseqid", ":", 1), partitions)) == sorted(((k, n) for k, ns in runs.items() for n in ns), key=str)
    assert rows(ht.combine(hits(spark, *data).limit(0), F.col("qseqid"))) == []


# -- evidence ------------------------------------------------------------------------------------------------------------
def classes(spark, *data):
    return spark.createDataFrame(list(data), "ident string, read string, code string")


def site(spark, support, kind="INS", tool="rd"):
    return spark.createDataFrame([("s", support, tool, kind)], "ident string, support bigint, tool string, sv_type string")


def test_no_evidence_masks_an_insertion(spark):
    f = ev.frequencies(classes(spark, ("s", "r", "E"), ("s", "r", "I"), ("s", "q", "I")), site(spark, 0)).collect()[0]
    assert (f.i_only, f.i_all, f.total, f.freq_all) == (1, 1, 2, 50.0)


def test_support_is_a_floor(spark):
    f = ev.frequencies(classes(spark, ("s", "r", "I"), ("s", "q", "E")), site(spark, 3)).collect()[0]
    assert (f.i_all, f.total, f.freq_all) == (3, 3, 100.0)


def test_deletions_count_what_is_left(spark):
    f = ev.frequencies(classes(spark, *[("s", f"r{i}", "D" if i < 3 else "E") for i in range(10)]), site(spark, 1, "DEL")).collect()[0]
    assert (f.i_all, f.total, f.freq_no_clip, f.freq_all) == (7, 10, 70.0, 70.0)


def test_read_classes(spark):
    s = spark.createDataFrame([("c", 1000, 1001, "i", 100, 0, "INS"), ("c", 5000, 5100, "d", 0, 90, "DEL")], "chrom string, start bigint, end bigint, ident string, te_size bigint, sv_size bigint, sv_type string")
    r = spark.createDataFrame([("c", 800, "ins", "200M90I200M", "A"), ("c", 800, "short", "200M50I200M", "A"), ("c", 980, "clip", "30M300S", "A"), ("c", 980, "bare", "30M300S", None), ("c", 4900, "del", "110M95D200M", "A"), ("c", 4900, "*", "*", "A"), ("d", 800, "far", "200M90I200M", "A")], "rname string, pos bigint, qname string, cigar string, seq string")
    assert rows(ev.read_classes(s, r)) == [("d", "del", "D"), ("i", "bare", "E"), ("i", "clip", "S"), ("i", "ins", "I"), ("i", "short", "E")]


def test_cigars_of_any_length(spark):
    texts = ["5S10M2I3D4H", "*", "", None, "M5x7M12", "3=2X1N"] + ["10M2I3D" * 20_000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "c string").select(cg.walk(F.col("c"))).collect()]
    assert [tuple(x) for x in got[0]] == [(0, "S", 5, 0, 5, 5), (1, "M", 10, 10, 15, 15), (2, "I", 2, 10, 17, 17), (3, "D", 3, 13, 17, 17), (4, "H", 4, 13, 17, 21)]
    assert got[1] == [] == got[2] and got[3] is None and [tuple(x) for x in got[4]] == [(0, "M", 7, 7, 7, 7)]
    assert [(x.op, x.ref) for x in got[5]] == [("=", 3), ("X", 3), ("N", 3)]
    assert len(got[6]) == 60_000 and tuple(got[6][-1]) == (59_999, "D", 3, 260_000, 240_000, 240_000)


def test_deletion_support(spark):
    s = spark.createDataFrame([("c", 5000, 5100, "d"), ("c", 9000, 9100, "none")], "chrom string, start bigint, end bigint, ident string")
    r = spark.createDataFrame([("c", 4900, "a", "110M95D200M"), ("c", 4900, "a", "100M100D200M"), ("c", 4900, "b", "100M100I200M")], "rname string, pos bigint, qname string, cigar string")
    assert rows(ev.deletion_support(s, r)) == [("d", 1), ("none", 0)]


def test_depth_frequency(spark):
    df = spark.createDataFrame([(7, 4, 1), (0, 1, 0), (None, None, None)], "l int, r int, w int")
    got = ev.depth_frequency(df, "l", "r", "w").select("total_depth", "read_support", "read_support_percent")
    assert [tuple(x) for x in got.collect()] == [(5, 4, 80.0), (0, 0, 0.0), (0, 0, 0.0)]


# -- sequences -----------------------------------------------------------------------------------------------------------
def test_reverse_complement(spark):
    d = one(spark, s="AcgtnX")
    assert value(d, sq.reverse_complement(F.col("s"))) == "NNACGT"
    r = one(spark, s="ACGTN")
    assert value(r, sq.reverse_complement(sq.reverse_complement(F.col("s")))) == "ACGTN"
    assert value(one(spark, s="ARY"), sq.reverse_complement_ambiguous(F.col("s"))) == "RYT"


def test_long_flanks_give_what_short_ones_do(spark):
    rng = random.Random(11)
    say = lambda n: "".join(rng.choice("ACG") for _ in range(n))
    data = [(i, say(rng.randrange(0, 25)), say(rng.randrange(0, 25))) for i in range(150)] + [(900, None, "ACGT"), (901, "ACGT", None)]
    df = spark.createDataFrame(data, "i int, fk_l string, fk_r string")
    short, long = (rows(tsd.duplications(df, long=x).select("i", "tsd", "shift_l", "shift_r")) for x in (False, True))
    assert short == long and len(short) > 30
    big = say(40_000)
    assert value(one(spark, m="TT" + big[7:9000] + "T", o=big), sq.longest_common_long(F.col("m"), F.col("o"), F.lit(4))) == big[7:9000]
    got = value(one(spark, t=big + "TTT", p="TT"), sq.places(F.col("t"), F.col("p")))
    assert got == [40_000, 40_001]
    assert value(one(spark, t=big, p="ACG"), sq.places(F.col("t"), F.col("p"))) == [i for i in range(40_000) if big[i : i + 3] == "ACG"]


def test_occurrences_overlap(spark):
    assert value(one(spark, t="AAAA", p="AA"), sq.occurrences(F.col("t"), F.col("p"))) == [0, 1, 2]
    assert value(one(spark, t="A", p="AAA"), sq.occurrences(F.col("t"), F.col("p"))) == [] == value(one(spark, t="A", p=""), sq.occurrences(F.col("t"), F.col("p")))


def test_duplications(spark):
    df = spark.createDataFrame([("GTACATTT", "CCCGTACA", 1), ("AAAT", "GGAA", 2), (None, "ACGT", 3), ("", "", 4)], "fk_r string, fk_l string, n int")
    assert rows(tsd.duplications(df).select("n", "tsd", "shift_l", "shift_r")) == [(1, "GTACA", 0, 0)]


def test_place_from_reads(spark):
    df = one(spark, tsd="ACGT", gl="TTACGT", gr="GGACGT", p=100)
    assert tsd.place_from_reads(df, "gl", "gr", "p").collect()[0].new_pos == 100 + 2 - 6 + 4


def test_slices_and_splice(spark):
    g = spark.createDataFrame([("c", "ACGTACGT"), ("e", "TT")], "name string, seq string")
    v = spark.createDataFrame([("c", 1, 4, "+"), ("c", 1, 4, "-"), ("c", 6, 99, "+"), ("x", 0, 1, "+")], "chrom string, s bigint, e bigint, st string")
    assert rows(genome.slices(v, g, "chrom", "s", "e", "st").select("seq_slice")) == [("ACG",), ("CGT",), ("GT",)]
    i = spark.createDataFrame([("c", 2, "xx", 1), ("c", 2, "y", 2), ("c", 99, "z", 3), ("c", None, "q", 4)], "name string, start bigint, insert string, k int")
    assert rows(genome.splice(g, i, "k")) == [("c", "ACxxyGTACGTz", 3), ("e", "TT", 0)]


@pytest.mark.parametrize("width", [1, 3, 8, 10_000])
def test_splice_pieces(spark, width):
    """Pieces in order are the spliced sequence, and no piece gathers more than the inserts of its range."""
    g = spark.createDataFrame([("c", "ACGTACGT"), ("e", "TT"), ("n", "")], "name string, seq string")
    data = [("c", 2, "xx", 1), ("c", 2, "y" * 40, 2), ("c", 8, "b", 9), ("c", 99, "z", 3), ("c", 5, "", 5), ("c", -4, "a", 6), ("c", 7, "w", 7), ("c", None, "q", 4), ("x", 1, "q", 8)]
    i = spark.createDataFrame(data, "name string, start bigint, insert string, k int")
    got = {}
    for r in sorted(genome.splice_pieces(g, i, "k", width).collect(), key=lambda r: (r.name, r.piece)):
        seq, n = got.get(r.name, ("", 0))
        got[r.name] = (seq + r.seq, n + r.n_inserts)
        assert r.n_inserts == sum(a == r.name and s is not None and max(s, 0) // width == r.piece for a, s, _, _ in data)
    assert got == {r.name: (r.seq, r.n_inserts) for r in genome.splice(g, i, "k").collect()}
    assert got["c"] == ("aACxx" + "y" * 40 + "GTACGwTbz", 7)


def test_cigar(spark):
    d = one(spark, c="5S10M3I4D2X1H")
    assert value(d, cg.reference_length(F.col("c"))) == 14
    assert [tuple(x)[:6] for x in value(d, cg.walk(F.col("c")))] == [(0, "S", 5, 0, 5, 5), (1, "M", 10, 10, 15, 15), (2, "I", 3, 10, 18, 18), (3, "D", 4, 14, 18, 18), (4, "X", 2, 14, 18, 18), (5, "H", 1, 14, 18, 19)]
    assert value(one(spark, c="*"), cg.operations(F.col("c"))) == []


def test_clips_become_insertions(spark):
    df = spark.createDataFrame([(100, "5S10M", "A" * 15, "I" * 15, 100, 20), (100, "10M3H", "C" * 10, "I" * 10, 110, 20), (100, "5S10M", "A" * 15, "I" * 15, 900, 20), (100, "*", None, None, 1, 1)], "pos bigint, cigar string, seq string, qual string, site bigint, window bigint")
    got = [tuple(r.x) for r in df.select(cg.clips_to_insertions(*[F.col(c) for c in ("pos", "cigar", "seq", "qual", "site", "window")]).alias("x")).collect()]
    assert got[0][:2] == (99, "1M4I10M") and got[1] == (100, "10M2I1M", "C" * 10 + "NNN", "I" * 10 + "!!!") and got[2][1] == "5S10M" and got[3][1] == "*"


# -- keys and formats ----------------------------------------------------------------------------------------------------
def test_keys(spark):
    d = one(spark, k="2L:<INS>:5:6:sniffles.INS.7:3:PRECISE:0:-", a="u1:+:Insertion::2L:10-20:-")
    k = value(d, tx.locus(F.col("k")))
    assert (k.chrom, k.sv_type, k.start, k.end, k.id, k.support, k.precision, k.idx, k.strand) == ("2L", "INS", 5, 6, "sniffles.INS.7", 3, "PRECISE", "0", "-")
    a = value(d, tx.assembly_key(F.col("a")))
    assert tuple(a) == ("u1", "+", "Insertion", "2L", 10, 20, "-")
    assert value(one(spark, x="E=1;FLAG;E=2;"), tx.attributes(F.col("x"))) == {"E": "2", "FLAG": None}
    assert value(one(spark, n=1500), tx.si(F.col("n"))) == "1.50 Kb"
    assert tx.pseudonyms(["a", "b:c"]) == {"a": "ELEMENT1", "b:c": "ELEMENT2"} and tx.pseudonyms(["a", "b"]) == {}


def test_chain_id(spark):
    import numpy as np

    def single(text):
        total = np.float32(0)
        for i, c in enumerate(text.encode()):
            total = np.float32(total + np.float32(np.float32(c) + np.float32(7 + i) / np.float32(5 - c)))
        whole = np.trunc(total)
        return float(np.float32(np.float32((total - whole) * np.float32(1e5)) + whole))

    texts = ["AC", "CA", "", "2L:12345", "é:7", "ACGTN" * 400, "x y\n"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in [*texts, None, "a\x05b"]], "s string").select(tx.chain_id(F.col("s"))).collect()]
    assert got[: len(texts)] == [single(t) for t in texts] and got[0] != got[1]
    assert got[-2] is None and got[-1] != got[-1]


# -- assemblies ----------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("r,q,kind", [(10, 5000, "Insertion"), (-200, 5000, "Tandem_expansion"), (200, 5000, "Repeat_expansion"), (5000, 10, "Deletion"), (5000, 900, "Repeat_contraction"), (5000, -60, "Tandem_contraction"), (7, 7, None), (0, 30_000, "Longrange"), (0, 200_000, None)])
def test_classify(spark, r, q, kind):
    d = one(spark, r=r, q=q, t=True, f=False)
    assert value(d, asm.classify_between(F.col("r"), F.col("q"), F.col("t"), F.col("f"))) == kind
    assert value(d, asm.classify_between(F.col("r"), F.col("q"), ~F.col("t"), F.col("f"))) in ("Interchromosomal", None)


@pytest.mark.parametrize("width", [500, 1 << 18])
def test_between_alignments(spark, width):
    df = spark.createDataFrame([("c", "q", 0, 1000, 0, 1000), ("c", "q", 1010, 2000, 6000, 7000), ("c", "q", 9000, 9500, 8000, 7500), ("c", None, 0, 1, 0, 1)], "rid string, qid string, rstart bigint, rend bigint, qstart bigint, qend bigint")
    got = asm.between_alignments(df, width=width).collect()
    assert [(r.start, r.stop, r["size"], r.sv_type, r.ref_dist, r.query_dist) for r in got] == [(1000, 1010, 4990, "Insertion", 10, 5000)]


def test_n50(spark):
    df = spark.createDataFrame([(x,) for x in (2, 2, 2, 3, 3, 4, 8, 8, None)], "l bigint")
    r = asm.n50(df, "l").collect()[0]
    assert (r["count"], r.total, r.n50, r["min"], r["max"]) == (8, 32, 8, 2, 8)


def test_pair_flanks(spark):
    data = [("ok", "c", 0, 100, "L", 5), ("ok", "c", 150, 200, "R", 5), ("back", "c", 0, 100, "L", 5), ("back", "c", 90, 200, "R", 5), ("far", "c", 0, 100, "L", 5), ("far", "c", 90_000, 90_100, "R", 5), ("two", "c", 0, 100, "L", 1), ("two", "d", 7, 9, "R", 5), ("alone", "c", 0, 1, "L", 1)]
    df = spark.createDataFrame(data, "id string, chrom string, s bigint, e bigint, side string, v int")
    assert rows(asm.pair_flanks(df, "id", "chrom", "s", "e", "side", "v")) == [("back", "c", 90, 100, "OK"), ("far", "c", None, None, "BAD"), ("ok", "c", 100, 150, "OK"), ("two", "d", 7, 8, "BAD")]


# -- merging, reports, generations ---------------------------------------------------------------------------------------
CALLS = [("c", 100, 101, "A", "1", "x"), ("c", 150, 151, "A", "2", "x"), ("c", 180, 181, "A", "3", "y"), ("c", 900, 901, "A", "4", "y"), ("c", 950, 951, "B", "5", "z"), ("c", 960, 961, "A", "6", "z")]


def test_merge_calls(spark):
    df = spark.createDataFrame(CALLS, "chrom string, start bigint, end bigint, te string, sv_id string, src string")
    # 2 repeats the family of 1 in its cluster, 3 lies near 1; 5 is another family, 6 lies near 4.
    assert {r.sv_id for r in merge_calls(df, "src", ["x", "y", "z"]).collect()} == {"1", "4", "5"}


@pytest.mark.parametrize("missing", ["x", "y", "z"])
def test_merge_without_one_source(spark, missing):
    df = spark.createDataFrame([c for c in CALLS if c[5] != missing], "chrom string, start bigint, end bigint, te string, sv_id string, src string")
    assert {r.src for r in merge_calls(df, "src", ["x", "y", "z"]).collect()} == {"x", "y", "z"} - {missing}


def test_fact_table_prefers_and_falls_back(spark):
    make = spark.createDataFrame
    site = make([("c", 10, 11, "T", "a.INS.1", "+", True), ("c", 20, 21, "T", "a.SOFT.2", "-", None), ("c", 30, 31, "T", "none", "+", None)], "chrom string, start bigint, end bigint, te string, ident string, strand string, cut boolean")
    match = lambda *r: make(list(r), "ident string, pident double, psize_te double, size_el bigint, kind string, support bigint")
    freq = lambda *r: make(list(r), "ident string, freq double, freq_with_clipped double")
    known = report.gathered({
        "combined": (match(("a.INS.1", 99.0, 90.0, 500, "INS", 3)), report.MATCHED), "clipped": (match(("a.INS.1", 1.0, 1.0, 1, "INS", 9), ("a.SOFT.2", 80.0, 50.0, 70, "SOFT", 1), (None, 1.0, 1.0, 1, "INS", 9)), report.MATCHED),
        "duplication": (make([("a.INS.1", "ACGT", 480, 8)], "ident string, tsd string, size_te bigint, new_pos bigint"), ["tsd", "size_te", "new_pos"]),
        "precise": (freq(("a.INS.1", 101.0, 20.0), ("a.SOFT.2", 40.0, 50.0)), ["freq", "freq_with_clipped"]), "base": (freq(("a.INS.1", 90.0, 95.0), ("a.SOFT.2", 1.0, 1.0)), ["freq", "freq_with_clipped"]),
        "size": (make([("a.INS.1", 400), ("a.INS.1", 510)], "ident string, sv_size bigint"), ["sv_size"]),
    }, "ident")
    kind = F.concat(tx.variant_type(F.col("ident")), F.when(F.col("cut"), "_DEL").otherwise(""))
    f = report.fact_table(site, known, report.first_match("combined", "clipped"), report.first_frequency("precise", "base"), F.col("size.sv_size"), report.outsider_id(tx.chain_id), kind)
    got = {r.ident: r for r in f.collect()}
    a, b, c = got["a.INS.1"], got["a.SOFT.2"], got["none"]
    assert (a.tsd, a.pident, a.size_te, a.new_pos, a.freq, a.freq_with_clipped, a.sv_size, a.sv_type) == ("ACGT", 99.0, 480, 8, 90.0, 95.0, 510, "INS_DEL")
    assert a.sv_id.startswith("TE_ID_OUTSIDER.") and a.sv_id.endswith(".INS.3") and b.sv_id == "TE_ID_OUTSIDER.a.SOFT.2"
    assert (b.tsd, b.size_te, b.new_pos, b.freq, b.sv_size, b.sv_type) == (None, 70, 20, 40.0, None, "SOFT")
    assert (c.pident, c.new_pos, c.freq, c.sv_type) == (None, 30, None, None)


def test_first_of(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    s1, s2 = spark.createDataFrame([("a", None, 1)], "id string, v int, w int"), spark.createDataFrame([("a", 5, 5), ("b", 6, 6)], "id string, v int, w int")
    assert rows(report.first_of(base, "id", [s1, s2], ["v", "w"])) == [("a", None, 1), ("b", 6, 6), ("c", None, None)]


def test_frequency_bins(spark):
    df = spark.createDataFrame([("t", v) for v in (0.0, 2.0, 2.1, 100.0, 101.0, None)], "te string, f double")
    assert [r.y for r in report.frequency_bins(df, "te", "f").collect()] == [2, 1, 0, 0, 1]


def test_trends(spark):
    data = [("c:1:T", "G1", 0.1, 0.2), ("c:1:T", "G3", 0.3, 0.2), ("c:1:T", "G5", 0.5, 0.1), ("c:2:T", "G1", 0.1, 0.1)]
    df = spark.createDataFrame([(n.split(":")[0], 1, y1, y2, g, n) for n, g, y1, y2 in data], "chrom string, x bigint, y1 double, y2 double, group string, name string")
    found = gen.trends(df, [("G1", 1), ("G3", 3), ("G5", 5)])
    r = found.collect()[0]
    assert (r.name, r.type1, r.type2, r.gen_inter, r.nb_gen) == ("c:1:T", "+", "-", "G1-G5", 3)
    assert r.sum1 == pytest.approx(0.1 + 10 + 10)
    assert {(x.name, x.type1) for x in gen.with_trends(df, found).collect()} == {("c:1:T", "+"), ("c:2:T", "NONE")}
    assert gen.keep_trends(found, te="T", trend="+", least_generations=3, chrom="c").count() == 1


def test_viewer(spark):
    df = spark.createDataFrame([(11, 60, 1, 50, 100, 200)], "ss bigint, se bigint, qs bigint, qe bigint, sub bigint, que bigint")
    r = viewer.geometry(df, "ss", "se", "qs", "qe", "sub", "que").collect()[0]
    assert (r.strand, r.lead0, r.lead1, r.size0, r.size1, r.posq0, r.posq1) == (1, 50, 25, 245, 122, -50, -25)
    names = spark.createDataFrame([("Roo",), ("copia",), (None,), ("Roo",)], "te string")
    assert rows(viewer.complete(names, "te", ["RO"])) == [("Roo",)] and len(rows(viewer.complete(names, "te", []))) == 2


