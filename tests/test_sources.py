import gzip

from pyspark.sql import functions as F

from helixframe.sources import formats, sinks


def put(path, text):
    path.write_text(text)
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_fasta_and_gzip(spark, tmp_path):
    a = put(tmp_path / "a.fa", ">r1 first\nACGT\nAC\n>empty\n>r2\r\nTT\r\n")
    with gzip.open(tmp_path / "b.fa.gz", "wt") as f:
        f.write(">r3\nG\nG\n")
    assert rows(formats.fasta(spark, [a, str(tmp_path / "b.fa.gz")])) == [("r1", "ACGTAC"), ("r2", "TT"), ("r3", "GG")]
    assert ("r1 first", "ACGTAC") in rows(formats.fasta(spark, a, first_word=False))
    assert rows(formats.numbered_fasta(spark, put(tmp_path / "u.fa", ">x\nA\n>y\nC\n>z\nG\n"))) == [(0, "A"), (1, "C"), (2, "G")]
    assert rows(formats.unitig_lengths(spark, put(tmp_path / "len", "7 0\n9 31\nq 40\n"))) == [(0, 0), (1, 31), (2, 40)]


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "T")], "name string, seq string")
    sinks.fasta_lines(df, columns=4).write.text(str(tmp_path / "out"))
    assert rows(formats.fasta(spark, str(tmp_path / "out"))) == [("a", "ACGTACGTAC"), ("b", "T")]


def test_fastq(spark, tmp_path):
    p = put(tmp_path / "x.fq", "@r1 c\nAC\nGT\n+\n@II\nI\n@r2\nT\n+r2\n>\n>f\nCC\nC\n")
    assert rows(formats.fastq(spark, p, wrapped=True)) == [("f", "CCC", ""), ("r1", "ACGT", "@III"), ("r2", "T", ">")]


def test_fastq_lines(spark, tmp_path):
    """Records of four lines, qualities that start with @ or +, Windows line ends."""
    p = put(tmp_path / "x.fq", "@r1 c\nACGT\n+\n@III\n@r2\nT\n+r2\n>\n@r3\r\nGG\r\n+\r\n+@\r\n@r4\nA\n+\n@\n")
    assert rows(formats.fastq(spark, [p, put(tmp_path / "y.fq", "@s\nC\n+\n@")])) == [("r1", "ACGT", "@III"), ("r2", "T", ">"), ("r3", "GG", "+@"), ("r4", "A", "@"), ("s", "C", "@")]


def test_coords_round_trip(spark, tmp_path):
    p = put(tmp_path / "c", "junk\n>1 pb\n339 452 33 137 22 19 20 64 65 8520 137 1.11185 302.084 0.727273 116700F_68092F 13:41 6:34 15:57\n>2 q\n1 2 3 4 5 6 7 8 9 10 11 1.0 0.0 0.0 1F\n")
    got = formats.coords(spark, p)
    r = got.where("read = 'pb'").first()
    assert (r.r_start, r.q_end, r.stretch, r.frag, r.kmers_info, r.bases_info, r.complete) == (339, 137, 1.11185, "116700F_68092F", [13, 6, 15], [41, 34, 57], True)
    assert not got.where("read = 'q'").first().complete
    sinks.coords_lines(got).write.text(str(tmp_path / "back"))
    assert rows(formats.coords(spark, str(tmp_path / "back")).drop("complete")) == rows(got.drop("complete"))
    assert formats.merged_coords([got, got]).count() == 4


def test_tables(spark, tmp_path):
    m = formats.show_coords(spark, put(tmp_path / "s", "  1 100 | 5 104 | 100 100 | 99.50 | 1000 2000 | 10.00 5.00 | ctg rd\n")).first()
    assert (m.rs, m.qe, m.mlen, m.idy, m.rlen, m.ref, m.qry) == (1, 104, 100, 99.5, 1000, "ctg", "rd")
    p = formats.paf(spark, put(tmp_path / "p", "r1\t900\t0\t800\t-\tc1\t5000\t4000\t4900\t700\t900\t60\ttp:A:P\tdv:f:0.05\n"))
    assert p.first().tags == {"tp": "P", "dv": "0.05"}
    x = formats.paf_as_matches(formats.paf_overhanging(p, 600, 60, 200)).first()
    assert (x.rs, x.re, x.qs, x.qe, round(x.idy, 6), x.cov_r, x.cov_q) == (4001, 4900, 800, 1, 95.0, 18.0, 88.88)
    assert formats.paf_overhanging(p, 600, 60, 50).count() == 0
    v = rows(formats.vcf(spark, put(tmp_path / "v", "#h\nc\t7\t.\tA\tC\t9\t.\t.\tGT\t1:2\nc\t8\t.\tA\tC,G\t9\t.\t.\tGT\t1:2\n")))
    assert v == [("c", 7, "A", "C", ["1", "2"])]
    sam = put(tmp_path / "sam", "@SQ\tSN:c1\tLN:99\n@RG\tID:g7\nr\t0\tc1\t5\t60\t4M\t*\t0\t0\tACGT\nz\t0\tc1\t5\t3\t4M\t*\t0\t0\tACGT\n")
    assert rows(formats.sam_header(spark, sam)) == [("RG", "g7", None), ("SQ", "c1", 99)]
    assert rows(formats.sam(spark, sam, 10)) == [("r", 0, "c1", 5, 60, "ACGT")]
    b = formats.bed(spark, put(tmp_path / "bed", "track x\nc1 5 9\nc1 50 60\n"))
    sizes = spark.createDataFrame([("c1", 100)], "ctg string, len long")
    assert rows(formats.bed_near_ends(b, sizes, 20)) == [("c1", 5, 9)]
    bl = formats.blast6(spark, put(tmp_path / "bl", "a\ta\t99\t50\t0\t0\t1\t50\t1\t50\na\ta\t99\t50\t0\t0\t1\t50\t901\t950\na\tb\t80\t50\t0\t0\t1\t50\t1\t50\n"))
    assert [r.rs for r in formats.self_hits(bl, 95).collect()] == [901]
    d = formats.delta(spark, put(tmp_path / "d", "/a /b\nNUCMER\n>r1 q1 100 50\n1 40 2 41 3 3 0\n-5\n0\n50 60 1 11 0 0 0\n0\n"))
    assert rows(d) == [("r1", "q1", 100, 50, 1, 40, 2, 41, 3), ("r1", "q1", 100, 50, 50, 60, 1, 11, 0)]
    assert formats.links(spark, put(tmp_path / "l", "a 1 F b 2 R -7 acgt\na 1 F c 2 R 7\n")).orderBy("gap").first().seq == "acgt"
    assert rows(formats.placements(spark, put(tmp_path / "pl", "r s 5 F\n"))) == [("r", "s", 5, "F")]
    assert rows(formats.positions(spark, put(tmp_path / "pos", "p w 1 9 f\n"))) == [("p", "w", 1, 9, "f")]
    assert rows(formats.node_hits(spark, put(tmp_path / "n", "CONTIG\t3\tc\t5\nNODE_HITS\t1\t7:4,8:2\nNODE_HITS\t2\t7:4\nNODE\t1\ta.L\ta.R\n"))) == [(1, 7, 4), (1, 8, 2)]


def test_sinks(spark):
    hits = spark.createDataFrame([(1, 2, 5, 9, True), (1, 2, 3, -4, False)], "read long, frag long, r_off int, q_off int, member boolean")
    assert sinks.details_lines(hits).first().value == "1 2 3:-4 [5:9]"
    mega = spark.createDataFrame([(1.005, 9.5, 1, 9, 2, 8, 7, 0.5, "1F_2R", 10)], "imp_s double, imp_e double, r_start int, r_end int, q_start int, q_end int, score int, density double, path string, path_len int")
    assert sinks.mega_read_lines(mega).first().value.split()[1:] == ["9.50", "1", "9", "2", "8", "7", "0.5000", "1F_2R", "10"]
    nodes = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "key int, node int, label string")
    edges = spark.createDataFrame([(1, 0, 1, True)], "key int, src int, dst int, on_path boolean")
    assert sinks.dot_lines(nodes, edges).first().value == 'digraph g1 {\n  n0 [label="a"];\n  n1 [label="b"];\n  n0 -> n1 [color="red"];\n}'
    seqs = spark.createDataFrame([("s", "ANCGTACGTA")], "name string, seq string")
    assert [(r.part, r.seq) for r in sinks.frg_windows(seqs, 6, 4).orderBy("part").collect()] == [(0, "AACGTA"), (1, "TACGTA")]
    record = sinks.frg_lines(sinks.frg_windows(seqs, 6, 4).where("part = 0"), "L").first().value
    assert "seq:\nAACGTA\n" in record and "qlt:\nXDDDDL\n" in record and "clr:0,6" in record
    pieces = spark.createDataFrame([("r", 0, "A" * 900), ("r", 2000, "C" * 900), ("r", 5000, "C" * 900), ("q", 0, "A" * 9)], "read string, pos int, seq string")
    assert [(r.library, r.insert) for r in sinks.mate_pairs(pieces).collect()] == [(3, 2900)]
    e = spark.createDataFrame([(1, 2, 0.5, True, False), (2, 3, 1.0, True, True)], "a int, b int, score double, in_tree boolean, in_trunk boolean")
    assert [r.value for r in sinks.cytoscape_lines(e).collect()] == ["1,2,0.5000,MST", "2,3,1.0000,TRUNK"]
    reads = spark.createDataFrame([("a",), ("b",)], "name string")
    joins = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "name string, batch int")
    assert rows(sinks.route_to_batches(reads, joins)) == [("a", 1), ("a", 2)]
    assert sinks.in_group_files(spark.range(100).select((F.col("id") % 10).alias("g")), "g", 3).rdd.getNumPartitions() == 3
