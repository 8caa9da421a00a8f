"""Readers and writers on tiny files of each shape."""

import gzip

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from varigrove.sources import alignments, fasta, fastq, tables, vcf
from varigrove.streaming import resume


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def record(name, seq, qual):
    return f"@{name}\n{seq}\n+\n{qual}\n"


BASE = "Plant_2013_110_LIB250009714-1A_FLOW1_L2"


def test_fastq(spark, tmp_path):
    # A quality may start with @ or +, like a header or a separator.
    gz(tmp_path / f"{BASE}_1.fq.gz", record("r1 1:N", "ACGT", "@III") + record("r2/1", "ACGTA", "+IIII"))
    gz(tmp_path / f"{BASE}_2.trim.fq.gz", record("r1 2:N", "TT", "##"))
    got = fastq.read_fastq(spark, str(tmp_path / "*.gz"))
    assert rows(got.select("sample", "mate", "read_no", "read_id", "seq", "qual"), "mate", "read_no") == [
        ("Plant_2013_110", 1, 0, "r1", "ACGT", "@III"),
        ("Plant_2013_110", 1, 1, "r2", "ACGTA", "+IIII"),
        ("Plant_2013_110", 2, 0, "r1", "TT", "##"),
    ]
    assert got.select("base").distinct().collect()[0][0] == BASE


def test_fastq_over_many_batches(spark, tmp_path):
    n = 25_001  # more lines than one Arrow batch holds
    gz(tmp_path / "s_1.fq.gz", "".join(record(f"r{i}", "ACGT", "IIII") for i in range(n)))
    got = fastq.read_fastq(spark, str(tmp_path))
    assert got.agg(F.count("*"), F.count_distinct("read_id"), F.max("read_no")).first() == (n, n, n - 1)


def test_fastq_refuses_broken_and_plain_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    gz(tmp_path / "a" / "x_1.fq.gz", "@r\nACGT\n+\n")
    with pytest.raises(Exception, match="ends inside a record"):
        fastq.read_fastq(spark, str(tmp_path / "a")).collect()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x_1.fq").write_text(record("r", "A", "I"))
    with pytest.raises(ValueError, match="gzip"):
        fastq.read_fastq(spark, str(tmp_path / "b"))


def test_land_reads(spark, tmp_path):
    gz(tmp_path / "s_1.fq.gz", record("r1", "ACGT", "IIII"))
    fastq.land_reads(fastq.read_fastq(spark, str(tmp_path)), str(tmp_path / "out"), files=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">one first\nACGT\nAC\r\n>two\nTTT\n\n>empty\n")
    got = fasta.read_fasta(spark, str(tmp_path / "x.fasta")).select("header", "seq")
    assert rows(got, "header") == [("empty", ""), ("one first", "ACGTAC"), ("two", "TTT")]


def test_write_fasta(spark, tmp_path):
    df = spark.createDataFrame(
        [("7", "s1", "ACGT"), ("7", "s2", "AC"), ("8", "s1", "TT")], "locus string, header string, seq string"
    )
    fasta.write_fasta(df, str(tmp_path / "all"))
    assert fasta.read_fasta(spark, str(tmp_path / "all")).count() == 3
    fasta.write_fasta(df, str(tmp_path / "by"), by="locus")
    seven = fasta.read_fasta(spark, str(tmp_path / "by" / "locus=7")).select("header", "seq")
    assert rows(seven, "header") == [("s1", "ACGT"), ("s2", "AC")]


def test_names(spark, tmp_path):
    df = spark.createDataFrame([("7",), ("243",)], "locus string")
    fasta.write_names(df, "locus", str(tmp_path / "n"))
    assert rows(fasta.read_names(spark, str(tmp_path / "n")), "name") == [("243",), ("7",)]


SAM = (
    "@HD\tVN:1.6\n"
    "q1\t99\tchr01\t10\t60\t2S3M\t=\t40\t35\tGGACG\tII5#I\tRG:Z:Plant_2013_110_FLOW1_L2\n"
    "q2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\t##\n"
)


def test_sam(spark, tmp_path):
    (tmp_path / "x.sam").write_text(SAM)
    got = alignments.read_sam(spark, str(tmp_path / "x.sam"))
    assert rows(got.select("qname", "flag", "rname", "pos", "rnext", "sample", "sum_bq"), "qname") == [
        ("q1", 99, "chr01", 10, "chr01", "Plant_2013_110", 140),
        ("q2", 4, "*", 0, "*", None, 0),
    ]
    alignments.write_alignments(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_index(spark, tmp_path):
    (tmp_path / "r.fai").write_text("chr01\t100\t7\t60\t61\nchr02\t50\t120\t60\t61\n")
    assert rows(alignments.read_index(spark, str(tmp_path / "r.fai")), "ord") == [("chr01", 100, 7), ("chr02", 50, 120)]


VCF = (
    "##fileformat=VCFv4.2\n"
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\n"
    "chr01\t5\t.\tA\tG,T\t50.5\tPASS\tQD=10.5;MQ=60;DB\tGT:DP:PL\t0/1:7:1,2,3\t./.:.:.\n"
    "chr01\t9\trs1\tC\tT\t.\tQD2;FS60\tQD=1;DP=44\tGT\t1/1\t0/0\n"
)


def test_vcf(spark, tmp_path):
    gz(tmp_path / "x.vcf.gz", VCF)
    sites = vcf.read_vcf(spark, str(tmp_path / "x.vcf.gz"))
    assert rows(sites.select("pos", "id", "alt", "qual", "filter", "qd", "mq", "mqranksum", "dp"), "pos") == [
        (5, None, "G,T", 50.5, "PASS", 10.5, 60.0, None, None),
        (9, "rs1", "T", None, "QD2;FS60", 1.0, None, None, 44),
    ]
    names = vcf.sample_columns(spark, str(tmp_path / "x.vcf.gz"))
    calls = vcf.genotypes(sites, names).select("pos", "sample", "gt", "dp", "pl")
    assert rows(calls, "pos", "sample") == [
        (5, "s1", "0/1", 7, "1,2,3"),
        (5, "s2", "./.", None, None),
        (9, "s1", "1/1", None, None),
        (9, "s2", "0/0", None, None),
    ]


def test_write_vcf(spark, tmp_path):
    gz(tmp_path / "x.vcf.gz", VCF)
    src = str(tmp_path / "x.vcf.gz")
    sites = vcf.read_vcf(spark, src)
    calls = vcf.genotypes(sites, vcf.sample_columns(spark, src))
    out = str(tmp_path / "out")
    vcf.write_vcf(sites, out, calls)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    lines = text.splitlines()
    assert lines[0] == "##fileformat=VCFv4.2"
    assert lines[1].split("\t")[-3:] == ["FORMAT", "s1", "s2"]
    assert [x.split("\t")[1] for x in lines[2:]] == ["5", "9"]
    assert lines[2].split("\t")[-2:] == ["0/1", "./."]
    again = vcf.read_vcf(spark, out)
    assert rows(again.select("pos", "alt", "qd", "filter"), "pos") == rows(sites.select("pos", "alt", "qd", "filter"), "pos")


def test_write_vcf_without_samples(spark, inputs, tmp_path):
    from varigrove.operators import variants

    sites = variants.hard_filter(inputs.sites())
    vcf.write_vcf(sites, str(tmp_path / "v"))
    assert vcf.read_vcf(spark, str(tmp_path / "v")).count() == sites.count()


def test_annotations(spark, tmp_path):
    head = "#[1]CHROM\t[2]POS\n"
    (tmp_path / "a.tsv").write_text(head + "chr01\t5\t50.5\tPASS\t1.5\t.\t0.7\t60\t.\t-0.3\t305\n")
    got = vcf.read_annotations(spark, str(tmp_path / "a.tsv"))
    assert rows(got) == [("chr01", 5, 50.5, "PASS", 1.5, None, 0.7, 60.0, None, -0.3, 305)]


def test_export_annotations(spark, inputs, tmp_path):
    from varigrove.operators import variants

    tagged = variants.hard_filter(inputs.sites())
    vcf.export_annotations(tagged, str(tmp_path / "a"))
    again = spark.read.csv(str(tmp_path / "a"), sep="\t", header=True, schema=vcf.ANNOTATIONS, nullValue=".")
    assert again.count() == tagged.count()
    assert again.where("MQRankSum is null").count() == tagged.where("mqranksum is null").count() > 0


STATS = (
    "# comment\nSN\t0\tnumber of samples:\t61\nSN\t0\tnumber of records:\t13662332\n"
    "TSTV\t0\t9000\t4500\t2.00\t9000\t4500\t2.00\n"
)


def test_stats_report(spark, tmp_path):
    (tmp_path / "s.txt").write_text(STATS)
    assert rows(vcf.read_titv(spark, str(tmp_path / "s.txt"))) == [(9000.0, 4500.0, 2.0)]
    assert rows(vcf.read_summary_number(spark, str(tmp_path / "s.txt"), "number of records")) == [(13662332,)]
    (tmp_path / "none.txt").write_text("# nothing\n")
    assert rows(vcf.read_titv(spark, str(tmp_path / "none.txt"))) == [(None, None, None)]


def test_matrix(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("Species\t7271\t24.3\ns1\t1\t2\ns2\t0\t1\n")
    got = tables.read_matrix(spark, str(tmp_path / "m.tsv"))
    assert rows(got, "sample", "locus") == [("s1", "24.3", 2), ("s1", "7271", 1), ("s2", "24.3", 1), ("s2", "7271", 0)]
    tables.write_matrix(got.where("locus != '24.3'"), str(tmp_path / "w"))
    assert rows(tables.read_matrix(spark, str(tmp_path / "w")), "sample") == [("s1", "7271", 1), ("s2", "7271", 0)]


def test_matrix_text(spark, tmp_path):
    """Blank cells at every place, repeats, null names, one header in each file."""
    data = [("s", "b", 2), ("s", "d", 4), ("t", "a", 1), ("t", "a", 9), ("u", "c", 3), (None, "d", 5), ("u", None, 7), ("v", "e", None)]
    long = spark.createDataFrame(data, "sample string, locus string, n int")
    lines = {r.line: r.header for r in tables.matrix_lines(long).collect()}
    assert lines == {
        "sample\ta\tb\tc\td\te": True, "s\t\t2\t\t4\t": False, "t\t9\t\t\t\t": False, "u\t\t\t3\t\t": False, "\t\t\t\t5\t": False
    }
    path = str(tmp_path / "m")
    tables.write_matrix(long, path, parts=3)
    files = [f.read_text().splitlines() for f in (tmp_path / "m").glob("part-*")]
    assert sum(map(len, files)) == 4 + 3 and all(not f or f[0].startswith("sample\ta") for f in files)
    assert rows(tables.read_matrix(spark, path), "sample", "locus") == [
        (None, "d", 5), ("s", "b", 2), ("s", "d", 4), ("t", "a", 9), ("u", "c", 3)
    ]
    tables.write_matrix(long.where("false"), str(tmp_path / "none"))
    assert tables.read_matrix(spark, str(tmp_path / "none")).collect() == []


def test_runs(spark, tmp_path):
    df = spark.createDataFrame([(5, 1.5)], "raw long, pct double")
    for run in ("a", "b"):
        tables.append_run(df, str(tmp_path / "r"), run)
    got = tables.read_runs(spark, str(tmp_path / "r"), "run string, raw long, pct double")
    assert rows(got, "run") == [("a", 5, 1.5), ("b", 5, 1.5)]


def test_cohort_table_is_written_once(spark, tmp_path):
    df = spark.createDataFrame([("s", "chr01", 1, 9)], "sample string, chrom string, start long, stop long")
    tables.create_cohort(df, str(tmp_path / "c"))
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        tables.create_cohort(df, str(tmp_path / "c"))
    # A region reads its own folder only.
    plan = spark.read.parquet(str(tmp_path / "c")).where("chrom = 'chr01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(chrom" in plan


def test_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a_1.fq.gz").write_bytes(b"12345")
    (tmp_path / "sub" / "b.txt").write_bytes(b"1")
    got = tables.manifest(spark, str(tmp_path))
    assert sorted(r.size for r in got.collect()) == [1, 5]
    assert tables.manifest(spark, str(tmp_path), "*.gz").count() == 1


def test_sample_map(spark, tmp_path):
    df = spark.createDataFrame([("s1", "x/s1.g.vcf.gz")], "sample string, path string")
    tables.write_sample_map(df, str(tmp_path / "m"))
    assert rows(tables.read_sample_map(spark, str(tmp_path / "m"))) == [("s1", "x/s1.g.vcf.gz")]


def test_only_new_files_are_landed(spark, tmp_path):
    src, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    schema = "sample string, n long"
    row = lambda s: spark.createDataFrame([(s, 1)], schema)
    row("a").write.parquet(src)
    double = lambda df: df.withColumn("n", F.col("n") * 2)
    resume.land_new_files(spark, src, schema, out, mark, double)
    resume.land_new_files(spark, src, schema, out, mark, double)
    row("b").write.mode("append").parquet(src)
    resume.land_new_files(spark, src, schema, out, mark, double)
    assert rows(spark.read.parquet(out), "sample") == [("a", 2), ("b", 2)]


def test_vcf_has_contigs_in_the_order_of_the_genome(spark, tmp_path):
    sites = spark.createDataFrame(
        [("chr10", 5, "A", "C", 30.0), ("chr2", 9, "A", "G", 31.0), ("chr2", 3, "C", "T", 32.0), ("other", 1, "G", "A", 33.0)],
        "chrom string, pos long, ref string, alt string, qual double",
    )
    calls = spark.createDataFrame(
        [(f"s{n:03d}", "chr2", 9, "0/1") for n in range(0, 300, 2)] + [("s001", "chr10", 5, None), ("s300", "chr10", 5, "1/1")],
        "sample string, chrom string, pos long, gt string",
    )
    genome = spark.createDataFrame([("chr2", 500, 1), ("chr10", 400, 2)], "name string, length int, rank int")
    vcf.write_vcf(sites, str(tmp_path / "v"), calls, contigs=genome)
    lines = [line for f in sorted((tmp_path / "v").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[1:3] == ["##contig=<ID=chr2,length=500>", "##contig=<ID=chr10,length=400>"]
    names = lines[3].split("\t")[9:]
    assert names == sorted({*(f"s{n:03d}" for n in range(0, 300, 2)), "s001", "s300"})
    body = [x.split("\t") for x in lines[4:]]
    assert [x[:2] for x in body] == [["chr2", "3"], ["chr2", "9"], ["chr10", "5"], ["other", "1"]]
    assert body[1][9:] == ["./." if n in ("s001", "s300") else "0/1" for n in names]
    assert body[2][9:] == ["1/1" if n == "s300" else "./." for n in names] and set(body[0][9:]) == {"./."}


def test_wide_matrix_has_one_plan(spark, tmp_path):
    """50,000 loci: no column for each, and every cell comes back."""
    long = spark.range(200_000).selectExpr("id % 40 as sample", "concat('locus', (id * 7919) % 50000) as locus", "id as n")
    tables.write_matrix(long, str(tmp_path / "wide"), parts=4)
    got = tables.read_matrix(spark, str(tmp_path / "wide"))
    want = long.groupBy(F.col("sample").cast("string"), "locus").agg(F.max("n").alias("n"))
    assert got.count() == want.count() and got.exceptAll(want.select("sample", "locus", "n")).count() == 0


def test_matrix_packed_on_disk(spark, tmp_path):
    """A matrix of few cells: the file is far smaller than its tabs, and the shuffle holds no lines."""
    long = spark.range(3000).selectExpr("id % 300 as sample", "(id * 7919) % 2000 as locus", "id as n")
    for kind in ("none", "gzip"):
        path = tmp_path / kind
        tables.write_matrix(long, str(path), parts=4, compression=kind)
        got = tables.read_matrix(spark, str(path)).selectExpr("cast(sample as long) sample", "cast(locus as long) locus", "n")
        want = long.groupBy("sample", "locus").agg(F.max("n").alias("n"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    size = {k: sum(f.stat().st_size for f in (tmp_path / k).glob("part-*")) for k in ("none", "gzip")}
    assert size["none"] > 300 * len(set(range(2000))) * 0.9 and size["gzip"] < size["none"] / 5


def test_vcf_cells_are_packed(spark, tmp_path):
    """Over two longs: plain, other, missing and repeated calls give the cells that the first text of each sample tells."""
    names = [f"s{n:02d}" for n in range(20)]
    texts = ["./.", "0/0", "0/1", "1/1", "0|1", "1/2", None, "."]
    cells = [("c", pos, name, texts[(i * 3 + pos) % 8]) for pos in (1, 2, 3) for i, name in enumerate(names) if (i + pos) % 5]
    cells += [("c", pos, name, texts[(i + pos * 3) % 8]) for pos in (1, 2) for i, name in enumerate(names) if i % 3 == 0]
    sites = spark.createDataFrame([("c", p, "A", "G", 1.0) for p in (3, 1, 4, 2)], "chrom string, pos long, ref string, alt string, qual double")
    calls = spark.createDataFrame(cells, "chrom string, pos long, sample string, gt string")
    wanted = {}
    for _, pos, name, gt in sorted(cells, key=lambda c: (c[3] is not None, c[3] or "")):
        wanted.setdefault((pos, name), gt or "./.")
    path = str(tmp_path / "v")
    vcf.write_vcf(sites, path, calls)
    lines = [x for f in sorted((tmp_path / "v").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x.split("\t")[1] for x in lines if x[0] != "#"] == ["1", "2", "3", "4"]
    got = vcf.genotypes(vcf.read_vcf(spark, path), vcf.sample_columns(spark, path)).collect()
    assert {(r.pos, r.sample): r.gt for r in got} == {(p, n): wanted.get((p, n), "./.") for p in (1, 2, 3, 4) for n in names}
    plan = vcf._cells(calls, calls.agg(F.sort_array(F.collect_set("sample")).alias("names")))._jdf.queryExecution().sparkPlan().toString()
    assert not any("ObjectHash" in x and "bit_and" in x for x in plan.splitlines())
