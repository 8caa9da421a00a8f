"""Files of queries that are written to be read back are packed; qualities are summed run by run."""

import glob
from types import SimpleNamespace

from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.plans import queries
from varigrove.sources import vcf


def packed_only(path):
    names = [n for n in glob.glob(f"{path}/*") if not n.rsplit("/", 1)[1].startswith("_")]
    return names and all(n.endswith(".gz") for n in names)


def test_sam_file_is_packed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sam")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: path)
    data = [("q", 7, "r", 5, 60, 16, "2M", "AC", "I#"), ("p", None, "r", 6, 0, 0, "1M", "*", "*")]
    aln = spark.createDataFrame(data, "qname string, sample long, rname string, pos long, mapq int, flag int, cigar string, seq string, qual string")
    got = queries.sam_file(SimpleNamespace(spark=spark, target_alignments=lambda: aln))
    first = got.where("pos = 5").first()
    assert (first.rname, first.flag, first.cigar, first.rnext, first.seq, first.qual, first.sum_bq) == ("r", 16, "2M", "r", "AC", "I#", 40)
    assert got.count() == 2 and packed_only(path)


def test_vcf_genotypes_file_is_packed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "vcf")
    monkeypatch.setattr(queries, "scratch_path", lambda *_: path)
    columns = "chrom string, pos long, ref string, alt string, qual double, qd double, fs double, sor double, mq double, mqranksum double, readposranksum double, dp long"
    sites = spark.createDataFrame([("c", i, "A", "G", 1.5, 1.0, 1.0, 1.0, 1.0, None, None, 3) for i in range(40)], columns)
    calls = spark.createDataFrame([("c", i, s, ("0/0", "0/1", "./.", "0|2")[(i + (s or 0)) % 4]) for i in range(40) for s in (3, None)], "chrom string, pos long, sample long, gt string")
    got = queries.vcf_genotypes_file(SimpleNamespace(spark=spark, sites=lambda: sites, genotypes=lambda: calls))
    want = {(r.chrom, r.pos, None if r.sample is None else str(r.sample), r.gt) for r in calls.collect()}
    assert {tuple(r) for r in got.collect()} == want and packed_only(path)
    # Plain text where nothing is said.
    vcf.write_vcf(sites, str(tmp_path / "plain"))
    assert not glob.glob(f"{tmp_path}/plain/*.gz")


def test_phred_sum_goes_by_runs(spark):
    texts = ["I", "III###", "!~5454!!", "a\nb\n\n", "éé😀😀x", "I" * 40 + "#" * 3]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "qual string")
    col = B.phred_sum(F.col("qual"))
    assert [r[0] for r in df.select(col).collect()] == [sum(ord(c) - 33 for c in t) for t in texts] + [None]
    assert "transform" not in str(col)
