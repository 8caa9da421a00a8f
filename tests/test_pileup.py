"""Bases of the pileup come from texts that are cut once a stretch."""

from varigrove.operators import calling

ALN = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, seq string, qual string"


def test_pileup_on_cuts_texts_once(spark):
    """Short and missing texts, lower case, clips, a deletion, letters that are no bases and a read beyond the reference."""
    data = [
        ("s", "plain", 0, "c", 2, 9, "4M", "aCGt", "IJKL"),
        ("s", "clip", 0, "c", 3, 9, "1S2M1D1M", "TGTC", "#$%&"),
        (None, "short", 0, "c", 1, 9, "4M", "AC", "I"),
        ("s", "no qualities", 0, "c", 5, 9, "2M", "AA", None),
        ("s", "no bases", 0, "c", 5, 9, "2M", None, "II"),
        ("s", "star", 0, "c", 5, 9, "2M", "*", "*"),
        ("s", "beyond", 16, "c", 9, 9, "4M", "ANßG", "1234"),
    ]
    aln = spark.createDataFrame(data, ALN)
    ref = spark.createDataFrame([("c", "acGtACNTACg")], "name string, seq string")
    for chunk in (3, 1000):
        piled = calling.pileup_on(aln, ref, chunk)
        text = piled._jdf.queryExecution().executedPlan().toString()
        assert "substring" not in text[: text.index("Generate")]
        got = {(r.pos, r.ref, r.base, r.bq, r.read_pos, r.strand, r.sample) for r in piled.collect()}
        assert got == {
            (2, "C", "A", 40, 1, 0, "s"), (3, "G", "C", 41, 2, 0, "s"), (4, "T", "G", 42, 3, 0, "s"), (5, "A", "T", 43, 4, 0, "s"),
            (3, "G", "G", 3, 2, 0, "s"), (4, "T", "T", 4, 3, 0, "s"), (6, "C", "C", 5, 4, 0, "s"),
            (1, "A", "A", 40, 1, 0, None), (2, "C", "C", -33, 2, 0, None),
            (5, "A", "A", None, 1, 0, "s"), (6, "C", "A", None, 2, 0, "s"),
            (9, "A", "A", 16, 1, 1, "s"),
        }
        counts = {(r.pos, r.base): (r.bases, r.quality, r.named) for r in calling.base_counts(piled).collect()}
        assert counts[5, "A"] == (1, None, 1) and counts[1, "A"] == (1, 40, 0) and counts[2, "C"] == (1, -33, 0) and len(counts) == 12
