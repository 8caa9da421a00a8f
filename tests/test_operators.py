"""Operators on small hand-made tables and against brute force."""

import re
from fractions import Fraction
from itertools import product, takewhile
from math import comb, lgamma, log, log10

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from varigrove.functions import bases as B
from varigrove.operators import calling, cohort, genotyping, joins, mapping, packed, paralogs, reads, recovery, samples, tails, variants
from varigrove.plans import chains


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


READS = "sample string, read_id string, mate int, seq string, qual string"


# -- reads -------------------------------------------------------------------

def test_cycle_quality_of_ragged_reads(spark):
    quals = ["I" * 10 + "#" * 3, "#I#I", "5", "IIII!!!!", "5II5"]
    df = spark.createDataFrame([("s", str(i), 1, "A" * len(q), q) for i, q in enumerate(quals)], READS)
    got = {r.cycle: r for r in reads.cycle_quality(df).collect()}
    assert sorted(got) == list(range(1, 14))
    for cycle, r in got.items():
        values = [ord(q[cycle - 1]) - 33 for q in quals if len(q) >= cycle]
        assert r.bases == len(values)
        assert r.mean_phred == pytest.approx(np.mean(values))
        assert [r.q1, r.median, r.q3] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))


def test_n_content_of_ragged_reads(spark):
    seqs = ["NACGT", "AN", "ACN", "A"]
    df = spark.createDataFrame([("s", str(i), 1, q, "I" * len(q)) for i, q in enumerate(seqs)], READS)
    assert rows(reads.n_content(df).select("cycle", "bases", "n_n"), "cycle") == [
        (1, 4, 1), (2, 3, 1), (3, 2, 1), (4, 1, 0), (5, 1, 0),
    ]


def test_trimming_steps(spark):
    adapter = reads.ADAPTER
    long = "ACGT" * 25
    data = [
        ("s", "both", 1, long, "I" * 100),
        ("s", "both", 2, long[:60] + adapter, "I" * (60 + len(adapter))),
        ("s", "short", 1, long[:40] + adapter, "I" * (40 + len(adapter))),
        ("s", "short", 2, long, "I" * 100),
        ("s", "bad", 1, long, "I" * 59 + "#" * 41),
        ("s", "bad", 2, long, "I" * 60 + "#" * 40),
        ("s", "lone", 1, long, "I" * 100),
    ]
    df = spark.createDataFrame(data, READS)
    assert rows(reads.trim(df).select("read_id", "mate", F.length("seq"), F.length("qual")), "mate") == [
        ("both", 1, 100, 100), ("both", 2, 60, 60),
    ]
    report = reads.trim_report(df).first().asDict()
    assert report["adapter_trimmed"] == 2 and report["low_quality"] == 1 and report["too_short"] == 1
    assert report["mate_lost"] == 3 and report["reads_after"] == 2 and report["bases_after"] == 160
    lost = report["low_quality"] + report["too_short"] + report["mate_lost"]
    assert report["reads_before"] == lost + report["reads_after"]


def test_adapters_are_walked_from_tails(spark):
    """Both mates have their own adapter, read through to different lengths; random reads have none."""
    rng = np.random.default_rng(21)
    draw = lambda n: "".join(rng.choice(list("ACGT"), n))
    adapters = {1: "CTGTCTCTTATACACATCTCCGAGCCC", 2: "GGAATTCTCGGGTGCCAAGGAACTCC"}
    data = []
    for n in range(3000):
        for mate, adapter in adapters.items():
            cut = 100 - int(rng.integers(20, 40)) if n % 5 == 0 else 100
            seq = (draw(cut) + adapter + draw(40))[:100]
            data.append(("s", f"r{n}", mate, seq, "I" * 100))
    df = spark.createDataFrame(data, READS)
    found = {r.mate: r.adapter for r in reads.detect_adapters(df).collect()}
    for mate, adapter in adapters.items():
        # The last bases of a long adapter are reached by few reads.
        assert found[mate] and adapter.startswith(found[mate]) and len(found[mate]) >= 20
    trimmed = {(r.read_id, r.mate): r.seq for r in reads.trim_detected(df).collect()}
    whole = {(d[1], d[2]): d[3] for d in data}
    for (name, mate), seq in trimmed.items():
        at = whole[name, mate].find(found[mate])
        assert at < 0 or seq == whole[name, mate][:at]
    plain = spark.createDataFrame([("s", f"r{n}", 1, draw(100), "I" * 100) for n in range(2000)], READS)
    assert rows(reads.detect_adapters(plain).select("mate", "adapter")) == [(1, None)]
    assert reads.trim_detected(plain).exceptAll(plain).count() == 0
    assert reads.detect_adapters(plain.where("false")).collect() == [] and reads.trim(plain.where("false"), None).collect() == []


def test_pairs(spark):
    data = [("s", "a", 1, "A", "I"), ("s", "a", 2, "C", "I"), ("s", "b", 1, "G", "I"), ("t", "b", 2, "T", "I")]
    df = spark.createDataFrame(data, READS)
    assert rows(reads.pair_mates(df).select("read_id", "seq_1", "seq_2")) == [("a", "A", "C")]
    assert rows(reads.unpaired(df).select("read_id")) == [("b",)]


# -- seeds and alignments ----------------------------------------------------

def test_seed_join_is_the_same_without_broadcast(spark, inputs):
    within = rows(mapping.seed_join(inputs.reads(), inputs.loci()), "read_id", "mate")
    names = ["spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"]
    kept = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        assert rows(mapping.seed_join(inputs.reads(), inputs.loci()), "read_id", "mate") == within
    finally:
        for n in names:
            spark.conf.set(n, kept[n])


def test_packed_seeds_by_brute_force(spark):
    """Reads of all lengths, both strands, repeats and letters that are no bases, against text k-mers."""
    rng = np.random.default_rng(12)
    flip = str.maketrans("ACGT", "TGCA")
    loci = ["".join(rng.choice(list("ACGT"), 60)) for _ in range(6)]
    loci += [loci[0][10:40] * 2, loci[1][:30] + "N" + loci[1][30:], "ACGTA", "A" * 40]
    data = []
    for n in range(150):
        text = loci[rng.integers(len(loci))]
        at, size = rng.integers(0, 25), rng.integers(5, 60)
        read = text[at : at + size]
        read = read[::-1].translate(flip) if rng.integers(2) else read
        data.append(("s", f"r{n}", 1, read + ("", "N", "acgt")[rng.integers(3)], ""))
    k, step = 11, 4
    want = {}
    for _, name, _, seq, _ in data:
        for strand, s in (("+", seq), ("-", seq[::-1].translate(flip))):
            for off in range(0, len(s) - k + 1, step):
                window = s[off : off + k]
                if set(window) <= set("ACGT"):
                    for locus, t in enumerate(loci):
                        for t_off in range(len(t) - k + 1):
                            if t[t_off : t_off + k] == window:
                                key = (locus, t_off - off, strand)
                                want.setdefault(name, {}).setdefault(key, 0)
                                want[name][key] += 1
    best = {}
    for name, found in want.items():
        order = sorted((-n, *key) for key, n in found.items())
        best[name] = (*order[0][1:], -order[0][0], -order[1][0] if len(order) > 1 else 0)
    targets = spark.createDataFrame(list(enumerate(loci)), "locus long, seq string")
    got = mapping.seed_join(spark.createDataFrame(data, READS), targets, k, step)
    assert {r.read_id: (r.locus, r.diag, r.strand, r.score, r.second_score) for r in got.collect()} == best
    with pytest.raises(ValueError):
        mapping.seed_join(spark.createDataFrame(data, READS), targets, 12)


def test_seeds_find_the_right_locus(inputs):
    """Reads without adapter or N have intact seeds."""
    clean = inputs.reads().where("true_locus % 17 != 0 and true_locus % 23 != 0")
    placed = mapping.seed_join(clean, inputs.loci())
    both = clean.join(placed, ["sample", "read_id", "mate"])
    assert both.count() == clean.count()
    assert both.where("locus != true_locus").count() == 0


def test_seed_join_ties_and_short_reads(spark):
    rng = np.random.default_rng(3)
    unit = "".join(rng.choice(list("ACGT"), 80))
    targets = spark.createDataFrame([(1, unit), (2, unit), (3, "ACGT")], "locus long, seq string")
    back = unit[::-1].translate(str.maketrans("ACGT", "TGCA"))
    data = [
        ("s", "fwd", 1, unit[5:65], ""),
        ("s", "rev", 1, back[:60], ""),
        ("s", "short", 1, unit[:30], ""),
        ("s", "none", 1, "N" * 60, ""),
    ]
    got = mapping.seed_join(spark.createDataFrame(data, READS), targets)
    assert rows(got.select("read_id", "locus", "diag", "strand", "score", "second_score"), "read_id") == [
        ("fwd", 1, 5, "+", 2, 2), ("rev", 1, 20, "-", 2, 2),
    ]


ALN = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, pnext long, sum_bq int"


def random_alignments(n=400, seed=4):
    rng = np.random.default_rng(seed)
    cigars = ["20M", "5S15M", "8M3D9M", "4M2I10M3S", "6M40N6M"]
    return [
        (
            str(rng.choice(["s", "t"])),
            f"q{i}",
            int(rng.choice([0, 16, 4, 1024])),
            str(rng.choice(["chr01", "chr02"])),
            int(rng.integers(1, 150)),
            60,
            str(rng.choice(cigars)),
            0,
            int(rng.integers(10, 40)),
        )
        for i in range(n)
    ]


def stretches(pos, cigar):
    import re

    at = pos
    for n, op in re.findall(r"(\d+)([A-Z])", cigar):
        if op == "M":
            yield from range(at, at + int(n))
        if op in "MDN":
            at += int(n)


@pytest.mark.parametrize("block", [4, 16, 1 << 16])
def test_depth_by_brute_force(spark, block):
    data = random_alignments()
    want = {}
    for s, _, flag, rname, pos, _, cigar, _, _ in data:
        if not flag & (4 | 1024):
            for p in stretches(pos, cigar):
                want[s, rname, p] = want.get((s, rname, p), 0) + 1
    got = mapping.depth(spark.createDataFrame(data, ALN), block=block)
    assert {(r.sample, r.rname, r.pos): r.depth for r in got.collect()} == want


def test_depth_track_follows_events(spark):
    """A long read is one row per block and not one per base; its profile weighs rows by length."""
    data = [("s", "q", 0, "c", 1, 60, "100000M", 0, 1), ("s", "r", 0, "c", 50_001, 60, "10M", 0, 1), (None, "n", 0, "c", 5, 60, "3M", 0, 1)]
    track = mapping.depth_track(spark.createDataFrame(data, ALN))
    assert track.count() < 10
    got = {r.sample: r for r in mapping.depth_profile(track, ["sample"]).collect()}
    assert (got["s"].covered, got["s"].max_depth, got["s"].median_depth) == (100_000, 2, 1.0)
    assert got["s"].mean_depth == pytest.approx(1.0001) and got[None].covered == 3
    assert rows(mapping.depth_bounds(track, 2, 9).select("start", "stop")) == [(50_001, 50_010)]


def test_depth_of_an_endless_read(spark):
    """A stretch over many blocks with no event inside."""
    df = spark.createDataFrame([("s", "q", 0, "c", 3, 60, "100M", 0, 1)], ALN)
    assert [(r.pos, r.depth) for r in mapping.depth(df, block=8).orderBy("pos").collect()] == [(p, 1) for p in range(3, 103)]


def test_mark_duplicates_by_brute_force(spark):
    data = random_alignments(600, 5)
    df = spark.createDataFrame(data, ALN)
    got = {r.qname: r.flag for r in mapping.mark_duplicates(df).collect()}
    assert len(got) == len(data)
    five = {r.qname: r.f for r in df.select("qname", B.unclipped_start(F.col("pos"), F.col("cigar"), F.col("flag")).alias("f")).collect()}
    sets = {}
    for s, q, flag, rname, pos, _, _, mate, bq in data:
        if not flag & 4:
            sets.setdefault((s, rname, five[q], flag & 16), []).append((-bq, q))
    best = {min(v)[1] for v in sets.values()}
    for _, q, flag, *_ in data:
        assert bool(got[q] & 1024) == (not flag & 4 and q not in best)
        assert got[q] & ~1024 == flag & ~1024


def test_one_duplicate_set_with_all_reads(spark):
    df = spark.range(2000).select(
        F.lit("s").alias("sample"),
        F.concat(F.lit("q"), F.col("id").cast("string")).alias("qname"),
        F.lit(0).alias("flag"),
        F.lit("c").alias("rname"),
        F.lit(5).cast("long").alias("pos"),
        F.lit(60).alias("mapq"),
        F.lit("10M").alias("cigar"),
        F.lit(0).cast("long").alias("pnext"),
        (F.col("id") % 7).cast("int").alias("sum_bq"),
    )
    metrics = mapping.duplicate_metrics(mapping.mark_duplicates(df)).first()
    assert (metrics.examined, metrics.duplicates) == (2000, 1999)


TEMPLATES = "sample string, library string, qname string, flag int, rname string, pos long, cigar string, sum_bq int"


def brute_duplicates(data):
    """Keys of the templates that are duplicates, by comparing all templates with each other."""
    ends, scores = {}, {}
    for s, lib, q, flag, rname, pos, cigar, bq in data:
        if not flag & (4 | 256 | 2048):
            import re

            ops = [(int(n), op) for n, op in re.findall(r"(\d+)([A-Z])", cigar)]
            lead = sum(n for n, op in ops[:1] if op in "SH")
            tail = sum(n for n, op in ops[-1:] if op in "SH")
            span = sum(n for n, op in ops if op in "MDN")
            five = pos + span - 1 + tail if flag & 16 else pos - lead
            mates = ends.setdefault((s, lib, q), {})
            key = bool(flag & 128)
            mates[key] = min(mates.get(key, (rname, five, bool(flag & 16))), (rname, five, bool(flag & 16)))
            scores[s, lib, q] = scores.get((s, lib, q), 0) + bq
    rank = lambda t: (-scores[t], t[2] or "", t[0] or "")
    out = set()
    for t, mine in ends.items():
        for u, other in ends.items():
            if t == u or t[1] != u[1]:
                continue
            if len(mine) == 2 and len(other) == 2 and sorted(mine.values()) == sorted(other.values()) and rank(u) < rank(t):
                out.add(t)
            if len(mine) == 1:
                end = next(iter(mine.values()))
                if end in other.values() and (len(other) == 2 or rank(u) < rank(t)):
                    out.add(t)
    return out


def test_clips_and_stretches_of_odd_cigars(spark):
    """Records of one stretch are read by a way of their own."""
    cigars = ["20M", "5S15M", "15M5S", "2H3S10=4S1H", "3H7X", "4S2H6M", "3M1I2M", "2S3M1D4M5H", "3M2P4M", "5N", "10I", "*", "", None, "3M4M"]
    df = spark.createDataFrame([(c,) for c in cigars], "cigar string")
    cigar = F.col("cigar")
    for r in df.select(
        "cigar", B.leading_clip(cigar).alias("a"), B.trailing_clip(cigar).alias("z"), B.aligned_blocks(cigar).alias("blocks")
    ).collect():
        if r.cigar is None:
            assert (r.a, r.z, r.blocks) == (None, None, None)
            continue
        ops, at, read, want = re.findall(r"(\d+)([MIDNSHP=X])", r.cigar), 0, 0, []
        for n, op in ((int(n), op) for n, op in ops):
            if op in "M=X":
                want.append((op, n, at, read))
            at += n * (op in "MDN=X")
            read += n * (op in "MIS=X")
        clips = lambda some: sum(int(n) for n, op in takewhile(lambda x: x[1] in "SH", some))
        assert (r.a, r.z) == (clips(ops), clips(ops[::-1]))
        assert [(b.op, b.len, b.ref_off, b.read_off) for b in r.blocks] == want


def test_templates_by_brute_force(spark):
    """Pairs, lone mates, clips, libraries over samples, secondary and unmapped records, names that repeat."""
    rng = np.random.default_rng(8)
    data = []
    for i in range(700):
        s, lib = str(rng.choice(["s", "t"])), (None, "x", "y")[rng.integers(3)]
        kind, at = rng.integers(4), int(rng.integers(1, 60))
        record = lambda flag, pos: (
            s, lib, f"q{i}", int(flag), "c", int(pos) + (5 if clip else 0), "5S15M" if clip else "20M", int(rng.integers(10, 14))
        )
        clip = rng.integers(2)
        if kind != 1:
            data.append(record(1 | 64, at))
        clip = 0
        if kind != 0:
            data.append(record(1 | 128 | 16 | (4 if kind == 2 else 0), at + 100 + int(rng.integers(2))))
        if rng.integers(5) == 0:
            data.append(record(1 | 64 | int(rng.choice([256, 2048])), 900))
    data += [("s", "x", "same", 65, "c", 3, "20M", 40), ("s", "x", "same", 65, "c", 3, "5S15M", 40)] * 2
    data += [("s", "x", "only", 2048, "c", 3, "20M", 40), ("s", None, None, 0, "c", 77, "20M", 1), ("s", None, None, 0, "c", 77, "20M", 1)]
    df = spark.createDataFrame(data, TEMPLATES)
    got = mapping.mark_duplicates(df).collect()
    assert len(got) == len(data)
    twins = brute_duplicates(data)
    assert 100 < len(twins) < 600
    want = sorted((tuple(d[:3]) in twins and not d[3] & 4, d[3], str(d)) for d in data)
    seen = sorted((bool(r.flag & 1024), r.flag & ~1024, str(tuple(r)[:3] + (r.flag & ~1024,) + tuple(r)[4:])) for r in got)
    assert seen == want


def test_templates_are_made_once_for_marking(spark):
    """One aggregate makes templates and one finds the best of all sets, of pairs and of lone mates."""
    marked = mapping.mark_duplicates(spark.createDataFrame([("s", "l", "q", 0, "c", 10, "20M", 30)], TEMPLATES))
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2


def test_records_equal_in_name_flag_and_place_stay_as_many(spark):
    data = [("s", "l", "q", 0, "c", 10, "20M", 30), ("s", "l", "q", 0, "c", 10, "5S15M", 30), ("s", "l", "r", 0, "c", 10, "20M", 9)]
    marked = mapping.mark_duplicates(spark.createDataFrame(data, TEMPLATES))
    assert marked.count() == 3
    assert mapping.mark_duplicates(spark.createDataFrame([], TEMPLATES)).collect() == []


# -- calling -----------------------------------------------------------------

def test_pileup_of_bases(spark):
    df = spark.createDataFrame(
        [("s", "q", 16, "c", 10, 50, "2S3M1I2M1D2M", 0, 1, "TTACGGTTCA", "ABCDEFGHIJ")], ALN + ", seq string, qual string"
    )
    got = calling.pileup(df).select("pos", "read_pos", "base", "bq", "strand")
    assert rows(got, "pos") == [
        (10, 3, "A", 34, 1), (11, 4, "C", 35, 1), (12, 5, "G", 36, 1), (13, 7, "T", 38, 1),
        (14, 8, "T", 39, 1), (16, 9, "C", 40, 1), (17, 10, "A", 41, 1),
    ]
    reference = spark.createDataFrame([("c", "N" * 9 + "ACGTTTCG" + "A" * 30)], "name string, seq string")
    for chunk in (1, 2, 3, 4, 7, 1000):
        placed = calling.pileup_on(df, reference, chunk)
        assert rows(placed.select("pos", "read_pos", "base"), "pos") == [(r[0], r[1], r[2]) for r in rows(got, "pos")]
        assert rows(placed.where("base != ref").select("pos", "ref", "base"), "pos") == [(17, "G", "A")]


@pytest.mark.parametrize("span", [1, 5, 64, 1 << 16])
def test_reference_blocks_do_not_depend_on_the_span(spark, span):
    rng = np.random.default_rng(6)
    calls = pd.DataFrame([(s, c, p) for s in "ab" for c in ("c1", "c2") for p in range(1, 130)], columns=["sample", "chrom", "pos"])
    calls = calls[rng.random(len(calls)) < 0.9].assign(gt=lambda d: rng.choice(["0/0", "0/0", "0/0", "0/0", "0/1"], len(d)))
    calls["gq"] = rng.choice([5, 30, 40, 50, 60, 70], len(calls))
    want = []
    for (s, c), d in calls[calls["gt"] == "0/0"].groupby(["sample", "chrom"]):
        for band, e in (("confident", d[d.gq >= 20]), ("low", d[d.gq < 20])):
            island = (e.pos.diff() != 1).cumsum()
            want += [(s, c, band, int(g.pos.min()), int(g.pos.max()), int(g.gq.min())) for _, g in e.groupby(island)]
    got = calling.reference_blocks(spark.createDataFrame(calls), span=span)
    assert rows(got, *got.columns) == sorted(want)


def exact_fisher(a, b, c, d):
    row, other, col = a + b, c + d, a + c
    weight = {x: comb(row, x) * comb(other, col - x) for x in range(max(0, col - other), min(row, col) + 1)}
    return float(Fraction(sum(w for w in weight.values() if w <= weight[a]), sum(weight.values())))


TABLE = "ref_f long, ref_r long, alt_f long, alt_r long"


def test_fisher_by_brute_force(spark):
    cells = [*product(range(5), repeat=4), (40, 3, 5, 60), (100, 100, 100, 90), (0, 80, 75, 1)]
    for r in calling.fisher_strand(spark.createDataFrame(cells, TABLE)).collect():
        assert 10 ** (-r.fs / 10) == pytest.approx(exact_fisher(*tuple(r)[:4]), rel=1e-6)


def test_fisher_of_a_deep_site(spark):
    got = calling.fisher_strand(spark.createDataFrame([(400_000,) * 4, (500_000, 0, 0, 500_000)], TABLE)).collect()
    assert got[0].fs == pytest.approx(0.0, abs=1e-8)
    # Two tables of C(1,000,000, 500,000) are as extreme.
    each = (lgamma(1_000_001) - 2 * lgamma(500_001)) / log(10)
    assert got[1].fs == pytest.approx(-10 * (log10(2) - each), rel=1e-9)


PILE = "sample string, chrom string, pos long, ref string, base string, bq int, mapq int, strand int, read_pos int"


def test_rank_sum_by_brute_force(spark):
    rng = np.random.default_rng(7)
    data = [("s", "c", int(rng.integers(1, 6)), "A", str(rng.choice(["A", "C"])), 30, int(rng.integers(0, 9)), 0, 1) for _ in range(300)]
    data += [("s", "c", 9, "A", "A", 30, 5, 0, 1)]
    got = {r.pos: r for r in calling.mapq_rank_sum(spark.createDataFrame(data, PILE)).collect()}
    pdf = pd.DataFrame([(d[2], d[4], d[6]) for d in data], columns=["pos", "base", "mapq"])
    for pos, d in pdf.groupby("pos"):
        n1, n0 = int((d.base == "C").sum()), int((d.base == "A").sum())
        if not n1 or not n0:
            assert got[pos].mq_rank_sum is None
            continue
        wins = sum((x > y) + 0.5 * (x == y) for x in d.mapq[d.base == "C"] for y in d.mapq[d.base == "A"])
        z = (wins - n1 * n0 / 2) / (n1 * n0 * (n1 + n0 + 1) / 12) ** 0.5
        assert got[pos].mq_rank_sum == pytest.approx(z)


def pair_likelihoods(piled, alleles):
    """log10 likelihood of every pair of alleles, base by base."""
    out = []
    for j in range(len(alleles)):
        for i in range(j + 1):
            total = 0.0
            for base, q in piled:
                e = min(10 ** (-q / 10), 0.75)
                fits = (base == alleles[i]) + (base == alleles[j])
                total += log10(1 - e) if fits == 2 else log10((1 - e) / 2 + e / 6) if fits == 1 else log10(e / 3)
            out.append(total)
    return out


def test_likelihoods_and_calls(spark):
    data = [("s", "c", 1, "A", "A", 30, 60, 0, 1)] * 4 + [("s", "c", 2, "A", b, 20, 60, 0, 1) for b in "ACAC"]
    data += [("s", "c", 3, "A", "C", 30, 60, 0, 1)] * 3 + [("s", "c", 4, "A", "A", 0, 60, 0, 1)]
    data += [("s", "c", 5, "T", b, 25, 60, 0, 1) for b in "GGCCGN"]
    data += [("s", "c", 6, "T", b, 22, 60, 0, 1) for b in "TGA"]  # 0/1, 0/2 and 1/2 are equal
    likelihoods = genotyping.genotype_likelihoods(spark.createDataFrame(data, PILE))
    one = {r.pos: r for r in likelihoods.collect()}
    for pos, alleles in ((1, ["A", "<NON_REF>"]), (2, ["A", "C"]), (3, ["A", "C"]), (5, ["T", "G", "C"]), (6, ["T", "A", "G"])):
        assert one[pos].alleles == alleles
        mine = [(d[4], d[5]) for d in data if d[2] == pos and d[4] != "N"]
        assert one[pos].gl == pytest.approx(pair_likelihoods(mine, alleles))
        assert one[pos].ad == [sum(b == a for b, _ in mine) for a in alleles] == one[pos].site_ad
    assert all(g is not None for g in one[4].gl)
    got = genotyping.call_genotypes(likelihoods)
    calls = {r.pos: r for r in got.collect()}
    assert [calls[p].gt for p in (1, 2, 3, 5, 6)] == ["0/0", "0/1", "1/1", "1/2", "0/1"]
    assert len(calls[5].pl) == 6 and min(calls[5].pl) == 0
    assert got.agg(F.max("gq")).first()[0] <= 99
    quality = {r.pos: r.qual for r in genotyping.site_quality(likelihoods).collect()}
    assert quality[3] > 60 > quality[1] >= 0
    assert genotyping.genotype_likelihoods(spark.createDataFrame([], PILE)).collect() == []


def test_two_alternatives_at_one_site(spark):
    """Samples that are C/C and G/G at an A site have different genotypes, and the site is not biallelic."""
    data = [(s, "c", 7, "A", b, 30, 60, n % 2, n) for s, b in (("x", "C"), ("y", "G"), (None, "C")) for n in range(6)]
    data += [("x", "c", 8, "A", b, 30, 60, n % 2, n) for n, b in enumerate("ACACAC")]
    piled = spark.createDataFrame(data, PILE)
    calls = genotyping.call_genotypes(genotyping.genotype_likelihoods(piled))
    assert {(r.sample, r.pos): r.gt for r in calls.collect()} == {("x", 7): "1/1", ("y", 7): "2/2", (None, 7): "1/1", ("x", 8): "0/1"}
    none = spark.createDataFrame([], "sample string, chrom string, start long, stop long, gq int")
    joint = {r.pos: r for r in chains.joint_chain(piled, none).collect()}
    assert (joint[7].alleles, joint[7].ac, joint[7].an, joint[7].hom_alt, joint[7].het) == (["A", "C", "G"], [4, 2], 6, 3, 0)
    assert joint[7].af == pytest.approx([2 / 3, 1 / 3]) and joint[8].ac == [1] and joint[8].no_call == 2
    sites = calling.annotate_sites(piled)
    assert rows(sites.select("pos", "alt"), "pos") == [(7, "C,G"), (8, "C")]
    assert rows(chains.site_chain(piled).select("pos", "alt")) == [(8, "C")]


def test_site_quality_is_the_posterior_of_no_alternative(spark):
    """Against the sum over all genotypes of all samples at every frequency."""
    draw = np.random.default_rng(4)
    data = [(s, "c", 1, "A", str(draw.choice(list("AAACCG"))), int(draw.integers(5, 20)), 60, 0, 1) for s in ("x", "y", "z") for _ in range(4)]
    likelihoods = genotyping.genotype_likelihoods(spark.createDataFrame(data, PILE))
    got = genotyping.site_quality(likelihoods).first().qual
    samples_ = likelihoods.collect()
    ad = samples_[0].site_ad
    share = [0.0] + [n / sum(ad[1:]) for n in ad[1:]]
    weights = {}
    for f, prior in [(0.0, 0.999)] + [(f, 0.001 / f / sum(1 / x for x in genotyping.FREQUENCIES)) for f in genotyping.FREQUENCIES]:
        q = [1 - f] + [f * s for s in share[1:]]
        chance = prior
        for r in samples_:
            pairs = [(i, j) for j in range(len(q)) for i in range(j + 1)]
            chance *= sum(10**g * q[i] * q[j] * (1 if i == j else 2) for g, (i, j) in zip(r.gl, pairs))
        weights[f] = chance
    assert got == pytest.approx(-10 * log10(weights[0.0] / sum(weights.values())), abs=1e-6)


def test_joint_cells_use_blocks_and_no_calls(spark):
    calls = spark.createDataFrame([("a", "c", 5, "0/1", 40, 9)], "sample string, chrom string, pos long, gt string, gq int, dp long")
    sites = spark.createDataFrame([("c", 5, "A", ["A", "C", "G"])], "chrom string, pos long, ref string, alleles array<string>")
    schema = "sample string, chrom string, start long, stop long, gq int"
    blocks = spark.createDataFrame([("b", "c", 1, 9, 30), (None, "c", 2, 9, 20)], schema)
    names = spark.createDataFrame([("a",), ("b",), ("d",), (None,)], "sample string")
    cells = calling.joint_cells(calls, sites, names, blocks)
    assert rows(cells.select("sample", "gt", "gq"), "sample") == [
        (None, "0/0", 20), ("a", "0/1", 40), ("b", "0/0", 30), ("d", "./.", None)
    ]
    row = genotyping.joint_genotype(cells, sites).first()
    assert (row.ac, row.an, row.af, row.no_call) == ([1, 0], 6, [1 / 6, 0.0], 1)


def test_chain_from_reads_to_tagged_sites(spark):
    """Aligned reads of two samples, one with a variant, to tagged SNPs."""
    reference = "ACGTTGCAAGGCTTACCGATTGCA"
    changed = reference[:11] + "G" + reference[12:]
    data = []
    for i in range(24):
        for s, seq in (("a", reference), ("b", changed if i % 2 else reference)):
            data.append((s, f"{s}{i}", 65 + 16 * (i // 2 % 2), "c", 1, 60, "24M", 100 + i, 30, seq, "I" * 24))
            data.append((s, f"{s}{i}", 129, "d", 100 + i, 60, "24M", 1, 30, seq, "I" * 24))
    aln = spark.createDataFrame(data, ALN + ", seq string, qual string")
    ref = spark.createDataFrame([("c", reference)], "name string, seq string")
    tagged = chains.site_chain(chains.evidence_chain(aln, ref))
    row = tagged.first()
    assert tagged.count() == 1
    assert (row.pos, row.ref, row.alt) == (12, reference[11], "G")
    assert row["filter"] == "PASS" and row.qual > 30 and row.dp == 48


def test_packed_genotypes_come_back(spark):
    """Seventy samples and one without a name, calls of all kinds, a site without any."""
    rng = np.random.default_rng(9)
    names = [f"s{n:02d}" for n in range(70)] + [None]
    kinds = ["./.", "0/0", "0/1", "1/1", "1/2", "0|1", "2/2", "./1"]
    cells = {("c", int(p), s): str(rng.choice(kinds)) for p in range(1, 30) for s in names if rng.random() < 0.8}
    schema = "chrom string, pos long, sample string, gt string"
    calls = spark.createDataFrame([(*k, v) for k, v in cells.items()] + [("c", 5, "stranger", "1/1")], schema)
    roster = spark.createDataFrame([(s,) for s in names + names[:3]], "sample string")
    sites = spark.createDataFrame([("c", p) for p in range(1, 31)], "chrom string, pos long")
    vectors = packed.pack(calls, roster)
    assert vectors.groupBy("chrom", "pos").count().agg(F.max("count")).first()[0] == 3
    missing = lambda g: g is None or "." in g
    got = {(r.chrom, r.pos, r.sample): r.gt for r in packed.unpack(vectors, roster, sites).collect()}
    assert len(got) == 30 * 71
    assert all(got[k] == (v if not missing(v) or v != "./." else "./.") or missing(v) for k, v in cells.items())
    assert all(v == "./." for k, v in got.items() if k not in cells)
    hom_alt = lambda g: g in ("1/1", "2/2")
    for r in packed.site_counts(vectors, roster).collect():
        mine = [v for k, v in cells.items() if k[1] == r.pos and not missing(v)]
        assert (r.hom_ref, r.hom_alt) == (mine.count("0/0"), sum(map(hom_alt, mine))) and r.missing == 71 - len(mine)
        assert r.het == len(mine) - r.hom_ref - r.hom_alt
    for r in packed.sample_counts(vectors, roster).collect():
        assert r.called == sum(k[2] == r.sample and not missing(v) for k, v in cells.items()) and r.missing == 29 - r.called
    kept = {r.pos for r in packed.missingness_filter(vectors, roster, 0.4).collect()}
    assert kept == {r.pos for r in packed.site_counts(vectors, roster).collect() if r.f_missing <= 0.4}


# -- variants ----------------------------------------------------------------

SITE = "chrom string, pos long, ref string, alt string, qual double, qd double, fs double, sor double, mq double, mqranksum double, readposranksum double, dp long"


def test_hard_filter_limits_are_strict_and_nulls_never_fail(spark):
    data = [
        ("c", 1, "A", "G", 30.0, 2.0, 60.0, 3.0, 40.0, -12.5, -8.0, 305),
        ("c", 2, "A", "G", 29.9, 1.9, 60.1, 3.1, 39.9, -12.6, -8.1, 305),
        ("c", 3, "A", "G", 99.0, 9.0, None, None, None, None, None, 305),
        ("c", 4, "A", "G", None, 1.0, 0.0, 0.0, 60.0, None, None, 305),
    ]
    tagged = variants.hard_filter(spark.createDataFrame(data, SITE))
    every = "QD2;QUAL30;FS60;SOR3;MQ40;MQRankSum-12.5;ReadPosRankSum-8"
    assert rows(tagged.select("filter"), "pos") == [("PASS",), (every,), ("PASS",), ("QD2",)]
    counts = dict(rows(variants.filter_failures(tagged)))
    assert counts == {"QD2": 2, "QUAL30": 1, "FS60": 1, "SOR3": 1, "MQ40": 1, "MQRankSum-12.5": 1, "ReadPosRankSum-8": 1}


def test_a_filter_nobody_fails_is_listed(spark):
    df = spark.createDataFrame([("c", 1, "A", "G", 99.0, 9.0, 0.0, 0.0, 60.0, None, None, 305)], SITE)
    assert {n for _, n in rows(variants.filter_failures(variants.hard_filter(df)))} == {0}


def test_invariants(inputs):
    sites = inputs.sites()
    tagged = variants.hard_filter(sites)
    assert tagged.count() == sites.count()
    snps = chains.tagged_snps(sites)
    assert variants.pass_only(snps).count() + snps.where("pass = 'FAIL'").count() == snps.count()
    ratio = variants.titv(snps).first()
    assert ratio.ti + ratio.tv == snps.count()
    kept = [r.kept for r in cohort.missingness_sweep(inputs.genotypes(), {"chr01": ["chr01"]}).orderBy("threshold").collect()]
    assert kept == sorted(kept)
    marked = mapping.mark_duplicates(inputs.template_records())
    assert marked.count() == inputs.template_records().count()
    contigs = inputs.contigs()
    split = paralogs.clean_loci(contigs).count() + paralogs.paralog_loci(contigs).count()
    assert split == contigs.select("locus").distinct().count()


def test_titv_of_nothing(spark):
    assert tuple(variants.titv(spark.createDataFrame([], SITE)).first()) == (0, 0, None)


# -- cohort ------------------------------------------------------------------

def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v), "P" if v % 2 else "F") for v in (0, 1, 50, 99, 100)], "v double, pass string")
    assert rows(cohort.histogram(df, "v", ["pass"]), "bin", "pass") == [("F", 0, 1), ("P", 1, 1), ("F", 50, 1), ("F", 99, 1), ("P", 99, 1)]
    same = spark.createDataFrame([(5.0, "P")] * 3, "v double, pass string")
    assert rows(cohort.histogram(same, "v", ["pass"])) == [("P", 0, 3)]


def test_density_gaps(spark):
    df = spark.createDataFrame([("chr01", 5, "PASS"), ("chr01", 3_500_000, "FAIL"), ("scaffold_1", 9_000_000, "PASS")], "chrom string, pos long, pass string")
    assert rows(cohort.density_gaps(cohort.snp_density(df)), "window") == [("chr01", 1), ("chr01", 2)]


def test_hash_sample_is_whole_and_repeatable(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    for digits, n in ((1, 777), (4, 777), (2, 0), (2, 5000), (2, 9000)):
        got = sorted(r.k for r in cohort.hash_sample(df, ["k"], n, digits).collect())
        want = sorted(r.k for r in df.orderBy(F.md5(F.col("k").cast("string"))).limit(n).collect())
        assert got == want


def test_run_summary_has_fourteen_columns(inputs):
    df = cohort.run_qc_summary(chains.tagged_snps(inputs.sites()), "first", 61)
    assert df.columns == [
        "run", "date", "n_samples", "raw_snps", "pass_snps", "pct_removed", "titv", "titv_ti", "titv_tv",
        "dp_mean", "dp_median", "dp_sd", "dp_min_filter", "dp_max_filter",
    ]
    assert df.first().dp_min_filter == 305


# -- recovery and paralogs ---------------------------------------------------

CONTIG = "sample string, locus long, contig_no int, exon_len int, supercontig_len int, depth int"


def test_longest_supercontig_ties(spark):
    data = [("b", 1, 1, 9, 50, 1), ("a", 1, 2, 9, 50, 1), ("a", 1, 1, 9, 50, 1), ("a", 2, 1, 9, 70, 1), ("a", 3, 1, 9, 10, 1)]
    clean = spark.createDataFrame([(1,), (3,), (4,)], "locus long")
    got = recovery.longest_supercontig(spark.createDataFrame(data, CONTIG), clean)
    assert rows(got, "locus") == [(1, "a", 1, 50), (3, "a", 1, 10)]


@pytest.mark.parametrize(
    "depths, peaks",
    [
        ([1, 1, 1, 11, 11, 11], 2),  # 3 0 3
        ([1, 1, 1, 6, 11, 11, 11], 2),  # 3 1 3
        ([1, 1, 6, 6, 11, 11], 0),  # 2 2 2, one plateau
        ([1, 1, 6, 6, 11, 11, 11], 0),  # 2 2 3, rising
        ([1, 1, 6, 11], 0),  # 2 1 1
        ([1, 1, 11, 21, 21], 2),  # 2 0 1 0 2, the single one is too low
        ([1, 1, 11, 11, 21, 21], 3),
    ],
)
def test_depth_peaks(spark, depths, peaks):
    df = spark.createDataFrame([("s", 1, i, 9, 9, d) for i, d in enumerate(depths)], CONTIG)
    assert [r.peaks for r in paralogs.paralog_depth(df).collect()] == ([peaks] if peaks else [])


def test_paralog_long_needs_an_extra_long_contig(spark):
    targets = spark.createDataFrame([(1, "A" * 100), (2, "A" * 100), (3, "A" * 100)], "locus long, seq string")
    data = [("s", 1, 1, 90, 0, 0), ("s", 1, 2, 75, 0, 0), ("s", 2, 1, 90, 0, 0), ("s", 2, 2, 74, 0, 0), ("s", 3, 1, 90, 0, 0)]
    got = paralogs.paralog_long(spark.createDataFrame(data, CONTIG), targets)
    assert rows(got) == [("s", 1, 2, 1)]


def test_strict_and_lenient_lists(spark):
    data = [(s, 1, n, 9, 9, 9) for s in "abc" for n in ((1, 2) if s == "a" else (1,))]
    data += [(s, 2, n, 9, 9, 9) for s in "abc" for n in ((1, 2) if s != "a" else (1,))]
    data += [(s, 3, 1, 9, 9, 9) for s in "ab"]
    df = spark.createDataFrame(data, CONTIG)
    assert rows(paralogs.clean_loci(df)) == [(3,)]
    assert rows(paralogs.paralog_loci(df), "locus") == [(1,), (2,)]
    assert rows(paralogs.lenient_loci(df).select("locus", "status"), "locus") == [(1, "clean"), (2, "paralog"), (3, "clean")]
    assert rows(paralogs.copy_counts(df).where("sample = 'c' and locus = 3").select("n")) == [(0,)]


def test_prepare_targets_refuses_a_strange_header(spark):
    good = spark.createDataFrame([("NC_1_ID_7.merged", "ACGT")], "header string, seq string")
    assert rows(recovery.prepare_targets(good).select("header", "locus")) == [("Cajanus_cajan-7", "7")]
    with pytest.raises(ValueError, match="2 targets, but 1"):
        recovery.prepare_targets(good.unionByName(spark.createDataFrame([("dalb_1__p_2", "A")], good.schema)))


def test_reference_totals(spark):
    chrom = [(f"chr{i:02d}", 659_219_136 // 14 + (1 if i <= 659_219_136 % 14 else 0), i) for i in range(1, 15)]
    rest = [(f"scaffold_{i}", 51_323_761 // 972 + (1 if i <= 51_323_761 % 972 else 0), 14 + i) for i in range(1, 973)]
    df = spark.createDataFrame(chrom + rest, "name string, length long, ord int")
    got = {r["class"]: r for r in recovery.assembly_stats(df).collect()}
    assert (got["total"].sequences, got["total"].total_bp) == (986, 710_542_897)
    assert (got["chromosome"].sequences, got["scaffold"].sequences) == (14, 972)
    assert round(got["chromosome"].percent) == 93


def test_recovered_matrix_has_a_mean_row(spark):
    targets = spark.createDataFrame([(1, "A" * 100), (2, "A" * 60)], "locus long, seq string")
    df = spark.createDataFrame([("s", 1, 1, 40, 50, 1)], CONTIG)
    assert rows(recovery.seq_lengths(df, targets, "gene", targets), "sample", "locus") == [
        ("MeanLength", 1, 100.0), ("MeanLength", 2, 60.0), ("s", 1, 40.0), ("s", 2, 0.0),
    ]


# -- samples -----------------------------------------------------------------

def test_reconcile(spark):
    schema = "path string, checksum string"
    source = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], schema)
    dest = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], schema)
    status = samples.reconcile(source, dest)
    assert rows(status, "path") == [("a", "same"), ("b", "changed"), ("c", "missing"), ("d", "extra")]
    assert samples.reconcile_verdict(status).first().safe_to_remove is False
    assert samples.reconcile_verdict(samples.reconcile(source, source)).first().safe_to_remove is True


def test_undetermined_samples_get_no_read_group(inputs):
    got = samples.read_groups(inputs.samples())
    assert got.where("sm like 'Undet%'").count() == 0
    assert got.count() < inputs.samples().count()


# -- records as aligners write them -------------------------------------------

RECORD = "sample string, qname string, flag int, rname string, pos long, mapq int, cigar string, pnext long, sum_bq int, seq string, qual string"


def records(spark):
    """Two lone reads without a sample on a clean locus, and what must not count."""
    rows = [
        (None, "a", 0, "c", 1, 60, "4M", 0, 10, "ACGT", "IIII"),
        (None, "b", 16, "c", 1, 60, "4M", 9, 20, "ACgN", "IIII"),
        (None, "b", 256, "c", 1, 60, "4M", 9, 20, "*", "*"),
        (None, "c", 512, "c", 1, 60, "4M", 0, 20, "TTTT", "IIII"),
        (None, "d", 0, "c", 1, 60, "4M", 7, 20, None, None),
    ]
    return spark.createDataFrame(rows, RECORD)


def test_only_evidence_is_piled_up(spark):
    reference = spark.createDataFrame([("c", "acgtn")], "name string, seq string")
    piled = calling.pileup_on(records(spark), reference)
    seen = sorted((r.pos, r.ref, r.base, r.strand) for r in piled.collect())
    assert seen == [(1, "A", "A", 0), (1, "A", "A", 1), (2, "C", "C", 0), (2, "C", "C", 1), (3, "G", "G", 0), (3, "G", "G", 1), (4, "T", "T", 0)]
    assert genotyping.candidate_sites(genotyping.genotype_likelihoods(piled)).count() == 0
    depth = {r.pos: r.depth for r in mapping.depth(records(spark)).collect()}
    assert depth == {1: 2, 2: 2, 3: 2, 4: 2}


def test_null_samples_keep_pairs_lengths_and_reports(spark):
    data = [(s, "r", m, "ACGT" * 20, "I" * 80) for s in (None, "x") for m in (1, 2)] + [(None, "lone", 1, "ACGT" * 20, "I" * 80)]
    df = spark.createDataFrame(data, READS)
    assert rows(reads.pair_mates(df).select("sample", "read_id"), "sample") == [(None, "r"), ("x", "r")]
    assert rows(reads.unpaired(df).select("sample", "read_id")) == [(None, "lone")]
    assert rows(reads.cohort_qc(df).select("sample", "reads"), "sample") == [(None, 3), ("x", 2)]
    contigs = spark.createDataFrame([(None, 1, 1, 30, 40, 5), ("x", 2, 1, 50, 60, 5)], "sample string, locus long, contig_no int, exon_len int, supercontig_len int, depth int")
    loci = spark.createDataFrame([(1,), (2,)], "locus long")
    assert rows(recovery.seq_lengths(contigs, loci, "gene"), "sample", "locus") == [(None, 1, 30.0), (None, 2, 0.0), ("x", 1, 0.0), ("x", 2, 50.0)]
    assert rows(paralogs.copy_counts(contigs), "sample", "locus") == [(None, 1, 1), (None, 2, 0), ("x", 1, 0), ("x", 2, 1)]


def test_null_samples_are_a_sample(spark):
    primary = records(spark).where("flag in (0, 16) and seq is not null")
    marked = mapping.mark_duplicates(primary)
    assert {r.qname: r.flag for r in marked.collect()} == {"a": 0, "b": 16}
    twice = primary.where("qname = 'a'").unionByName(primary.where("qname = 'a'").selectExpr("sample", "'z' as qname", "flag", "rname", "pos", "mapq", "cigar", "pnext", "5 as sum_bq", "seq", "qual"))
    assert {r.qname: r.flag for r in mapping.mark_duplicates(twice).collect()} == {"a": 0, "z": 1024}
    assert calling.pileup(marked).count() == 7


def test_samples_of_blocks_are_in_the_roster(spark):
    rows = [(s, "c", 5, "A", b, 40, 60, 0, 9) for s in (1, 2, 3) for b in "CC"]
    piled = spark.createDataFrame(rows, "sample int, chrom string, pos long, ref string, base string, bq int, mapq int, strand int, read_pos int")
    blocks = spark.createDataFrame([(4, "c", 1, 9, 50), (5, "c", 6, 9, 50), (1, "c", 1, 9, 50)], "sample int, chrom string, start long, stop long, gq int")
    one = chains.joint_chain(piled, blocks).first()
    assert (one.called, one.no_call, one.hom_alt, one.ac, one.an) == (4, 1, 3, [6], 8)
    mapped = chains.joint_chain(piled, blocks, spark.createDataFrame([(9,)], "sample int")).first()
    assert (mapped.called, mapped.no_call) == (4, 2)


def test_a_reference_is_cut_in_one_pass(spark):
    """Pieces far from the start of a contig hold its letters."""
    reference = spark.createDataFrame([("c", "ACGT" * 5000)], "name string, seq string")
    aln = spark.createDataFrame([(1, "a", 0, "c", 15_001, 60, "8M", 0, 10, "ACGTACGT", "IIIIIIII")], RECORD.replace("sample string", "sample int"))
    piled = calling.pileup_on(aln, reference)
    assert [(r.pos, r.ref) for r in piled.orderBy("pos").collect()] == [(15_001 + n, "ACGT"[n % 4]) for n in range(8)]


@pytest.mark.parametrize(
    ("seq", "left"),
    [
        ("CCCC" + reads.ADAPTER + "TTTT", "CCCC"),  # whole, inside
        ("CCCC" + reads.ADAPTER, "CCCC"),
        ("CCCC" + reads.ADAPTER[:20], "CCCC"),  # as far as the read goes
        ("CCCC" + reads.ADAPTER[:4], "CCCC"),
        ("CCCC" + reads.ADAPTER[:3], "CCCC" + reads.ADAPTER[:3]),  # too little to tell
        ("CCCC" + reads.ADAPTER[:12] + "TTTT", "CCCC" + reads.ADAPTER[:12] + "TTTT"),  # a chance match
        ("AGAT" + "C" * 10 + reads.ADAPTER[:9], "AGAT" + "C" * 10),
        (reads.ADAPTER, ""),
    ],
)
def test_adapter_is_compared_whole(spark, seq, left):
    df = spark.createDataFrame([(seq, "I" * len(seq))], "seq string, qual string")
    assert reads.trim_adapter(df).first().seq == left and len(reads.trim_adapter(df).first().qual) == len(left)


def test_manifest_of_named_loci(spark):
    df = spark.createDataFrame([("b7", 30), ("a10", 20), ("c", 5)], "locus string, length int")
    got = [tuple(r) for r in recovery.reference_manifest(df).orderBy("offset").collect()]
    assert got == [("a10", 20, 0, 20), ("b7", 30, 20, 50), ("c", 5, 50, 55)]


def test_grids_hold_every_pair_and_are_not_moved(spark):
    contigs = spark.createDataFrame(
        [(s, l, 1, 10 * (l or 5) + 1, 90, 5) for s, l in ((None, 1), ("a", 1), ("a", 2), ("b", 2), ("a", None), ("b", 9))],
        "sample string, locus long, contig_no int, exon_len int, supercontig_len int, depth int",
    )
    # Locus 2 is listed twice, locus 3 is in no contig and locus 9 in no list.
    loci = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "locus long")
    cells = {(None, 1): 11.0, ("a", 1): 11.0, ("a", 2): 21.0, ("b", 2): 21.0}
    want = sorted(((str(s), str(l), cells.get((s, l), 0.0)) for s in (None, "a", "b") for l in (1, 2, 2, 3)))
    got = recovery.seq_lengths(contigs, loci, "gene").where("locus is not null")
    assert sorted((str(r.sample), str(r.locus), r.bp) for r in got.collect()) == want
    nulls = recovery.recovered_lengths(contigs, "gene").where("locus is null").select("sample", "bp")
    for shard_rows in (1, 2, 100):
        grid = joins.filled_grid(loci, recovery.sample_list(contigs), recovery.recovered_lengths(contigs, "gene"), "locus", "sample", shard_rows)
        assert grid.count() == 15
        assert rows(grid.where("locus is null and bp is not null").select("sample", "bp")) == rows(nulls)
    # No shuffle or sort above the generators that make the cells.
    for grid in (recovery.seq_lengths(contigs, loci, "gene"), paralogs.copy_counts(contigs)):
        text = grid._jdf.queryExecution().executedPlan().toString()
        assert "Generate" in text and "Exchange" not in text[: text.index("Generate explode(array_except")]


def test_seed_join_never_broadcasts_the_kmers(spark):
    """Few targets as their rows count, many k-mers; one shuffle serves the scores and the window."""
    reads_ = spark.createDataFrame([("s", "r", 1, "ACGTTGCA" * 12, "I" * 96)], READS)
    targets = spark.createDataFrame([(1, "ACGTTGCA" * 16)], "locus long, seq string")
    placed = mapping.seed_join(reads_, targets)
    text = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert text[: text.index("SortMergeJoin")].count("Exchange") == 1
    assert [(r.locus, r.score) for r in placed.collect()] == [(1, 3)]


def test_cycle_bases_gathers_reads_by_file(spark):
    """A crowded file and a null one beside many small ones; rows per base are counted where they are made."""
    data = [(None, "n", 1, "ACN", "III")] + [("crowded", f"r{i}", 1, "AC"[i % 2] + "GTx", "IIII") for i in range(300)]
    data += [(f"s{i}", "r", 2, "T", "I") for i in range(150)]
    got = reads.cycle_bases(spark.createDataFrame(data, READS))
    seen = {(r.sample, r.cycle): (r.bases, r.n_a, r.n_c, r.n_g, r.n_t, r.n_n) for r in got.collect()}
    assert len(seen) == 3 + 4 + 150 and got.count() == len(seen)
    assert [seen[None, c] for c in (1, 2, 3)] == [(1, 1, 0, 0, 0, 0), (1, 0, 1, 0, 0, 0), (1, 0, 0, 0, 0, 1)]
    assert seen["crowded", 1] == (300, 150, 150, 0, 0, 0) and seen["crowded", 4] == (300, 0, 0, 0, 0, 0)
    assert seen["s7", 1] == (1, 0, 0, 0, 1, 0)
    text = got._jdf.queryExecution().executedPlan().toString()
    above = text[: text.index("Generate posexplode")]
    # Counts of whole files, not of the share of a task, go through the last shuffle.
    assert above.count("Exchange") == 1 and above.count("HashAggregate") == 4


def test_bases_below_counts_letters_at_every_bound(spark):
    every = "".join(map(chr, range(33, 127)))
    df = spark.createDataFrame([(every,), ("",), (None,), ("II#4 5",)], "qual string")
    for least in (1, 2, 20, 60, 94):
        col = B.bases_below(F.col("qual"), least)
        below = sum(33 <= ord(c) < 33 + least for c in "II#4 5")
        assert [r[0] for r in df.select(col).collect()] == [least, 0, None, below]
        assert "regexp" not in str(col)


def test_quality_filter_cuts_a_read_once(spark):
    """The plan's filter holds the pattern for the test and for the cut, and not for each mention of the qualities."""
    data = [("s", "good", 1, "ACGT" * 5, "I" * 20), ("s", "bad", 1, "ACGT" * 5, "#" * 9 + "I" * 11), ("s", "edge", 1, "ACGT" * 5, "#" * 8 + "I" * 12)]
    data += [("s", "null", 1, "ACGT", None), ("s", "empty", 1, "", ""), ("s", "tail", 1, "ACGT" + reads.ADAPTER, "IIII" + "#" * 30)]
    kept = reads.quality_filter(reads.trim_adapter(spark.createDataFrame(data, READS)))
    assert {r.read_id: r.seq for r in kept.collect()} == {"good": "ACGT" * 5, "edge": "ACGT" * 5, "empty": "", "tail": "ACGT"}
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter" in x]
    assert sum(x.count("regexp_instr") for x in filters) <= 2


def test_adapter_is_the_commonest_kmer_of_all_tails(spark):
    """Against a count of every k-mer, with ties, short, empty, missing and non-ASCII reads, a null mate, and k-mers crowded in few buckets."""
    rng = np.random.default_rng(5)
    draw = lambda n: "".join(rng.choice(list("ACGN"), n))
    texts = [draw(int(rng.integers(0, 60))) for _ in range(300)] + [None, "", "é" * 14, "ACGé" * 9, "acgtacgtacgta"]
    data = [("s", f"r{i}", (1, 2, None)[i % 3], t, "I") for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, READS)
    for k, tail in ((2, 30), (12, 30), (5, 8)):
        counts = {}
        for _, _, mate, text, _ in data:
            end = (text or "")[-tail:]
            for i in range(len(end) - k + 1):
                key = (mate, end[i : i + k])
                counts[key] = counts.get(key, 0) + 1
        wanted = {}
        for (mate, kmer), n in counts.items():
            wanted[mate] = min(wanted.get(mate, (0, "")), (-n, kmer))
        got = {r.mate: (-r.n, r.kmer) for r in reads.detect_adapter(df, k, tail).collect()}
        assert got == wanted
    assert reads.detect_adapter(df.where("false")).collect() == []


def test_rare_kmers_are_no_rows(spark):
    """Tails of random reads have as many k-mers as letters; only those of common buckets leave the tasks."""
    rng = np.random.default_rng(6)
    data = [("s", f"r{i}", 1, "".join(rng.choice(list("ACGT"), 30)) + "CTGTCTCTTATA" * (i % 2), "I") for i in range(2000)]
    df = spark.createDataFrame(data, READS)
    held = tails.bucket_counts(df, 12, 30)
    assert held[1][0] == 2000 and held[1][1].sum() == 2000 * 19
    common = tails.kmers_of(df, {1: held[1][1] >= 500}, 12, 30)
    assert common.count() < 50 and common.where("kmer = 'CTGTCTCTTATA'").first().n == 1000


def test_adapter_is_looked_for_once(spark):
    """Cutting, filters on the cut columns and all: the pattern stands once in the plan."""
    df = spark.createDataFrame([("s", "r", 1, "ACGT", "IIII")], READS)
    plan = reads.length_filter(reads.quality_filter(reads.trim_adapter(df)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_instr") == 1


def test_cycle_quality_gathers_files_before_runs(spark):
    """The groups of a file, cycle and value are made where the file is, so no task holds those of all files."""
    df = spark.createDataFrame([(f"s{i}", f"r{i}", 1, "ACGT", "II##") for i in range(20)], READS)
    plan = reads.cycle_phred_counts(df)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate") :]
    assert "RepartitionByExpression" in below[below.rindex("Generate explode") :]
    got = rows(reads.cycle_quality(df).select("cycle", "bases", "mean_phred").distinct(), "cycle")
    assert got == [(1, 1, 40.0), (2, 1, 40.0), (3, 1, 2.0), (4, 1, 2.0)]


def test_packing_does_not_sort_cells(spark):
    """Bits of a site are combined in a hash aggregate; calls that bits do not tell come back too, at null places also."""
    cells = [("c", 1, "a", "0/1"), ("c", 1, "b", "1|2"), (None, 2, "a", "0|1"), (None, None, None, "2/2"), ("c", 3, "b", None)]
    calls = spark.createDataFrame(cells, "chrom string, pos long, sample string, gt string")
    roster = calls.select("sample").distinct()
    vectors = packed.pack(calls, roster)
    plan = vectors._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" in plan.replace("ObjectHashAggregate", "") and "bit_or" in plan
    assert not any("ObjectHash" in line and "bit_or" in line for line in plan.splitlines())
    back = {tuple(r) for r in packed.unpack(vectors, roster).where("gt <> './.'").collect()}
    assert back == {c for c in cells if c[3]}


def test_bases_on_a_reference_are_counted_where_they_are(spark):
    """Crowded and other contigs give one row per position and base, and no rows per base are moved."""
    many = [(f"s{i % 3}", "hot", 1 + i % 4, 0, 60, "5M", "ACGTA", "IIIII") for i in range(300)]
    few = [(None, f"c{i}", 2, 0, 60, "3M", "CgT", "I#I") for i in range(20)]
    aln = spark.createDataFrame(many + few, "sample string, rname string, pos long, flag int, mapq int, cigar string, seq string, qual string")
    names = [("hot", "acgtacgt")] + [(f"c{i}", "TCGTT") for i in range(20)]
    piled = calling.pileup_on(aln, spark.createDataFrame(names, "name string, seq string"), chunk=4)
    got = rows(calling.base_counts(piled), "chrom", "pos", "ref", "base")
    by_row = piled.groupBy("chrom", "pos", "ref", "base").agg(F.count("*"), F.sum("bq"), F.count("sample"))
    assert got == rows(by_row, "chrom", "pos", "ref", "base") and sum(r[4] for r in got) == 300 * 5 + 20 * 3
    own = piled.groupBy("chrom", "piece", "salt", "pos", "ref", "base").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in own[: own.index("Generate")]


def test_reads_are_dealt_out_as_short_lines(spark, inputs):
    """Lines become reads in as many tasks as there are shuffle partitions, however well lines pack."""
    plan = inputs.reads()._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
