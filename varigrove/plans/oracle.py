"""Oracle SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

import re

from varigrove.plans.inputs import INPUT_SQL

_RULES = {
    "QD2": "qd < 2",
    "QUAL30": "qual < 30",
    "FS60": "fs > 60",
    "SOR3": "sor > 3",
    "MQ40": "mq < 40",
    "MQRankSum-12.5": "mqranksum < -12.5",
    "ReadPosRankSum-8": "readposranksum < -8",
}
_LABELS = {
    "QD2": "QD < 2.0",
    "QUAL30": "QUAL < 30.0",
    "FS60": "FS > 60.0",
    "SOR3": "SOR > 3.0",
    "MQ40": "MQ < 40.0",
    "MQRankSum-12.5": "MQRankSum < -12.5",
    "ReadPosRankSum-8": "ReadPosRankSum < -8.0",
}
_ANY_FAIL = "(" + " or ".join(f"coalesce({c}, false)" for c in _RULES.values()) + ")"
_TAG = (
    "coalesce(nullif(concat_ws(';', "
    + ", ".join(f"case when {c} then '{n}' end" for n, c in _RULES.items())
    + "), ''), 'PASS')"
)
_SNP = "length(ref) = 1 and not regexp_matches(alt, '[A-Z]{2}')"
_BI = "position(',' in alt) = 0"
_TI = "ref || alt in ('AG', 'GA', 'CT', 'TC')"

# Views built on the inputs; a query names what it needs.
def _between(value: str, p: float) -> str:
    """The quantile of rows that hold their rank `rn` from 0 and their number `n`; equal neighbours give their value."""
    low = f"max({value}) filter (rn = floor({p} * (n - 1)))"
    high = f"max({value}) filter (rn = ceil({p} * (n - 1)))"
    return f"{low} + ({high} - {low}) * (max({p} * (n - 1)) - floor(max({p} * (n - 1))))"


_RANKED_DP = "(select dp, count(*) over () as n, row_number() over (order by dp) - 1 as rn from fx_sites where dp is not null)"

_VIEWS = {
    **INPUT_SQL,
    "v_tagged_all": f"select *, {_TAG} as filter from fx_sites",
    "v_tagged": f"""
        select *, case when filter = 'PASS' then 'PASS' else 'FAIL' end as pass
        from v_tagged_all where {_SNP} and {_BI}""",
    "v_long": """
        select chrom, pos, pass, annotation, value from (
          select chrom, pos, pass, unnest(['QD','FS','SOR','MQ','MQRankSum','ReadPosRankSum']) as annotation,
            unnest([qd, fs, sor, mq, mqranksum, readposranksum]) as value from v_tagged)
        where value is not null""",
    "v_long_clipped": """
        select l.* from v_long l join (
          select annotation, """ + _between("value", 0.005) + " as lo, " + _between("value", 0.995) + """ as hi
          from (select annotation, value, count(*) over (partition by annotation) as n,
                  row_number() over (partition by annotation order by value) - 1 as rn from v_long where value is not null)
          group by annotation) b on l.annotation = b.annotation
        where l.value >= b.lo and l.value <= b.hi""",
    "v_runs": f"""
        select 'first' as run, count(*) as raw_snps, count(*) filter (not {_ANY_FAIL}) as pass_snps
        from fx_sites where {_SNP} and {_BI}
        union all
        select 'second', count(*), count(*) filter (not {_ANY_FAIL})
        from fx_sites where {_SNP} and {_BI} and dp between 610 and 3000""",
    "v_run_table": """
        select run, raw_snps, pass_snps, round_even((raw_snps - pass_snps) / raw_snps * 100.0, 2) as pct_removed
        from v_runs""",
    "v_cut": """
        select * exclude (place, whole, left_over) replace (
          case when place > 0 then left(seq, place - 1) else seq end as seq, case when place > 0 then left(qual, place - 1) else qual end as qual),
          length(seq) as len_before
        from (
          select *, case when whole > 0 and (left_over is null or whole < left_over) then whole else coalesce(left_over, 0) end as place
          from (
            select *, strpos(seq, 'AGATCGGAAGAGCACACGTCTGAACTCCAG') as whole,
              list_min([length(seq) - n + 1 for n in range(4, 31)
                        if right(seq, n) = left('AGATCGGAAGAGCACACGTCTGAACTCCAG', n) and length(seq) >= n]) as left_over
            from fx_reads))""",
    # Test qualities hold 'I' (40) and '#' (2) only.
    "v_judged": """
        select *, case when (length(qual) - length(replace(qual, '#', ''))) * 100 > 40 * length(qual) then 'quality'
                       when length(seq) < 50 then 'length' end as why from v_cut""",
    "v_kept": """
        select *, why is null and count(distinct case when why is null then mate end)
          over (partition by sample, read_id) = 2 as kept from v_judged""",
    "v_other_kept": """
        select *, why and count(distinct case when why then mate end) over (partition by sample, read_id) = 2 as kept from (
          select *, (length(qual) - length(replace(qual, '#', ''))) * 100 <= 40 * length(qual) and length(seq) >= 50 as why from (
            select * exclude (place, whole, left_over) replace (
              case when place > 0 then left(seq, place - 1) else seq end as seq, case when place > 0 then left(qual, place - 1) else qual end as qual)
            from (
              select *, case when whole > 0 and (left_over is null or whole < left_over) then whole else coalesce(left_over, 0) end as place
              from (
                select *, strpos(seq, 'CTGTCTCTTATACACATCTCCGAGCCCACG') as whole,
                  list_min([length(seq) - n + 1 for n in range(4, 31)
                            if right(seq, n) = left('CTGTCTCTTATACACATCTCCGAGCCCACG', n) and length(seq) >= n]) as left_over
                from fx_other_reads))))""",
    "v_cycles": """
        select sample, mate, i as cycle, substr(seq, i, 1) as base, ascii(substr(qual, i, 1)) - 33 as phred
        from (select sample, mate, seq, qual, unnest(range(1, length(seq) + 1)) as i from fx_reads)""",
    "v_seeds": """
        select t.sample, t.read_id, t.mate, locus, strand, toff - roff as diag, count(*) as score
        from (select sample, read_id, mate, strand, roff, substr(s, cast(roff + 1 as int), 31) as kmer from (
                select sample, read_id, mate, strand, s, unnest(range(0, length(s) - 30, 23)) as roff from (
                  select sample, read_id, mate, '+' as strand, seq as s from fx_reads
                  union all
                  select sample, read_id, mate, '-', reverse(translate(seq, 'ACGTN', 'TGCAN')) from fx_reads))) t
        join (select locus, toff, substr(seq, cast(toff + 1 as int), 31) as kmer from (
                select locus, seq, unnest(range(0, length(seq) - 30)) as toff from fx_loci)) k
          on t.kmer = k.kmer
        group by all""",
    "v_windows": """
        select t.sample, t.read_id, t.mate, locus, strand, toff - roff as diag, count(*) as score
        from (select sample, read_id, mate, strand, roff, substr(s, cast(roff + 1 as int), 31) as kmer from (
                select sample, read_id, mate, strand, s, unnest(range(0, length(s) - 30)) as roff from (
                  select sample, read_id, mate, '+' as strand, seq as s from fx_reads
                  union all
                  select sample, read_id, mate, '-', reverse(translate(seq, 'ACGTN', 'TGCAN')) from fx_reads))) t
        join (select locus, toff, substr(seq, cast(toff + 1 as int), 31) as kmer from (
                select locus, seq, unnest(range(0, length(seq) - 30)) as toff from fx_loci)) k
          on t.kmer = k.kmer
        group by all""",
    "v_placed": """
        select sample, read_id, mate, locus, diag, strand, score,
          coalesce(lead(score) over w, 0) as second_score, row_number() over w as rn
        from v_windows window w as (partition by sample, read_id, mate order by score desc, locus, diag, strand)""",
    "v_ends": """
        select sample, library, qname, (flag & 128) <> 0 as snd, sum_bq,
          {'rname': rname, 'five': case when (flag & 16) = 0 then pos - (case when cigar like '5S%' then 5 else 0 end)
                                        else pos + (case when cigar = '95M5S' then 95 else 100 end) - 1
                                          + (case when cigar = '95M5S' then 5 else 0 end) end, 'rev': (flag & 16) <> 0} as e
        from fx_template_records where (flag & 2308) = 0""",
    "v_named": """
        select sample, library, qname, least(max(e) filter (not snd), max(e) filter (snd)) as lo,
          case when count(distinct snd) = 2 then greatest(max(e) filter (not snd), max(e) filter (snd)) end as hi, sum(sum_bq) as score
        from v_ends group by sample, library, qname""",
    "v_twins": """
        select sample, library, qname, row_number() over (partition by library, lo, hi order by score desc, qname, sample) > 1 as twin
        from v_named where hi is not null
        union all
        select f.sample, f.library, f.qname, p.e is not null or row_number() over (partition by f.library, f.lo order by score desc, f.qname, f.sample) > 1
        from (select * from v_named where hi is null) f
        left join (select distinct library, unnest([lo, hi]) as e from v_named where hi is not null) p
          on f.library is not distinct from p.library and f.lo = p.e""",
    "v_marked": """
        select r.* replace (case when twin and (flag & 4) = 0 then flag | 1024 else flag end as flag)
        from fx_template_records r left join v_twins t
          on r.sample = t.sample and r.qname = t.qname and r.library is not distinct from t.library""",
    "v_metrics": """
        select sample, library, count(*) filter ((flag & 2308) = 0) as examined, count(*) filter ((flag & 2316) = 0) as in_pairs,
          count(*) filter ((flag & 3332) = 1024) as duplicates, count(*) filter ((flag & 2304) <> 0) as secondary_or_supplementary,
          count(*) filter ((flag & 2308) = 4) as unmapped
        from v_marked group by sample, library""",
    "v_bases": """
        select sample, rname, pos + i as rpos, (flag & 16) // 16 as strand, mapq,
          i + (case when cigar like '5S%' then 5 else 0 end) + 1 as read_pos
        from (select *, unnest(range(0, case when cigar like '5S%' then 95 else 100 end)) as i
              from fx_alignments where (flag & 4) = 0)""",
    "v_alleles": """
        select chrom, pos, ref, coalesce(list(base order by n desc, base) filter (base <> ref), ['<NON_REF>']) as alts,
          coalesce(list(n order by n desc, base) filter (base <> ref), [0]) as alt_ad, coalesce(sum(n) filter (base = ref), 0) as ref_ad
        from (select chrom, pos, ref, base, count(*) as n from fx_pileup group by all) group by chrom, pos, ref""",
    "v_pairs": """
        select *, list_concat([ref], alts)[i + 1] as a, alts[j] as b, j * (j + 1) // 2 + i as g,
          case when i = 0 then 0.0 when list_sum(alt_ad) = 0 then 1.0 else alt_ad[i] / list_sum(alt_ad) end as share_a,
          case when j = 0 then 0.0 when list_sum(alt_ad) = 0 then 1.0 else alt_ad[j] / list_sum(alt_ad) end as share_b
        from (select *, unnest(range(0, j + 1)) as i from (select *, unnest(range(0, len(alts) + 1)) as j from v_alleles))""",
    "v_gl": """
        select p.sample, p.chrom, p.pos, p.ref, alts, g, i, j, share_a, share_b, count(*) as dp,
          sum(case when i = j and base = a then log10(1 - e) when i <> j and base in (a, b) then log10((1 - e) / 2 + e / 6)
              else log10(e / 3) end) as l
        from (select *, least(pow(10.0, -bq / 10.0), 0.75) as e from fx_pileup) p
        join v_pairs v on p.chrom = v.chrom and p.pos = v.pos group by all""",
    "v_calls": """
        select sample, chrom, pos, ref, array_to_string(alts, ',') as alt, max(dp) as dp,
          arg_min(i || '/' || j, case when round(m - l, 9) = 0 then g else 99 end) as gt,
          least(list_sort(list(cast(round((m - l) * 10) as int)))[2], 99) as gq,
          array_to_string(list(cast(round((m - l) * 10) as int) order by g), ',') as pl
        from (select *, max(l) over (partition by sample, chrom, pos) as m from v_gl) group by sample, chrom, pos, ref, alts""",
    "v_ad": """
        select sample, p.chrom, p.pos, count(*) filter (base <> p.ref) as alt_dp, count(*) as dp,
          list_concat([count(*) filter (base = p.ref)], list_transform(any_value(alts), lambda x: len(list_filter(list(base), lambda y: y = x)))) as ad
        from fx_pileup p join v_alleles a on p.chrom = a.chrom and p.pos = a.pos group by sample, p.chrom, p.pos""",
    "v_candidates": """
        select a.chrom, a.pos, ref, alts, max(alt_dp) as max_alt_dp, cast(sum(dp) as bigint) as dp,
          count(*) filter (alt_dp > 0) as samples_with_alt, array_to_string(list_concat([ref_ad], alt_ad), ',') as ad
        from v_ad d join v_alleles a on a.chrom = d.chrom and a.pos = d.pos
        group by a.chrom, a.pos, ref, alts, ref_ad, alt_ad having max(alt_dp) > 0""",
    "v_f": """
        select unnest(list_concat(list_concat([0.0::double], list_transform(range(1, 7), lambda k: pow(0.5, k))),
                                  list_transform(range(2, 7), lambda k: 1 - pow(0.5, k)))) as f""",
    # Eleven frequencies, each as likely as 1/f, and none with a chance of 0.999.
    "v_qual": """
        select chrom, pos, dp, 10 * greatest(0, top + log10(sum(pow(10, t - top))) - max(t) filter (f = 0)) as qual
        from (select *, max(t) over (partition by chrom, pos) as top from (
          select chrom, pos, f, cast(sum(dp) as bigint) as dp,
            sum(log10((1 - f) * (1 - f) * w0 + f * (1 - f) * w1 + f * f * w2))
              + log10(case when f = 0 then 0.999 else 0.001 / f / (select sum(1 / f) from v_f where f > 0) end) as t
          from (select chrom, pos, sample, max(dp) as dp, sum(case when g = 0 then pow(10, l - m) else 0 end) as w0,
                  sum(case when i = 0 and j > 0 then 2 * share_b * pow(10, l - m) else 0 end) as w1,
                  sum(case when i > 0 then (case when i = j then 1 else 2 end) * share_a * share_b * pow(10, l - m) else 0 end) as w2
                from (select *, max(l) over (partition by sample, chrom, pos) as m from v_gl) group by chrom, pos, sample), v_f
          group by chrom, pos, f))
        group by chrom, pos, dp, top""",
    "v_strand": """
        select chrom, pos, count(*) filter (base = ref and strand = 0) as ref_f,
          count(*) filter (base = ref and strand = 1) as ref_r,
          count(*) filter (base <> ref and strand = 0) as alt_f,
          count(*) filter (base <> ref and strand = 1) as alt_r
        from fx_pileup group by chrom, pos""",
    "v_fisher": """
        select chrom, pos, ref_f, ref_r, alt_f, alt_r,
          abs(-10 * least(ln(sum(exp(lp - lo)) filter (lp <= lo + 1e-7)) + max(lo), 0) / ln(10)) as fs
        from (select *, max(case when x = ref_f then lp end) over (partition by chrom, pos) as lo from (
          select *, lgamma(r + 1) - lgamma(x + 1) - lgamma(r - x + 1) + lgamma(o + 1) - lgamma(c - x + 1)
              - lgamma(o - c + x + 1) - lgamma(r + o + 1) + lgamma(c + 1) + lgamma(r + o - c + 1) as lp
          from (select *, unnest(range(greatest(0, c - o), least(r, c) + 1)) as x from (
            select *, ref_f + ref_r as r, alt_f + alt_r as o, ref_f + alt_f as c from v_strand))))
        group by chrom, pos, ref_f, ref_r, alt_f, alt_r""",
    "v_sor": """
        select chrom, pos, ref_f, ref_r, alt_f, alt_r,
          ln((a * d) / (b * c) + (b * c) / (a * d)) + ln(least(a, b) / greatest(a, b)) - ln(least(c, d) / greatest(c, d)) as sor
        from (select *, ref_f + 1 as a, ref_r + 1 as b, alt_f + 1 as c, alt_r + 1 as d from v_strand)""",
    "v_rms": "select chrom, pos, sqrt(avg(mapq * mapq)) as mq from fx_pileup group by chrom, pos",
    **{
        view: f"""
        select chrom, pos, count(*) filter (base = ref) as n_ref, count(*) filter (base <> ref) as n_alt,
          case when count(*) filter (base = ref) > 0 and count(*) filter (base <> ref) > 0 then (
            (sum(r) filter (base <> ref) - count(*) filter (base <> ref) * (count(*) filter (base <> ref) + 1) / 2
             - count(*) filter (base <> ref) * count(*) filter (base = ref) / 2)
            / sqrt(count(*) filter (base <> ref) * count(*) filter (base = ref) * (count(*) + 1) / 12)) end as z
        from (select *, rank() over (partition by chrom, pos order by {value})
                + (count(*) over (partition by chrom, pos, {value}) - 1) / 2 as r from fx_pileup)
        group by chrom, pos"""
        for view, value in (("v_mapq_z", "mapq"), ("v_readpos_z", "read_pos"))
    },
    "v_annotated": """
        select c.chrom, c.pos, c.ref, array_to_string(alts, ',') as alt, q.qual, q.dp, q.qual / q.dp as qd, fs, sor, mq,
          m.z as mqranksum, r.z as readposranksum
        from v_candidates c join v_qual q using (chrom, pos) join v_fisher using (chrom, pos) join v_sor using (chrom, pos)
        join v_rms using (chrom, pos) join v_mapq_z m using (chrom, pos) join v_readpos_z r using (chrom, pos)""",
    "v_cells": """
        select g.chrom, g.pos, coalesce(c.gt, case when b.chrom is not null then '0/0' else './.' end) as gt
        from (select chrom, pos, s.sample from v_candidates, (select sample from fx_pileup union select sample from fx_blocks) s) g
        left join v_calls c on g.chrom = c.chrom and g.pos = c.pos and g.sample is not distinct from c.sample
        left join (select distinct b.sample, b.chrom, v.pos from fx_blocks b
                   join v_candidates v on v.chrom = b.chrom and v.pos between b.start and b.stop) b
          on g.chrom = b.chrom and g.pos = b.pos and g.sample is not distinct from b.sample""",
    "v_site_missing": """
        select chrom, pos, count(*) as calls, count(*) filter (gt = './.') as missing,
          count(*) filter (gt = './.') / count(*) as f_missing
        from fx_genotypes group by chrom, pos""",
    "v_dp_clipped": """
        select * from v_tagged, (
          select """ + _between("dp", 0.01) + " as lo, " + _between("dp", 0.99) + """ as hi
          from (select dp, count(*) over () as n, row_number() over (order by dp) - 1 as rn from v_tagged where dp is not null))
        where dp between lo and hi""",
    "v_best": """
        select * from (select *, row_number() over (partition by sample, locus
            order by exon_len desc, depth desc, contig_no) as rn from fx_contigs) where rn = 1""",
    "v_fraction": """
        select b.sample, b.locus, exon_len as bp, cast(length(seq) as double) as ref_len, exon_len / length(seq) as fraction
        from v_best b join fx_loci l on b.locus = l.locus""",
    "v_copies": "select sample, locus, count(*) as n from fx_contigs group by sample, locus",
    "v_clean": "select locus from v_copies group by locus having max(n) = 1",
    "v_flagged": "select locus from v_copies group by locus having max(n) > 1",
    "v_longest": """
        select locus, sample, contig_no, supercontig_len as length from (
          select *, row_number() over (partition by locus order by supercontig_len desc, sample, contig_no) as rn
          from fx_contigs where locus in (select locus from v_clean)) where rn = 1""",
    "v_extra_long": """
        select sample, locus, count(*) as contigs, count(*) filter (rn > 1 and exon_len >= 0.75 * ref_len) as extra_long
        from (select c.*, length(seq) as ref_len, row_number() over (partition by c.sample, c.locus
                order by exon_len desc, depth desc, contig_no) as rn
              from fx_contigs c join fx_loci l on c.locus = l.locus)
        group by sample, locus having count(*) > 1 and count(*) filter (rn > 1 and exon_len >= 0.75 * ref_len) > 0""",
    "v_depth_bins": """
        select g.locus, g.bin, count(c.locus) as n
        from (select locus, unnest(range(min(depth) // 5 - 1, max(depth) // 5 + 2)) as bin from fx_contigs group by locus) g
        left join fx_contigs c on c.locus = g.locus and c.depth // 5 = g.bin
        group by g.locus, g.bin""",
    "v_depth_runs": """
        select locus, bin, n from (select *, lag(n) over (partition by locus order by bin) as b from v_depth_bins)
        where b is null or b <> n""",
    "v_peaks": """
        select locus, count(*) as peaks from (
          select *, lag(n) over w as b, lead(n) over w as a from v_depth_runs
          window w as (partition by locus order by bin))
        where n >= 2 and n > b and n > a group by locus having count(*) >= 2""",
    "v_flag_shares": """
        select locus, max(n) as max_copies, count(*) as samples, count(*) filter (n > 1) as flagged,
          count(*) filter (n > 1) / (select count(distinct sample) from fx_contigs) as share
        from v_copies group by locus""",
}

ORACLE: dict[str, str] = {
    # sources, samples, manifests
    "sample_discovery": """
        select 'all_fastq' as folder, count(distinct path) as samples, cast(sum(size) as bigint) as bytes
        from fx_files where path like '%\\_1.fq.gz' escape '\\'""",
    "annotation_extract": """
        select chrom as CHROM, pos as POS, qual as QUAL, filter as FILTER, qd as QD, fs as FS, sor as SOR, mq as MQ,
          mqranksum as MQRankSum, readposranksum as ReadPosRankSum, dp as DP from v_tagged_all""",
    "fasta_file": "select header, seq from fx_targets",
    "name_list_file": "select cast(locus as varchar) as name from fx_loci",
    "fastq_file": "select read_id, seq, qual from fx_reads",
    "sam_file": """
        select cast(locus as varchar) as rname, cast(pos as bigint) as pos, cast(flag as int) as flag, '100M' as cigar,
          cast(locus as varchar) as rnext, seq, qual, 'a_b_' || sample as sample,
          cast(40 * (length(qual) - length(replace(qual, 'I', ''))) as int) as sum_bq
        from fx_target_alignments""",
    "vcf_file": """
        select chrom, pos, ref, alt, qual, qd, fs, sor, mq, mqranksum, readposranksum, dp from fx_sites""",
    "vcf_genotypes_file": "select chrom, pos, cast(sample as varchar) as sample, gt from fx_genotypes",
    "vcf_blocks_file": "select chrom, pos, cast(sample as varchar) as sample, gt from fx_genotypes",
    "vcf_contigs_file": "select name, length from fx_seqs",
    "stats_report_file": f"""
        select cast(count(*) filter ({_TI}) as double) as ti, cast(count(*) filter (not {_TI}) as double) as tv,
          round(count(*) filter ({_TI}) / count(*) filter (not {_TI}), 6) as titv, count(*) as records from v_tagged where pass = 'PASS'""",
    "annotations_file": """
        select chrom as CHROM, pos as POS, qual as QUAL, filter as FILTER, qd as QD, fs as FS, sor as SOR, mq as MQ,
          mqranksum as MQRankSum, readposranksum as ReadPosRankSum, dp as DP from v_tagged_all""",
    "cohort_file": "select sample, chrom, start, stop, gq from fx_blocks",
    "run_tables_file": "select * from v_run_table",
    "run_append_union": "select * from v_run_table",
    "sample_map": "select split_part(split_part(path, '/', 2), '_', 1) as sample, path from fx_files where side = 'source'",
    "interval_list": "select name from fx_seqs order by ord",
    "matrix_unpivot": "select sample, locus, count(*) as n from fx_contigs group by sample, locus",
    "manifest_counts": """
        select side, 'fq.gz' as extension, count(*) as files, cast(sum(size) as bigint) as bytes
        from fx_files group by side""",
    "resume_pending": """
        select path, size from fx_files where side = 'source'
          and path not in (select path from fx_files where side = 'dest')""",
    "read_groups": """
        select sample, base, p[1] || '_' || p[2] || '_' || p[3] as sm, p[4] as lb, 'ILLUMINA' as pl,
          p[5] || '_' || p[6] as pu, p[1] || '_' || p[2] || '_' || p[3] || '_' || p[5] || '_' || p[6] as rgid
        from (select *, string_split(base, '_') as p from fx_samples) where base not like 'Undetermined%'""",
    "sample_names": """
        select sample, base, p[1] || '_' || p[2] || '_' || p[3] as name
        from (select *, string_split(base, '_') as p from fx_samples)""",
    "drop_undetermined": "select sample, base from fx_samples where base not like 'Undetermined%'",
    "path_basename": "select side, replace(replace(path, 'all_fastq/', ''), '_1.fq.gz', '') as base from fx_files",
    "first_samples": "select sample, base from fx_samples where base like 'Plant%' order by base limit 5",
    "manifest_reconcile": """
        select count(*) filter (s.checksum = d.checksum) as same, count(*) filter (s.checksum <> d.checksum) as changed,
          count(*) filter (d.path is null) as missing, count(*) filter (s.path is null) as extra,
          count(*) filter (d.path is null or s.checksum <> d.checksum) = 0 as safe_to_remove
        from (select * from fx_files where side = 'source') s
        full join (select * from fx_files where side = 'dest') d on s.path = d.path""",
    # targets and probes
    "target_headers": "select locus_no, concat('Cajanus_cajan-', cast(locus_no as varchar)) as header from fx_targets",
    "target_locus_ids": """
        select concat('Cajanus_cajan-', id) as header, id as locus
        from (select regexp_extract(header, '_ID_([0-9]+)', 1) as id from fx_targets)""",
    "target_count_check": """
        select count(*) as records_in, count(*) filter (header like '%\\_ID\\_%' escape '\\') as records_out,
          count(*) = count(*) filter (header like '%\\_ID\\_%' escape '\\') as ok from fx_targets""",
    "target_uniqueness": """
        select count(*) as headers, count(distinct regexp_extract(header, '_ID_([0-9]+)', 1)) as loci,
          count(*) = count(distinct regexp_extract(header, '_ID_([0-9]+)', 1)) as unique from fx_targets""",
    "target_head": "select locus_no, header from fx_targets order by locus_no limit 5",
    "probe_headers": """
        select header, cast(split_part(header, '_', 2) as int) as region_id, split_part(header, '_', 4) as linkage_group,
          cast(split_part(header, '_', 6) as bigint) as start, cast(split_part(header, '_', 7) as bigint) as stop,
          cast(split_part(header, '_', 9) as int) as probe_no from fx_probes""",
    "probe_tiling": """
        select g as linkage_group, count(*) as regions, cast(sum(n) as bigint) as probes, max(n) as max_per_region,
          round(sum(n) / count(*), 6) as mean_per_region, round(sum(bp) / sum(n), 6) as mean_length,
          round(sum(n) * 100.0 / (select count(*) from fx_probes), 6) as percent_of_probes
        from (select split_part(header, '_', 4) as g, split_part(header, '_', 2) as region, count(*) as n, sum(length(seq)) as bp
              from fx_probes group by 1, 2) group by g""",
    # expressions
    "region_filter": "select chrom, pos, ref, alt from fx_sites where chrom in ('chr01', 'chr02', 'chr03')",
    "main_chrom_filter": "select chrom, pos, ref, alt from fx_sites where chrom like 'chr%'",
    "pass_label_counts": """
        select case when filter = 'PASS' then 'PASS' else 'FAIL' end as pass, count(*) as sites
        from v_tagged_all group by 1""",
    "non_null_annotations": """
        select chrom, pos, mqranksum, readposranksum from fx_sites
        where mqranksum is not null and readposranksum is not null""",
    "qual_clip": "select chrom, pos, qual from fx_sites where qual >= 0 and qual <= 100",
    "annotations_long": f"""
        select chrom, pos, pass, annotation, value from (
          select chrom, pos, case when {_ANY_FAIL} then 'FAIL' else 'PASS' end as pass,
            unnest(['QD','FS','SOR','MQ','MQRankSum','ReadPosRankSum']) as annotation,
            unnest([qd, fs, sor, mq, mqranksum, readposranksum]) as value from fx_sites)
        where value is not null""",
    "substitution_classes": f"""
        select ref, alt, case when length(ref) <> 1 or length(alt) <> 1 then null
          when {_TI} then 'transition' when ref <> alt then 'transversion' end as class, count(*) as sites
        from fx_sites group by all""",
    "phred_probability": """
        select chrom, pos, qual, round(pow(10, -qual / 10), 9) as error,
          round(-10 * log10(pow(10, -qual / 10)), 6) as phred from fx_sites""",
    "variant_types": """
        select chrom, pos, ref, alt, case when length(ref) = 1 then 'SNP' else 'INDEL' end as variant_type,
          cast(1 + length(alt) - length(replace(alt, ',', '')) as int) as n_alt from fx_sites""",
    "genotype_states": """
        select chrom, sample, case gt when './.' then 'missing' when '0/0' then 'hom_ref' when '0/1' then 'het'
          else 'hom_alt' end as state, count(*) as calls from fx_genotypes group by all""",
    # reads
    "base_qualities": """
        select read_id, mate, array_to_string(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33), ',') as phred
        from fx_reads""",
    "reverse_complement": """
        select read_id, mate, translate(reverse(seq), 'TGCAN', 'ACGTN') as seq from fx_reads""",
    "mate_pairs": """
        select sample, read_id, max(seq) filter (mate = 1) as seq_1, max(seq) filter (mate = 2) as seq_2
        from fx_reads group by sample, read_id
        having count(*) filter (mate = 1) > 0 and count(*) filter (mate = 2) > 0""",
    "unpaired_mates": """
        select sample, read_id, min(mate) as mate from fx_reads group by sample, read_id
        having count(*) filter (mate = 2) = 0""",
    "read_basic_stats": """
        select sample, mate, count(*) as reads, cast(sum(length(seq)) as bigint) as bases,
          cast(min(length(seq)) as int) as min_length, cast(max(length(seq)) as int) as max_length,
          round(avg(length(seq)), 6) as mean_length,
          round(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) * 100.0 / sum(length(seq)), 6) as gc_percent
        from fx_reads group by sample, mate""",
    "cycle_quality": """
        select sample, mate, cast(cycle as int) as cycle, count(*) as bases, round(avg(phred), 6) as mean_phred,
          quantile_cont(cast(phred as double), 0.25) as q1, quantile_cont(cast(phred as double), 0.5) as median,
          quantile_cont(cast(phred as double), 0.75) as q3
        from v_cycles group by all""",
    "read_quality_hist": """
        select sample, mate, cast(floor((40 * (length(qual) - bad) + 2 * bad) / length(qual)) as bigint) as mean_phred,
          count(*) as reads
        from (select *, length(qual) - length(replace(qual, '#', '')) as bad from fx_reads) group by all""",
    "cycle_base_content": "select sample, mate, cast(cycle as int) as cycle, count(*) as bases, "
    + ", ".join(f"count(*) filter (base = '{b.upper()}') as n_{b}" for b in "acgtn")
    + ", "
    + ", ".join(f"round(count(*) filter (base = '{b.upper()}') * 100.0 / count(*), 6) as pct_{b}" for b in "acgtn")
    + " from v_cycles group by all",
    "gc_histogram": """
        select sample, mate, cast(floor(length(regexp_replace(seq, '[^GC]', '', 'g')) * 100 / length(seq)) as bigint) as gc_percent,
          count(*) as reads from fx_reads group by all""",
    "n_content": """
        select sample, mate, cast(cycle as int) as cycle, count(*) as bases, count(*) filter (base = 'N') as n_n,
          round(count(*) filter (base = 'N') * 100.0 / count(*), 6) as pct_n from v_cycles group by all""",
    "read_length_hist": """
        select sample, mate, cast(length(seq) as int) as length, count(*) as reads from v_cut group by all""",
    "sequence_duplication": """
        select sample, mate, copies, count(*) as sequences, cast(sum(copies) as bigint) as reads
        from (select sample, mate, seq, count(*) as copies from fx_reads group by all) group by sample, mate, copies""",
    "overrepresented_sequences": """
        select seq, count(*) as reads, round(count(*) * 100.0 / (select count(*) from fx_reads), 9) as percent
        from fx_reads group by seq having count(*) > 0.00002 * (select count(*) from fx_reads)""",
    "adapter_content": """
        select f.sample, f.mate, cast(c.cycle as int) as cycle,
          count(*) filter (hit > 0 and hit <= c.cycle) as with_adapter,
          round(count(*) filter (hit > 0 and hit <= c.cycle) * 100.0 / count(*), 6) as percent
        from (select sample, mate, strpos(seq, 'AGATCGGAAGAG') as hit from fx_reads) f, range(1, 101) c(cycle)
        group by f.sample, f.mate, c.cycle""",
    "adapter_detect": """
        select mate, kmer, n from (
          select mate, kmer, count(*) as n, row_number() over (partition by mate order by count(*) desc, kmer) as rn
          from (select mate, substr(seq, cast(i as int), 12) as kmer
                from (select mate, seq, unnest(range(71, 90)) as i from fx_reads))
          group by mate, kmer) where rn = 1""",
    "adapter_trim": "select read_id, mate, seq, qual from v_cut",
    "adapters_walked": """
        select mate, arg_min(text, (-length(text), text)) as adapter, max(most) as n from (
          with recursive kmers as materialized (
            select *, max(n) over (partition by mate) as most from (
              select mate, substr(seq, cast(i as int), 12) as kmer, count(*) as n
              from (select mate, seq, unnest(range(71, 90)) as i from fx_other_reads) group by all)
          ), usable as materialized (select * from kmers where n >= most * 0.5),
          walk(mate, text, most, side) as (
            select mate, min(kmer), max(most), 0 from kmers where n = most group by mate
            union all
            select w.mate, case when w.side = 0 and r.kmer is not null then w.text || right(r.kmer, 1)
                                when l.kmer is not null then left(l.kmer, 1) || w.text else w.text end, w.most,
              case when w.side = 0 and r.kmer is not null then 0 when l.kmer is not null then 1 else 2 end
            from walk w
            left join (select mate, left(kmer, 11) as stem, arg_min(kmer, (-n, kmer)) as kmer from usable group by all) r
              on w.side = 0 and r.mate = w.mate and r.stem = right(w.text, 11)
            left join (select mate, right(kmer, 11) as stem, arg_min(kmer, (-n, kmer)) as kmer from usable group by all) l
              on w.side < 2 and l.mate = w.mate and l.stem = left(w.text, 11)
            where w.side < 2 and length(w.text) < 64)
          select * from walk) group by mate""",
    "adapter_detected_trim": """
        select read_id, mate, seq, qual from v_other_kept where kept""",
    "quality_filter": "select read_id, mate, seq from v_judged where why is distinct from 'quality'",
    "length_filter": "select read_id, mate, seq from v_judged where why is distinct from 'quality' and length(seq) >= 80",
    "surviving_pairs": "select read_id, mate, cast(length(seq) as int) as length from v_kept where kept",
    "trim_report": """
        select sample, count(*) as reads_before, cast(sum(len_before) as bigint) as bases_before,
          count(*) filter (length(seq) < len_before) as adapter_trimmed,
          count(*) filter (why = 'quality') as low_quality, count(*) filter (why = 'length') as too_short,
          count(*) filter (why is null and not kept) as mate_lost, count(*) filter (kept) as reads_after,
          cast(coalesce(sum(length(seq)) filter (kept), 0) as bigint) as bases_after
        from v_kept group by sample""",
    "cohort_qc_table": """
        select a.*, b.mean_phred, c.duplicate_percent, d.kept_percent, d.adapter_trimmed from
          (select sample, count(*) as reads, cast(sum(length(seq)) as bigint) as bases,
             round(avg(length(seq)), 6) as mean_length,
             round(sum(length(regexp_replace(seq, '[^GC]', '', 'g'))) * 100.0 / sum(length(seq)), 6) as gc_percent
           from fx_reads group by sample) a
        join (select sample, round(sum(40 * length(replace(qual, '#', '')) + 2 * length(replace(qual, 'I', ''))) / sum(length(qual)), 6) as mean_phred
              from fx_reads group by sample) b on a.sample = b.sample
        join (select sample, round(100 - count(distinct seq) * 100.0 / count(*), 6) as duplicate_percent
              from fx_reads group by sample) c on a.sample = c.sample
        join (select sample, round(count(*) filter (kept) * 100.0 / count(*), 6) as kept_percent,
                count(*) filter (length(seq) < len_before) as adapter_trimmed
              from v_kept group by sample) d on a.sample = d.sample""",
    # mapping
    "seed_assign": """
        select sample, read_id, mate, locus, cast(diag as int) as diag, strand, score, second_score
        from v_placed where rn = 1""",
    "on_target_counts": """
        select r.sample, count(*) as reads, count(p.read_id) as on_target, round(count(p.read_id) * 100.0 / count(*), 6) as percent
        from fx_reads r left join (select distinct sample, read_id, mate from v_seeds) p
          on r.sample = p.sample and r.read_id = p.read_id and r.mate = p.mate
        group by r.sample""",
    "mapq_filter": "select sample, qname, rname, pos, mapq from fx_alignments where mapq >= 30",
    "flag_bits": """
        select sample, qname, flag, (flag & 1) = 1 as paired, (flag & 2) = 2 as proper, (flag & 4) = 0 as mapped,
          (flag & 16) = 16 as reverse, (flag & 64) = 64 as first_mate, flag | 1024 as as_duplicate from fx_alignments""",
    "attach_read_groups": """
        select a.sample, qname, p[1] || '_' || p[2] || '_' || p[3] || '_' || p[5] || '_' || p[6] as rgid, p[4] as lb
        from fx_alignments a left join (select sample, string_split(base, '_') as p from fx_samples
                                   where base not like 'Undetermined%') s on a.sample = s.sample""",
    "coordinate_rank": """
        select rname, pos, qname, row_number() over (order by rname, pos, qname, flag) as rank from fx_alignments""",
    "flagstat": """
        select sample, count(*) as total, count(*) filter ((flag & 4) = 0) as mapped, count(*) filter ((flag & 1) = 1) as paired,
          count(*) filter ((flag & 6) = 2) as properly_paired, count(*) filter ((flag & 64) = 64) as first_mates,
          count(*) filter ((flag & 128) = 128) as second_mates, count(*) filter ((flag & 1024) = 1024) as duplicates,
          count(*) filter ((flag & 256) = 256) as secondary, count(*) filter ((flag & 2048) = 2048) as supplementary,
          count(*) filter ((flag & 13) = 9) as singletons
        from v_marked group by sample""",
    "mark_duplicates": "select sample, library, qname, rname, pos, flag from v_marked",
    "duplicate_metrics": "select *, round(duplicates / examined, 6) as share from v_metrics",
    "high_duplication_samples": """
        select sample, cast(sum(examined) as bigint) as examined, cast(sum(in_pairs) as bigint) as in_pairs,
          cast(sum(duplicates) as bigint) as duplicates, cast(sum(secondary_or_supplementary) as bigint) as secondary_or_supplementary,
          cast(sum(unmapped) as bigint) as unmapped, round(sum(duplicates) / sum(examined), 6) as share
        from v_metrics group by sample having sum(duplicates) / sum(examined) > 0.3""",
    "position_depth": "select rname, rpos as pos, count(*) as depth from v_bases group by all",
    "depth_profiles": """
        select rname, count(*) as covered, round(avg(depth), 6) as mean_depth, max(depth) as max_depth,
          round(quantile_cont(depth, 0.25), 6) as q1, round(quantile_cont(depth, 0.5), 6) as median_depth, round(quantile_cont(depth, 0.75), 6) as q3
        from (select rname, rpos, count(*) as depth from v_bases group by all) group by rname""",
    "callable_positions": """
        select rname, count(*) as positions from (select rname, rpos, count(*) as depth from v_bases group by all)
        where depth between 20 and 200 group by rname""",
    "mapq_attrition": """
        select sample, count(*) as before, count(*) filter (mapq >= 30) as after,
          round(count(*) filter (mapq >= 30) * 100.0 / count(*), 6) as kept_percent from fx_alignments group by sample""",
    # calling
    "pileup_positions": """
        select rname as chrom, rpos as pos, strand, count(*) as bases, cast(sum(mapq) as bigint) as mapq,
          cast(sum(read_pos) as bigint) as read_pos, min(sample) as first_sample from v_bases group by rname, rpos, strand""",
    "pileup_on_reference": """
        select chrom, pos, ref, base, count(*) as bases, cast(sum(bq) as bigint) as quality, count(sample) as named from (
          select cast(l.locus as varchar) as chrom, l.sample, cast(l.pos + i as bigint) as pos,
            upper(substr(t.seq, cast(l.pos + i as int), 1)) as ref, upper(substr(l.seq, cast(i + 1 as int), 1)) as base,
            ascii(substr(l.qual, cast(i + 1 as int), 1)) - 33 as bq
          from (select *, unnest(range(0, 100)) as i from fx_target_alignments where (flag & 1796) = 0 and seq <> '*') l
          join fx_loci t using (locus))
        where ref in ('A', 'C', 'G', 'T') and base in ('A', 'C', 'G', 'T') group by all""",
    "allele_counts": """
        select sample, chrom, pos, ref, base, count(*) as depth, count(*) filter (strand = 0) as forward,
          count(*) filter (strand = 1) as reverse from fx_pileup group by all""",
    "genotype_likelihoods": """
        select sample, chrom, pos, ref, array_to_string(alts, ',') as alt, dp, cast(g as int) as pair, round(l, 6) as l from v_gl""",
    "genotype_calls": """
        select c.*, array_to_string(ad, ',') as ad from v_calls c
        join v_ad d on c.chrom = d.chrom and c.pos = d.pos and c.sample is not distinct from d.sample""",
    "reference_blocks": """
        select sample, chrom, band, min(pos) as start, max(pos) as stop, min(gq) as gq from (
          select *, pos - row_number() over (partition by sample, chrom, band order by pos) as island
          from (select *, case when gq >= 20 then 'confident' else 'low' end as band from v_calls where gt = '0/0'))
        group by sample, chrom, band, island""",
    "cohort_combine": """
        select sample, chrom, pos as start, pos as stop, gt, gq, false as is_block from v_calls where gt <> '0/0'
        union all
        select sample, chrom, start, stop, '0/0', gq, true from fx_blocks""",
    "candidate_sites": """
        select chrom, pos, ref, array_to_string(alts, ',') as alt, ad, max_alt_dp, dp, samples_with_alt from v_candidates""",
    "block_site_join": """
        select b.sample, b.chrom, b.start, b.stop, b.gq, s.pos from fx_blocks b
        join fx_sites s on s.chrom = b.chrom and s.pos between b.start and b.stop""",
    "cohort_grid": "select chrom, pos, sample, gt from fx_genotypes",
    "joint_genotypes": """
        select v.chrom, v.pos, v.ref, cast(v.number as int) as number, alts[v.number] as alt, called, no_call, het, hom_alt, coalesce(ac, 0) as ac,
          2 * called as an, round(coalesce(ac, 0) / nullif(2 * called, 0), 6) as af
        from (select *, unnest(range(1, len(alts) + 1)) as number from v_candidates) v
        join (select chrom, pos, count(*) filter (gt <> './.') as called, count(*) filter (gt = './.') as no_call,
                count(*) filter (gt <> './.' and gt[1] <> gt[3]) as het,
                count(*) filter (gt <> './.' and gt[1] = gt[3] and gt[1] <> '0') as hom_alt
              from v_cells group by chrom, pos) c on c.chrom = v.chrom and c.pos = v.pos
        left join (select chrom, pos, cast(allele as int) as number, count(*) as ac
                   from (select chrom, pos, unnest([gt[1], gt[3]]) as allele from v_cells where gt <> './.') group by all) seen
          on seen.chrom = v.chrom and seen.pos = v.pos and seen.number = v.number""",
    "site_qual": "select chrom, pos, round(qual, 4) as qual, dp from v_qual",
    "site_qd": "select chrom, pos, round(qual, 4) as qual, dp, round(qual / dp, 4) as qd from v_qual",
    "strand_table": "select * from v_strand",
    "fisher_strand": "select * replace (round(fs, 4) as fs) from v_fisher",
    "strand_odds_ratio": "select * replace (round(sor, 6) as sor) from v_sor",
    "rms_mapq": "select chrom, pos, round(mq, 6) as mq from v_rms",
    "mapq_rank_sum": "select chrom, pos, n_ref, n_alt, round(z, 6) as mq_rank_sum from v_mapq_z",
    "readpos_rank_sum": "select chrom, pos, n_ref, n_alt, round(z, 6) as read_pos_rank_sum from v_readpos_z",
    "annotated_sites": f"""
        select * replace (round(qual, 4) as qual, round(qd, 4) as qd, round(fs, 4) as fs, round(sor, 4) as sor,
          round(mq, 4) as mq, round(mqranksum, 4) as mqranksum, round(readposranksum, 4) as readposranksum),
          {_TAG} as filter from v_annotated""",
    "called_biallelic_snps": f"""
        select chrom, pos, ref, alt, round(qual, 4) as qual, dp, {_TAG} as filter,
          case when {_TAG} = 'PASS' then 'PASS' else 'FAIL' end as pass from v_annotated where {_BI}""",
    "site_depth": "select chrom, pos, count(*) as dp from fx_pileup group by chrom, pos",
    # variant tables
    "select_snps": f"select chrom, pos, ref, alt from fx_sites where {_SNP}",
    "biallelic_sites": f"select chrom, pos, ref, alt from fx_sites where {_BI}",
    "hard_filter_tags": "select chrom, pos, filter from v_tagged_all",
    "filter_failures": " union all ".join(
        f"select '{n}' as filter, count(*) filter ({c}) as sites_failed from v_tagged" for n, c in _RULES.items()
    ),
    "pass_sites": f"select chrom, pos, ref, alt, qual from fx_sites where {_SNP} and {_BI} and not {_ANY_FAIL}",
    "filter_attrition": f"""
        select all_sites, raw_snps, pass_snps, raw_snps - pass_snps as removed,
          round_even((raw_snps - pass_snps) / raw_snps * 100.0, 2) as pct_removed, ti, tv, round(ti / tv, 6) as titv
        from (select (select count(*) from fx_sites) as all_sites, count(*) as raw_snps,
                count(*) filter (pass = 'PASS') as pass_snps,
                count(*) filter (pass = 'PASS' and {_TI}) as ti, count(*) filter (pass = 'PASS' and not {_TI}) as tv
              from v_tagged)""",
    "filter_combinations": "select filter, count(*) as sites from v_tagged group by filter",
    "filter_counts_table": "select filter, sites_failed, threshold, "
    "round_even(sites_failed / raw_snps * 100.0, 2) as pct_of_total, raw_snps from ("
    + " union all ".join(
        f"select '{n}' as filter, count(*) filter ({c}) as sites_failed, '{_LABELS[n]}' as threshold, "
        "count(*) as raw_snps from v_tagged"
        for n, c in _RULES.items()
    )
    + ") order by sites_failed desc, filter",
    "titv_ratio": f"""
        select chrom, count(*) filter ({_TI}) as ti, count(*) filter (not {_TI}) as tv,
          round(count(*) filter ({_TI}) / nullif(count(*) filter (not {_TI}), 0), 6) as titv
        from v_tagged where pass = 'PASS' group by chrom""",
    "variant_stats": """
        select coalesce(chrom, 'total') as region, count(*) as records, count(*) filter (length(ref) = 1) as snps,
          count(*) filter (length(ref) = 2) as indels, cast(0 as bigint) as others,
          count(*) filter (position(',' in alt) > 0) as multiallelic
        from fx_sites group by rollup(chrom)""",
    "interval_semi_join": """
        select chrom, pos from fx_sites where chrom in (select name from fx_seqs where length > 45000000)""",
    "run_comparison": """
        select a.run as run_a, b.run as run_b, a.raw_snps as raw_a, b.raw_snps as raw_b, b.raw_snps - a.raw_snps as raw_change,
          a.pass_snps as pass_a, b.pass_snps as pass_b, b.pass_snps - a.pass_snps as pass_change,
          a.pct_removed as pct_removed_a, b.pct_removed as pct_removed_b
        from v_run_table a, v_run_table b where a.run = 'first' and b.run = 'second'""",
    # cohort QC
    "site_missingness": "select chrom, pos, calls, missing, round(f_missing, 6) as f_missing from v_site_missing",
    "sample_missingness": """
        select sample, count(*) as calls, count(*) filter (gt = './.') as missing,
          round(count(*) filter (gt = './.') / count(*), 6) as f_missing from fx_genotypes group by sample""",
    "packed_site_counts": """
        select chrom, pos, count(*) filter (gt = '0/0') as hom_ref, count(*) filter (gt = '0/1') as het,
          count(*) filter (gt = '1/1') as hom_alt, count(*) filter (gt = './.') as missing,
          round(count(*) filter (gt = './.') / count(*), 6) as f_missing from fx_genotypes group by chrom, pos""",
    "packed_sample_counts": """
        select sample, count(*) filter (gt <> './.') as called, count(*) filter (gt = './.') as missing,
          round(count(*) filter (gt = './.') / count(*), 6) as f_missing from fx_genotypes group by sample""",
    "missingness_sweep": """
        select region, t as threshold, kept, total, floor(kept * 1000 / total) / 10 as pct from (
          select 'chr01' as region, t, count(*) filter (f_missing <= t) as kept, count(*) as total
          from v_site_missing, (values (cast(0.5 as double)), (0.3), (0.1)) v(t) where chrom = 'chr01' group by t
          union all
          select 'chr01-chr14', t, count(*) filter (f_missing <= t), count(*)
          from v_site_missing, (values (cast(0.5 as double)), (0.3), (0.1)) v(t) where chrom like 'chr%' group by t)""",
    "missingness_filter": """
        select chrom, pos, calls, missing, round(f_missing, 6) as f_missing from v_site_missing where f_missing <= 0.1""",
    "depth_summary": """
        select round(avg(dp), 4) as mean_dp, round(median(dp), 4) as median_dp, round(stddev_samp(dp), 4) as sd_dp,
          round(quantile_cont(dp, 0.01), 4) as p01, round(quantile_cont(dp, 0.99), 4) as p99,
          cast(305 as double) as dp_min_suggested, round(2 * median(dp), 4) as dp_max_suggested from v_tagged""",
    "depth_clip": """
        select chrom, pos, dp from fx_sites
        where dp >= (select """ + _between("dp", 0.01) + " from " + _RANKED_DP + ") and dp <= (select " + _between("dp", 0.99) + " from " + _RANKED_DP + ")",
    "depth_bounds_filter": "select chrom, pos, dp from fx_sites where dp >= 610 and dp <= 3000",
    "annotation_vs_threshold": """
        select l.annotation, t.threshold, pass, count(*) as sites, count(*) filter (bad) as beyond, count(*) filter (not bad) as within
        from (select *, case annotation when 'QD' then value < 2 when 'FS' then value > 60 when 'SOR' then value > 3
                when 'MQ' then value < 40 when 'MQRankSum' then value < -12.5 else value < -8 end as bad from v_long) l
        join (values ('QD', cast(2 as double)), ('FS', 60), ('SOR', 3), ('MQ', 40), ('MQRankSum', -12.5), ('ReadPosRankSum', -8))
          t(annotation, threshold) on l.annotation = t.annotation
        group by l.annotation, t.threshold, pass""",
    "annotation_clip": "select chrom, pos, annotation, value from v_long_clipped",
    "qual_histogram": """
        select pass, cast(least(coalesce(floor((qual - lo) / nullif(hi - lo, 0) * 100), 0), 99) as int) as bin, count(*) as sites
        from v_tagged, (select min(qual) as lo, max(qual) as hi from v_tagged where qual between 0 and 100)
        where qual between 0 and 100 group by 1, 2""",
    "dp_histogram": """
        select pass, cast(least(coalesce(floor((dp - a) / nullif(b - a, 0) * 100), 0), 99) as int) as bin, count(*) as sites
        from v_dp_clipped, (select min(dp) as a, max(dp) as b from v_dp_clipped) group by 1, 2""",
    "annotation_histograms": """
        select l.annotation, pass, cast(least(floor((value - a) / (b - a) * 100), 99) as int) as bin, count(*) as sites
        from v_long_clipped l join (select annotation, min(value) as a, max(value) as b from v_long_clipped group by annotation) e
          on l.annotation = e.annotation group by 1, 2, 3""",
    "snp_density": """
        select chrom, cast(floor(pos / 1000000) as bigint) as window, pass, count(*) as sites
        from v_tagged where chrom like 'chr%' group by all""",
    "density_gaps": """
        select chrom, w as window from (
          select chrom, unnest(range(0, max(pos // 10000) + 1)) as w from v_tagged where chrom like 'chr%' group by chrom)
        except select chrom, pos // 10000 from v_tagged""",
    "run_qc_summary": f"""
        select 'first' as run, 61 as n_samples, count(*) as raw_snps, count(*) filter (pass = 'PASS') as pass_snps,
          round_even(count(*) filter (pass = 'FAIL') / count(*) * 100.0, 2) as pct_removed,
          round(count(*) filter (pass = 'PASS' and {_TI}) / count(*) filter (pass = 'PASS' and not {_TI}), 6) as titv,
          cast(count(*) filter (pass = 'PASS' and {_TI}) as double) as titv_ti,
          cast(count(*) filter (pass = 'PASS' and not {_TI}) as double) as titv_tv,
          round_even(avg(dp), 1) as dp_mean, round_even(median(dp), 1) as dp_median,
          round_even(stddev_samp(dp), 1) as dp_sd, cast(305 as double) as dp_min_filter, 2 * median(dp) as dp_max_filter
        from v_tagged""",
    "hash_sample": """
        select chrom, pos, qual from fx_sites order by md5(chrom || ':' || cast(pos as varchar)) limit 1000""",
    # recovery and paralogs
    "best_contigs": "select sample, locus, contig_no, exon_len, supercontig_len, depth from v_best",
    "assembled_samples": "select distinct sample from fx_contigs",
    "seq_lengths": """
        select cast(s.sample as varchar) as sample, l.locus, cast(coalesce(exon_len, 0) as double) as bp
        from fx_loci l, (select distinct sample from fx_contigs) s
        left join v_best b on b.sample = s.sample and b.locus = l.locus
        union all
        select 'MeanLength', locus, avg(length(seq)) from fx_loci group by locus""",
    "supercontig_lengths": """
        select cast(s.sample as varchar) as sample, l.locus, cast(coalesce(supercontig_len, 0) as double) as bp
        from fx_loci l, (select distinct sample from fx_contigs) s
        left join v_best b on b.sample = s.sample and b.locus = l.locus""",
    "recovery_matrix": "select sample, locus, bp, ref_len, round(fraction, 6) as fraction from v_fraction",
    "recovery_stats": """
        select sample, count(*) filter (bp > 0) as with_sequence, count(*) filter (fraction >= 0.25) as at_25,
          count(*) filter (fraction >= 0.5) as at_50, count(*) filter (fraction >= 0.75) as at_75,
          cast(sum(bp) as bigint) as total_bp from v_fraction group by sample""",
    "locus_recovery": """
        select sample, locus, count(*) as cells, cast(sum(exon_len) as bigint) as total_bp, round(avg(exon_len), 6) as mean_bp,
          case when grouping(sample) = 0 then 'sample' when grouping(locus) = 0 then 'locus' else 'all' end as margin
        from v_best group by grouping sets ((sample), (locus), ())""",
    "locus_sequence_sets": """
        select locus, count(*) as records, cast(sum(supercontig_len) as bigint) as total_bp, max(supercontig_len) as longest,
          min(sample) as first_sample, max(sample) as last_sample from v_best group by locus""",
    "intron_lengths": """
        select sample, locus, exon_len as exon_bp, supercontig_len as supercontig_bp, supercontig_len - exon_len as intron_bp
        from v_best""",
    "copy_counts": """
        select s.sample, l.locus, coalesce(n, 0) as n
        from (select distinct sample from fx_contigs) s, (select distinct locus from fx_contigs) l
        left join v_copies c on c.sample = s.sample and c.locus = l.locus""",
    "paralog_warnings_long": "select * from v_extra_long",
    "paralog_warnings_depth": "select * from v_peaks",
    "paralog_summary": """
        select p.sample, count(e.locus) as long, count(d.locus) as depth, count(coalesce(e.locus, d.locus)) as either,
          round(count(coalesce(e.locus, d.locus)) * 100.0 / (select count(distinct locus) from fx_contigs), 6) as percent
        from (select distinct sample, locus from fx_contigs) p
        left join v_extra_long e on p.sample = e.sample and p.locus = e.locus
        left join v_peaks d on p.locus = d.locus group by p.sample""",
    "paralog_report": """
        select locus, max_copies, samples, flagged, round(share, 6) as share from v_flag_shares where share > 0.01""",
    "clean_loci": "select locus from v_clean",
    "paralog_loci": "select locus from v_flagged",
    "lenient_loci": """
        select locus, flagged, round(share, 6) as share, case when share > 0.5 then 'paralog' else 'clean' end as status
        from v_flag_shares""",
    "missing_loci": "select locus from fx_loci where locus not in (select locus from v_longest where length >= 60)",
    "loci_except": "select distinct locus from fx_contigs where locus not in (select locus from v_flagged)",
    "loci_intersect": "select locus from v_clean where locus in (select locus from fx_loci)",
    "supercontig_reference": "select * from v_longest",
    "reference_manifest": """
        select cast(locus as varchar) as name, length, cast(sum(length) over (order by locus) - length as bigint) as offset,
          cast(sum(length) over (order by locus) as bigint) as end_offset from v_longest where length > 0""",
    "assembly_stats": """
        select coalesce(class, 'total') as class, count(*) as sequences, cast(sum(length) as bigint) as total_bp,
          min(length) as min_bp, max(length) as max_bp, round(avg(length), 6) as mean_bp,
          round(sum(length) * 100.0 / (select sum(length) from fx_seqs), 6) as percent
        from (select case when name like 'chr%' then 'chromosome' else 'scaffold' end as class, length from fx_seqs)
        group by rollup(class)""",
    "scaffold_cutoff": "select name, length from fx_seqs where name like 'chr%' or length > 100000",
}


def with_views(body: str) -> str:
    """The query with the views it needs in front, in the order they are listed."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\b(?:fx|v)_[a-z_]+\b", text)):
            if name in _VIEWS and name not in needed:
                needed.add(name)
                visit(_VIEWS[name])

    visit(body)
    if not needed:
        return body.strip()
    listed = ",\n".join(f"{name} as ({_VIEWS[name].strip()})" for name in _VIEWS if name in needed)
    return f"with {listed}\n{body.strip()}"


def oracle() -> dict[str, str]:
    return {name: with_views(body) for name, body in ORACLE.items()}
