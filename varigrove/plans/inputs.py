"""Test inputs derived from the given tables.

The tables know nothing of sequencing, so each view gives one kind of engine
table its rows: every row of a given table takes part. Values are mixed from
keys with fixed arithmetic, so both engines can build them. `INPUT_SQL` holds
the same views for the oracle, written apart from the DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varigrove.operators.joins import spread, with_roster


def _digits(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _base(c: Column) -> Column:
    """One of A, C, G, T by number."""
    return F.substring(F.lit("ACGT"), (c % 4 + 1).cast("int"), F.lit(1))


def _dashed(*columns: str) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


class Inputs:
    """Views over the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sites(self) -> DataFrame:
        """Variant sites; some multiallelic, some indels, some null annotations."""
        lines = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.max("l_partkey").alias("k"))
            .withColumn("h", F.expr("l_orderkey*7919 + k*104729 + l_linenumber*17"))
        )
        k, h = F.col("k"), F.col("h")
        tenth = lambda c: c.cast("double") / 10
        chrom = F.when(k % 16 < 14, F.concat(F.lit("chr"), _digits(k % 16 + 1, 2))).otherwise(
            F.concat(F.lit("scaffold_"), (k % 16).cast("string"))
        )
        return lines.select(
            chrom.alias("chrom"),
            F.expr("l_orderkey*1000 + l_linenumber*37 + 1").alias("pos"),
            F.when(h % 37 == 0, F.concat(_base(k), F.lit("G"))).otherwise(_base(k)).alias("ref"),
            F.when(h % 29 == 0, F.concat_ws(",", _base(k + 1), _base(k + 2)))
            .otherwise(_base(k + 1 + h % 3))
            .alias("alt"),
            tenth(h % 9001 + 250).alias("qual"),
            tenth(h % 349).alias("qd"),
            tenth(h % 653).alias("fs"),
            tenth(h % 37).alias("sor"),
            tenth(h % 251 + 350).alias("mq"),
            F.when(h % 5 != 0, tenth(h % 263 - 131)).alias("mqranksum"),
            F.when(h % 5 != 0, tenth(h % 173 - 86)).alias("readposranksum"),
            (h % 3001 + 305).alias("dp"),
            "h",
        )

    def roster(self) -> DataFrame:
        """Samples of the cohort: all nations, one of them without a name."""
        key = F.col("n_nationkey").cast("long")
        return self.table("nation").select(F.when(key != 24, key).alias("sample"))

    def genotypes(self) -> DataFrame:
        """A call for every site and sample, some of them missing."""
        h, s = F.col("h"), F.coalesce("sample", F.lit(24))
        absent = (h + s * 7) % 11 < F.when(h % 13 > 10, 6).otherwise(1)
        gt = F.when(absent, "./.").when((h + s) % 3 == 0, "0/0").when((h + s) % 3 == 1, "0/1").otherwise("1/1")
        cells = with_roster(self.sites().select("chrom", "pos", "h"), self.roster(), "sample")
        return cells.select("chrom", "pos", "sample", gt.alias("gt"))

    def samples(self) -> DataFrame:
        """Base names of sequencing samples, some undetermined."""
        key = F.col("s_suppkey")
        base = F.concat(
            F.when(key % 25 == 7, "Undetermined").otherwise("Plant"),
            F.lit("_20"),
            _digits(F.col("s_nationkey") % 14 + 10, 2),
            F.lit("_"),
            _digits(key, 3),
            F.lit("_LIB"),
            (key + 250009700).cast("string"),
            F.lit("-1A_FLOW1_L"),
            (key % 4 + 1).cast("string"),
        )
        return self.table("supplier").select(key.alias("sample"), base.alias("base"))

    def targets(self) -> DataFrame:
        """Target loci with raw headers and sequences of 128 bases."""
        key = F.col("p_partkey")
        text = key.cast("string")
        header = F.concat(
            F.lit("NC_0338"),
            _digits(key % 11, 2),
            F.lit(".1_LG_"),
            (key % 11).cast("string"),
            F.lit("_"),
            (key * 500).cast("string"),
            F.lit("_"),
            (key * 500 + 127).cast("string"),
            F.lit("_ID_"),
            text,
            F.when(key % 10 == 0, ".merged").otherwise(""),
        )
        hashes = F.concat(*[F.md5(F.concat(F.lit(x), text)) for x in "abcd"])
        seq = F.translate(hashes, "0123456789abcdef", "ACGTACGTACGTACGT")
        return self.table("part").select(key.alias("locus_no"), header.alias("header"), seq.alias("seq"))

    def loci(self) -> DataFrame:
        """Targets with the numeric locus that contigs refer to."""
        return self.targets().select(F.col("locus_no").alias("locus"), "seq")

    def probes(self) -> DataFrame:
        """One to three probes of 100 bases per target."""
        key = F.col("locus_no")
        tiled = self.targets().select(
            key, "seq", F.explode(F.sequence(F.lit(1).cast("long"), key % 3 + 1)).alias("n")
        )
        header = F.concat(
            F.lit("dalb_"),
            key.cast("string"),
            F.lit("__CcLG"),
            _digits(key % 11 + 1, 2),
            F.lit("__"),
            (key * 500).cast("string"),
            F.lit("_"),
            (key * 500 + 199).cast("string"),
            F.lit("_p_"),
            F.col("n").cast("string"),
        )
        seq = F.substring("seq", ((F.col("n") - 1) * 14 + 1).cast("int"), F.lit(100))
        return tiled.select(header.alias("header"), seq.alias("seq"))

    def reads(self) -> DataFrame:
        """Read pairs cut from targets: some adapters, Ns, low tails, lone mates."""
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        # Short lines that become long reads: dealt out before they do.
        lines = spread(self.table("lineitem").select(*keys), *keys).distinct()
        order, part = F.col("l_orderkey"), F.col("l_partkey")
        mates = F.when(order % 41 == 0, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))
        one = F.substring("seq", F.expr("cast(1 + (l_orderkey*13 + l_linenumber*7) % 29 as int)"), F.lit(100))
        two = F.substring("seq", F.expr("cast(1 + (l_orderkey*11 + l_linenumber*5) % 29 as int)"), F.lit(100))
        cut = F.when(F.col("mate") == 1, one).otherwise(F.reverse(F.translate(two, "ACGT", "TGCA")))
        low = (order % 61).cast("int")
        tails = F.concat(F.repeat(F.lit("I"), 100 - low), F.repeat(F.lit("#"), low))
        seq = (
            F.when(part % 17 == 0, F.concat(F.substring("f", 1, 70), F.lit("AGATCGGAAGAGCACACGTCTGAACTCCAG")))
            .when(part % 23 == 0, F.concat(F.lit("N"), F.substring("f", 2, 99)))
            .otherwise(F.col("f"))
        )
        return (
            lines.join(self.loci(), lines["l_partkey"] == F.col("locus"))
            .withColumn("mate", F.explode(mates))
            .withColumn("f", cut)
            .select(
                _dashed(*keys).alias("read_id"),
                F.col("l_suppkey").alias("sample"),
                part.alias("true_locus"),
                "mate",
                seq.alias("seq"),
                tails.alias("qual"),
            )
        )

    def other_reads(self) -> DataFrame:
        """The reads with another adapter than the usual one."""
        usual, other = F.lit("AGATCGGAAGAGCACACGTCTGAACTCCAG"), F.lit("CTGTCTCTTATACACATCTCCGAGCCCACG")
        return self.reads().withColumn("seq", F.replace("seq", usual, other))

    def alignments(self) -> DataFrame:
        """Aligned records; a fifth is clipped, some are unmapped."""
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
        odd = (line % 2).cast("long")
        flag = (
            1
            + F.when(order % 7 != 0, 2).otherwise(0)
            + F.when(order % 19 == 0, 4).otherwise(0)
            + (part % 2) * 16
            + odd * 64
            + (1 - odd) * 128
        )
        return (
            self.table("lineitem")
            .select(*keys)
            .distinct()
            .select(
                _dashed(*keys).alias("qname"),
                F.col("l_suppkey").alias("sample"),
                F.concat(F.lit("chr"), _digits(part % 14 + 1, 2)).alias("rname"),
                (part % 200 * 50 + line % 3 + 1).cast("long").alias("pos"),
                ((order * 7 + part * 3) % 61).cast("int").alias("mapq"),
                flag.cast("int").alias("flag"),
                F.when(line % 5 == 0, "5S95M").otherwise("100M").alias("cigar"),
                (part % 200 * 50 + 201).cast("long").alias("pnext"),
                (order % 700 + 3000).cast("int").alias("sum_bq"),
            )
        )

    def template_records(self) -> DataFrame:
        """Records of read pairs, two lines of an order to a pair: lone and unmapped mates, clips, two
        orientations, some secondary or supplementary records, five libraries and none, one of them crowded."""
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        lines = self.table("lineitem").select(order.alias("o"), line.cast("long").alias("n")).distinct()
        o, n = F.col("o"), F.col("n")
        extra = F.when(n == 7, 2048).when((n == 5) & (o % 13 == 0), 256).otherwise(0)
        pair = F.when(extra > 0, 1).otherwise(F.floor((n + 1) / 2))
        second = (extra == 0) & (n % 2 == 0)
        place = (o * 31 + pair * 7) % F.when(o % 6 == 0, 101).otherwise(20011)
        reverse = second != (o % 23 == 0)
        unmapped = second & (o % 19 == 0)
        clipped = (o + n) % 5 == 0
        start = place * 10 + 1 + F.when(reverse, 150 + o % 3 * 10).otherwise(0) + F.when(extra > 0, 5000).otherwise(0)
        flag = (
            1
            + F.when(o % 19 != 0, 2).otherwise(0)
            + F.when(unmapped, 4).otherwise(0)
            + F.when((o % 19 == 0) & ~second, 8).otherwise(0)
            + F.when(reverse, 16).otherwise(0)
            + F.when(second, 128).otherwise(64)
            + extra
        )
        return lines.select(
            F.concat_ws("-", o.cast("string"), pair.cast("string")).alias("qname"),
            (o % 12).alias("sample"),
            F.when(o % 6 != 5, F.concat(F.lit("lib"), (o % 6).cast("string"))).alias("library"),
            F.concat(F.lit("chr"), _digits(place % 14 + 1, 2)).alias("rname"),
            F.when(clipped & ~reverse, start + 5).otherwise(start).alias("pos"),
            flag.cast("int").alias("flag"),
            F.when(unmapped, "*").when(clipped & reverse, "95M5S").when(clipped, "5S95M").otherwise("100M").alias("cigar"),
            (3000 + (o * 7 + n) % 700).cast("int").alias("sum_bq"),
        )

    def target_alignments(self) -> DataFrame:
        """Records with bases on targets: some secondary, failed, without bases or sample, some bases N or lower case."""
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        order, line = F.col("l_orderkey"), F.col("l_linenumber")
        at = F.expr("1 + (l_orderkey*13 + l_linenumber*7) % 29")
        own = F.substring("seq", at.cast("int"), F.lit(100))
        seq = (
            F.when(order % 31 == 0, "*")
            .when(order % 7 == 0, F.concat(F.lit("N"), F.substring(own, 2, 99)))
            .when(order % 11 == 0, F.concat(F.lit("G"), F.substring(own, 2, 99)))
            .when(order % 5 == 0, F.lower(own))
            .otherwise(own)
        )
        flag = F.when(line == 3, 256).when(line == 4, 512).when(line == 5, 2048).when(line == 6, 1024).otherwise(0)
        return (
            self.table("lineitem")
            .select(*keys)
            .distinct()
            .join(self.loci(), F.col("l_partkey") == F.col("locus"))
            .select(
                _dashed(*keys).alias("qname"),
                F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("sample"),
                F.col("locus").cast("string").alias("rname"),
                at.cast("long").alias("pos"),
                ((order * 7) % 61).cast("int").alias("mapq"),
                flag.cast("int").alias("flag"),
                F.lit("100M").alias("cigar"),
                seq.alias("seq"),
                F.concat(
                    F.repeat(F.lit("I"), 100 - (order % 61).cast("int")), F.repeat(F.lit("#"), (order % 61).cast("int"))
                ).alias("qual"),
            )
        )

    def masked_reference(self) -> DataFrame:
        """Targets as a reference, a third of them in lower case."""
        seq = F.when(F.col("locus") % 3 == 0, F.lower("seq")).otherwise(F.col("seq"))
        return self.loci().select(F.col("locus").cast("string").alias("name"), seq.alias("seq"))

    def pileup(self) -> DataFrame:
        """Aligned bases of twelve samples, one of them null, over two sites per pair of parts; some with two or three alternatives."""
        part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
        step = (
            F.when((line % 3 == 0) & ((part * 7 + supp % 12) % 3 != 0), 1)
            .when((line == 5) & (part % 4 == 1) & (supp % 12 < 7), 2)
            .when((line == 7) & (part % 8 == 1), 3)
            .otherwise(0)
        )
        return self.table("lineitem").select(
            F.when(supp % 12 != 11, (supp % 12).cast("int")).alias("sample"),
            F.concat(F.lit("chr0"), (part % 2 + 1).cast("string")).alias("chrom"),
            (F.floor(part / 2) + 1001).cast("long").alias("pos"),
            _base(part).alias("ref"),
            _base(part + step).alias("base"),
            (F.col("l_orderkey") % 21 + 20).cast("int").alias("bq"),
            ((F.col("l_orderkey") * 7 + part * 3) % 61).cast("int").alias("mapq"),
            (F.col("l_orderkey") % 2).cast("int").alias("strand"),
            (F.col("l_orderkey") % 100 + 1).cast("int").alias("read_pos"),
        )

    def blocks(self) -> DataFrame:
        """Reference-confidence intervals per sample."""
        start = F.col("l_orderkey") * 1000
        return (
            self.table("lineitem")
            .groupBy(
                F.when(F.col("l_suppkey") % 12 != 11, (F.col("l_suppkey") % 12).cast("int")).alias("sample"),
                F.concat(F.lit("chr"), _digits(F.col("l_partkey") % 14 + 1, 2)).alias("chrom"),
                start.alias("start"),
                (start + F.floor("l_quantity") * 20).alias("stop"),
            )
            .agg(F.min(F.col("l_partkey") % 100).cast("int").alias("gq"))
        )

    def contigs(self) -> DataFrame:
        """Assembled contigs; loci divisible by 13 may have copies, by 39 always do."""
        part = F.col("l_partkey")
        number = F.when(part % 13 == 0, F.col("l_linenumber")).otherwise(1)
        grouped = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("sample"), part.alias("locus"), number.alias("number"))
            .agg(F.max("l_quantity").alias("q"), F.max("l_extendedprice").alias("x"))
        )
        each = F.when(F.col("locus") % 39 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        q, x, n = F.floor("q").cast("int"), F.floor("x").cast("int"), F.col("n")
        exon = 20 + q * 2 - n * 5
        return grouped.withColumn("n", F.explode(each)).select(
            "sample",
            "locus",
            (F.col("number") + n * 7).alias("contig_no"),
            exon.alias("exon_len"),
            (exon + x % 400).alias("supercontig_len"),
            q.alias("depth"),
        )

    def files(self) -> DataFrame:
        """File manifests of two sides; the second lacks some and changed some."""
        key = F.col("o_orderkey")
        path = F.concat(F.lit("all_fastq/"), key.cast("string"), F.lit("_1.fq.gz"))
        size = F.floor("o_totalprice")
        orders = self.table("orders")

        def side(name: str, df: DataFrame, number: Column) -> DataFrame:
            return df.select(
                F.lit(name).alias("side"),
                path.alias("path"),
                size.alias("size"),
                F.md5(number.cast("string")).alias("checksum"),
            )

        changed = key + F.when(key % 89 == 0, 1).otherwise(0)
        return side("source", orders, key).unionByName(side("dest", orders.where(key % 97 != 0), changed))

    def seqs(self) -> DataFrame:
        """Contigs of a reference: 14 chromosomes, the others scaffolds."""
        key = F.col("p_partkey")
        main = key < 14
        name = F.when(main, F.concat(F.lit("chr"), _digits(key + 1, 2))).otherwise(
            F.concat(F.lit("scaffold_"), key.cast("string"))
        )
        length = F.when(main, key * 1000003 + 40000000).otherwise(key * 7919 % 635000 + 25000)
        return self.table("part").select(name.alias("name"), length.alias("length"), key.alias("ord"))


INPUT_SQL = {
    "fx_sites": """
        select chrom, pos, ref, alt, qual, qd, fs, sor, mq,
          case when h%5=0 then null else mqrs end as mqranksum,
          case when h%5=0 then null else rprs end as readposranksum, dp, h
        from (
          select case when k%16<14 then concat('chr',lpad(cast(k%16+1 as varchar),2,'0'))
                      else concat('scaffold_',cast(k%16 as varchar)) end as chrom,
            l_orderkey*1000+l_linenumber*37+1 as pos,
            case when h%37=0 then concat(substr('ACGT',cast(k%4+1 as int),1),'G')
                 else substr('ACGT',cast(k%4+1 as int),1) end as ref,
            case when h%29=0 then concat(substr('ACGT',cast((k+1)%4+1 as int),1),',',substr('ACGT',cast((k+2)%4+1 as int),1))
                 else substr('ACGT',cast((k+1+h%3)%4+1 as int),1) end as alt,
            cast(250+h%9001 as double)/10 as qual, cast(h%349 as double)/10 as qd,
            cast(h%653 as double)/10 as fs, cast(h%37 as double)/10 as sor,
            cast(350+h%251 as double)/10 as mq, cast(h%263-131 as double)/10 as mqrs,
            cast(h%173-86 as double)/10 as rprs, 61*5+h%3001 as dp, h
          from (select l_orderkey, l_linenumber, max(l_partkey) as k,
                  l_orderkey*7919+max(l_partkey)*104729+l_linenumber*17 as h
                from lineitem group by l_orderkey, l_linenumber))""",
    "fx_roster": "select case when n_nationkey <> 24 then cast(n_nationkey as bigint) end as sample from nation",
    "fx_genotypes": """
        select chrom, pos, sample,
          case when (h+coalesce(sample,24)*7)%11 < (case when h%13>10 then 6 else 1 end) then './.'
               when (h+coalesce(sample,24))%3=0 then '0/0' when (h+coalesce(sample,24))%3=1 then '0/1' else '1/1' end as gt
        from fx_sites, fx_roster""",
    "fx_samples": """
        select s_suppkey as sample,
          concat(case when s_suppkey%25=7 then 'Undetermined' else 'Plant' end,'_20',
            lpad(cast(10+s_nationkey%14 as varchar),2,'0'),'_',lpad(cast(s_suppkey as varchar),3,'0'),
            '_LIB',cast(250009700+s_suppkey as varchar),'-1A_FLOW1_L',cast(s_suppkey%4+1 as varchar)) as base
        from supplier""",
    "fx_targets": """
        select p_partkey as locus_no,
          concat('NC_0338',lpad(cast(p_partkey%11 as varchar),2,'0'),'.1_LG_',cast(p_partkey%11 as varchar),'_',
            cast(p_partkey*500 as varchar),'_',cast(p_partkey*500+127 as varchar),'_ID_',cast(p_partkey as varchar),
            case when p_partkey%10=0 then '.merged' else '' end) as header,
          translate(concat(md5(concat('a',cast(p_partkey as varchar))),md5(concat('b',cast(p_partkey as varchar))),
            md5(concat('c',cast(p_partkey as varchar))),md5(concat('d',cast(p_partkey as varchar)))),
            '0123456789abcdef','ACGTACGTACGTACGT') as seq
        from part""",
    "fx_loci": "select locus_no as locus, seq from fx_targets",
    "fx_probes": """
        select concat('dalb_',cast(locus_no as varchar),'__CcLG',lpad(cast(locus_no%11+1 as varchar),2,'0'),'__',
            cast(locus_no*500 as varchar),'_',cast(locus_no*500+199 as varchar),'_p_',cast(n as varchar)) as header,
          substr(seq, cast(1+(n-1)*14 as int), 100) as seq
        from fx_targets, (values (1),(2),(3)) t(n) where n <= 1+locus_no%3""",
    "fx_reads": """
        select concat_ws('-',cast(l_orderkey as varchar),cast(l_linenumber as varchar),cast(l_partkey as varchar),cast(l_suppkey as varchar)) as read_id,
          l_suppkey as sample, l_partkey as true_locus, m as mate,
          case when l_partkey%17=0 then concat(substr(f,1,70),'AGATCGGAAGAGCACACGTCTGAACTCCAG')
               when l_partkey%23=0 then concat('N',substr(f,2,99)) else f end as seq,
          concat(repeat('I',cast(100-l_orderkey%61 as int)),repeat('#',cast(l_orderkey%61 as int))) as qual
        from (
          select l_orderkey, l_linenumber, l_partkey, l_suppkey, m,
            case when m=1 then substr(seq, cast(1+(l_orderkey*13+l_linenumber*7)%29 as int), 100)
                 else translate(reverse(substr(seq, cast(1+(l_orderkey*11+l_linenumber*5)%29 as int), 100)),'ACGT','TGCA') end as f
          from (select distinct l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem)
          join fx_loci on l_partkey=locus, (values (1),(2)) t(m)
          where not (m=2 and l_orderkey%41=0))""",
    "fx_other_reads": """
        select * replace (replace(seq,'AGATCGGAAGAGCACACGTCTGAACTCCAG','CTGTCTCTTATACACATCTCCGAGCCCACG') as seq) from fx_reads""",
    "fx_alignments": """
        select distinct concat_ws('-',cast(l_orderkey as varchar),cast(l_linenumber as varchar),cast(l_partkey as varchar),cast(l_suppkey as varchar)) as qname,
          l_suppkey as sample, concat('chr',lpad(cast(l_partkey%14+1 as varchar),2,'0')) as rname,
          cast(1+l_partkey%200*50+l_linenumber%3 as bigint) as pos,
          cast((l_orderkey*7+l_partkey*3)%61 as int) as mapq,
          cast(1+2*(case when l_orderkey%7<>0 then 1 else 0 end)+4*(case when l_orderkey%19=0 then 1 else 0 end)
             +16*(l_partkey%2)+64*(l_linenumber%2)+128*(1-l_linenumber%2) as int) as flag,
          case when l_linenumber%5=0 then '5S95M' else '100M' end as cigar,
          cast(1+l_partkey%200*50+200 as bigint) as pnext, cast(3000+l_orderkey%700 as int) as sum_bq
        from lineitem""",
    "fx_template_records": """
        select concat(cast(o as varchar),'-',cast(p as varchar)) as qname, o%12 as sample,
          case when o%6<>5 then concat('lib',cast(o%6 as varchar)) end as library,
          concat('chr',lpad(cast(place%14+1 as varchar),2,'0')) as rname,
          place*10+1+(case when rev then 150+o%3*10 else 0 end)+(case when extra>0 then 5000 else 0 end)
            +(case when (o+n)%5=0 and not rev then 5 else 0 end) as pos,
          cast(1+(case when o%19<>0 then 2 else 0 end)+(case when snd and o%19=0 then 4 else 0 end)
            +(case when o%19=0 and not snd then 8 else 0 end)+(case when rev then 16 else 0 end)
            +(case when snd then 128 else 64 end)+extra as int) as flag,
          case when snd and o%19=0 then '*' when (o+n)%5=0 and rev then '95M5S' when (o+n)%5=0 then '5S95M' else '100M' end as cigar,
          cast(3000+(o*7+n)%700 as int) as sum_bq
        from (select *, (o*31+p*7)%(case when o%6=0 then 101 else 20011 end) as place, snd<>(o%23=0) as rev
          from (select o, n, extra, case when extra>0 then 1 else (n+1)//2 end as p, extra=0 and n%2=0 as snd
            from (select o, n, case when n=7 then 2048 when n=5 and o%13=0 then 256 else 0 end as extra
              from (select distinct l_orderkey as o, cast(l_linenumber as bigint) as n from lineitem))))""",
    "fx_target_alignments": """
        select locus, case when l_suppkey%5<>0 then l_suppkey end as sample, 1+(l_orderkey*13+l_linenumber*7)%29 as pos,
          case l_linenumber when 3 then 256 when 4 then 512 when 5 then 2048 when 6 then 1024 else 0 end as flag,
          case when l_orderkey%31=0 then '*' when l_orderkey%7=0 then concat('N',substr(f,2,99))
               when l_orderkey%11=0 then concat('G',substr(f,2,99)) when l_orderkey%5=0 then lower(f) else f end as seq,
          concat(repeat('I',cast(100-l_orderkey%61 as int)),repeat('#',cast(l_orderkey%61 as int))) as qual
        from (select distinct l_orderkey, l_linenumber, l_suppkey, locus,
                substr(seq, cast(1+(l_orderkey*13+l_linenumber*7)%29 as int), 100) as f
              from lineitem join fx_loci on l_partkey=locus)""",
    "fx_pileup": """
        select case when l_suppkey%12<>11 then cast(l_suppkey%12 as int) end as sample,
          concat('chr0',cast(l_partkey%2+1 as varchar)) as chrom, l_partkey//2+1001 as pos,
          substr('ACGT',cast(l_partkey%4+1 as int),1) as ref,
          substr('ACGT',cast((l_partkey+case when l_linenumber%3=0 and (l_partkey*7+l_suppkey%12)%3<>0 then 1
              when l_linenumber=5 and l_partkey%4=1 and l_suppkey%12<7 then 2
              when l_linenumber=7 and l_partkey%8=1 then 3 else 0 end)%4+1 as int),1) as base,
          cast(20+l_orderkey%21 as int) as bq, cast((l_orderkey*7+l_partkey*3)%61 as int) as mapq,
          cast(l_orderkey%2 as int) as strand, cast(1+l_orderkey%100 as int) as read_pos
        from lineitem""",
    "fx_blocks": """
        select case when l_suppkey%12<>11 then cast(l_suppkey%12 as int) end as sample, concat('chr',lpad(cast(l_partkey%14+1 as varchar),2,'0')) as chrom,
          l_orderkey*1000 as start, l_orderkey*1000+cast(floor(l_quantity) as bigint)*20 as stop,
          cast(min(l_partkey%100) as int) as gq
        from lineitem group by 1,2,3,4""",
    "fx_contigs": """
        select sample, locus, number+n*7 as contig_no, 20+q*2-n*5 as exon_len,
          20+q*2-n*5+x%400 as supercontig_len, q as depth
        from (select l_suppkey as sample, l_partkey as locus,
                case when l_partkey%13=0 then l_linenumber else 1 end as number,
                cast(floor(max(l_quantity)) as int) as q, cast(floor(max(l_extendedprice)) as int) as x
              from lineitem group by 1,2,3), (values (0),(1)) t(n)
        where n=0 or locus%39=0""",
    "fx_files": """
        select 'source' as side, concat('all_fastq/',cast(o_orderkey as varchar),'_1.fq.gz') as path,
          cast(floor(o_totalprice) as bigint) as size, md5(cast(o_orderkey as varchar)) as checksum
        from orders
        union all
        select 'dest', concat('all_fastq/',cast(o_orderkey as varchar),'_1.fq.gz'), cast(floor(o_totalprice) as bigint),
          md5(cast(o_orderkey+(case when o_orderkey%89=0 then 1 else 0 end) as varchar))
        from orders where o_orderkey%97<>0""",
    "fx_seqs": """
        select case when p_partkey<14 then concat('chr',lpad(cast(p_partkey+1 as varchar),2,'0'))
                    else concat('scaffold_',cast(p_partkey as varchar)) end as name,
          case when p_partkey<14 then 40000000+p_partkey*1000003 else 25000+(p_partkey*7919)%635000 end as length,
          p_partkey as ord
        from part""",
}
