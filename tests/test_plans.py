"""What the physical plans may and may not hold."""

import pytest

from paths import SMALL
from varigrove.plans import queries

# Lines of FASTQ files folded into records, and a data source of its own for block gzip.
PYTHON_QUERIES = {"fastq_file", "vcf_blocks_file"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries.registered()))
def test_plan(spark, name):
    text = plan(queries.registered()[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_QUERIES:
        assert "Python" not in text and "Pandas" not in text


def test_filters_reach_the_scan(spark, tmp_path):
    from varigrove.operators import mapping
    from varigrove.plans.inputs import Inputs

    path = str(tmp_path / "aln")
    Inputs(spark, SMALL).alignments().write.parquet(path)
    text = plan(mapping.min_mapq(spark.read.parquet(path)).select("sample", "mapq"))
    assert "GreaterThanOrEqual(mapq,30)" in text
    assert "ReadSchema: struct<sample:bigint,mapq:int>" in text


def test_reports_read_only_their_columns(spark, tmp_path):
    from varigrove.operators import reads
    from varigrove.plans.inputs import Inputs

    path = str(tmp_path / "reads")
    Inputs(spark, SMALL).reads().write.parquet(path)
    text = plan(reads.read_quality_hist(spark.read.parquet(path)))
    assert "ReadSchema: struct<sample:bigint,mate:int,qual:string>" in text
