"""Expressions over sample names, paths, sequence headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Platform tag of every read group, taxon label of target headers.
PLATFORM = "ILLUMINA"
TARGET_TAXON = "Cajanus_cajan"


def file_name(path: Column) -> Column:
    return F.regexp_replace(path, "^.*/", "")


def strip_path(path: Column, suffix: str) -> Column:
    """File name without its directory and without a literal suffix."""
    name = file_name(path)
    stem = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    return F.when(name.endswith(suffix), stem).otherwise(name)


def mate_number(path: Column) -> Column:
    """1 or 2 from `_1.` / `_2.` (an optional `.trim` may follow), else null."""
    name = file_name(path)
    return F.regexp_extract(name, r"_([12])(?:\.trim)?\.f(?:ast)?q(?:\.gz)?$", 1).try_cast("int")


def fastq_base(path: Column) -> Column:
    """Sample base name of a FASTQ file name."""
    return F.regexp_replace(file_name(path), r"_[12](\.trim)?\.f(ast)?q(\.gz)?$", "")


def sample_name(base: Column) -> Column:
    """First three `_` fields."""
    return F.substring_index(base, "_", 3)


def read_group(base: Column) -> dict[str, Column]:
    """Read-group fields spelled out in a base name."""
    sm = sample_name(base)
    unit = F.substring_index(base, "_", -2)
    return {
        "sm": sm,
        "lb": F.split(base, "_").getItem(3),
        "pl": F.lit(PLATFORM),
        "pu": unit,
        "rgid": F.concat_ws("_", sm, unit),
    }


def is_undetermined(base: Column) -> Column:
    return base.startswith("Undetermined")


def rewrite_target_header(header: Column, taxon: str = TARGET_TAXON) -> Column:
    """`..._ID_<digits>...` becomes `<taxon>-<digits>`; other headers stay."""
    return F.regexp_replace(header, r".*_ID_([0-9]*).*", f"{taxon}-$1")


def locus_of(header: Column) -> Column:
    """Text after the last dash."""
    return F.substring_index(header, "-", -1)


# Fixed format: <prefix>_<region>__<group>__<start>_<stop>_p_<number>
PROBE = r"^[^_]*_([0-9]+)__([^_]+)__([0-9]+)_([0-9]+)_p_([0-9]+)$"


def probe_fields(header: Column) -> dict[str, Column]:
    part = lambda i: F.regexp_extract(header, PROBE, i)
    return {
        "region_id": part(1).try_cast("int"),
        "linkage_group": F.nullif(part(2), F.lit("")),
        "start": part(3).try_cast("bigint"),
        "stop": part(4).try_cast("bigint"),
        "probe_no": part(5).try_cast("int"),
    }
