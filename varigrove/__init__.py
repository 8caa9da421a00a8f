"""varigrove: sequencing-cohort analytics as Spark DataFrame operators.

Packages
    functions   column expressions over names, bases, flags, alleles, percents
    sources     readers and writers for the text formats of a study
    operators   table-in, table-out operators (reads, mapping, calling,
                variants, cohort QC, target recovery, paralogs, shared joins)
    plans       end-to-end chains, test inputs, registered queries, oracle SQL
    streaming   incremental landing of new files
"""
