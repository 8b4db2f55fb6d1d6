"""canopy: tree-ensemble and linear-model analytics on Spark DataFrames.

Layout
------
sources/    text lines -> labelled feature rows; PMML documents -> node tables
sinks/      node tables -> PMML text; metric and model reports
functions/  Column-level helpers (hash buckets, votes, metrics)
operators/  DataFrame operators: splits, scaling, binning, split scans,
            level-wise tree growth, pyspark.ml training, node scoring, linear SGD
plans/      end-to-end jobs composed from the operators, and sizing rules
streaming/  scoring of streaming DataFrames with a node table
models/     fixed model documents (the two bundled Iris forests) as node rows
"""

__version__ = "0.1.0"
