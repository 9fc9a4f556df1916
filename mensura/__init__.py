"""mensura — a Spark-native toolkit for audited monthly trade series.

Every public operator is a DataFrame -> DataFrame (or Column -> Column)
function built on the public PySpark API.  Nothing collects data to the
driver; rules, fingerprints and audits are themselves DataFrames.

Sub-packages
------------
functions   scalar Column expressions (text cleaning, number/date parsing,
            calendar attributes, guarded ratios, tolerances, hashing)
operators   reshape, set, join, aggregate, window, ordering, quality-rule
            and audit operators
sources     manifest / file / cell / link / snapshot scans
sinks       table writes, lineage properties, verified exports, run log,
            conditional compaction
plans       composite datasets (national series, markets, star schemas)
            wired to the driver's parquet tables
"""

__all__ = ["functions", "operators", "sources", "sinks", "plans"]
