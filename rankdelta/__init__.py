"""rankdelta: best-seller ranking snapshots and their day/week movement, on Spark.

Layout:
  functions/  column expressions (text cleaning, price readers, status text)
  operators/  DataFrame -> DataFrame steps (cleaning chain, baseline picks,
              rank changes, report shapes)
  sources/    stored listing pages -> ranked rows, snapshot table I/O, report sink
  plans/      fixture feeds derived from the driver tables + the query registry
  streaming/  incremental runner: new snapshot batches -> appended table + report
"""

__version__ = "0.1.0"
