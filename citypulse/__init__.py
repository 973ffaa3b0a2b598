"""citypulse: Spark-native batch analytics over multi-part incident tables.

Every public function takes and returns DataFrames; the work stays inside
Catalyst plans (no Python UDFs, nothing collected to the driver).

Sub-packages:
    sources    readers (header CSV, typed CSV, parquet), multi-part union and
               the reference-shaped views built from the driver tables
    functions  column expressions: lenient casts, money/ZIP parsing,
               day-part labels, code decoding, ellipsoidal distance
    operators  dedupe, top-N per group, top/bottom-k, join strategies,
               nearest-station search
    plans      the end-to-end reports (ingest, top months, day parts,
               income extremes, station distances)
"""

__version__ = "0.1.0"
