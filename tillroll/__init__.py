"""Receipt and invoice analytics as Spark jobs.

OCR responses for scanned bills go in; a typed ``keyvalue`` table (one row per
receipt) and a typed ``lineitem`` table (one row per bought item) come out.
Everything is DataFrame / Column algebra: no Python workers in any plan.
"""
