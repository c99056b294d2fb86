"""shopstar: a retail star-schema warehouse on Spark DataFrames.

sources/    schemas, the TPC-H-ish -> retail fixture, file/table I/O, stores
functions/  column helpers: cleaning, exact money/ratio rounding, filters
operators/  global order (bucketed prefix sums), segmented running sums,
            interval join
plans/      staging, star build, analytics, pricing, quality checks, guarded
            SQL, upsert, pipeline, warehouse cache
streaming/  none (the modelled system is batch only)
"""
