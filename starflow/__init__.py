"""Layered event-to-star-schema processing on PySpark.

Raw JSON visit events are landed unchanged, parsed and repaired, and turned into
a type-2 patient dimension, an insert-only department dimension and an upserted,
date-partitioned fact table, on which the bed KPIs run.  Everything outside
``sources``, ``sinks`` and ``streaming`` is a plain DataFrame-to-DataFrame
function with its clock passed in.
"""
