"""adlens: ad-exposure reports, exposure streams and video segmentation on Spark.

Main entry points:

* ``adlens.operators.reports``: exposure / bid-success / bid-failure reports (R-1 ... R-7)
* ``adlens.operators.counters``: exposure counts, running day totals, cap flags
* ``adlens.operators.segments.segment_videos``: tagged intervals -> segments (R-11)
* ``adlens.streaming.deal_stream``: the exposure counter and parse streams (R-8, R-9)
* ``adlens.sinks``: keyed merges and per-partition writers
* ``adlens.plans.jobs`` / ``adlens.plans.cli``: the end-to-end jobs
"""
