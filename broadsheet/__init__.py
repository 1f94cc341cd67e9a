"""Corpus curation on Spark: feeds, pages, papers and logs in; editions, queues and audits out.

Every operator takes and returns DataFrames (or Columns), so a whole job stays one Catalyst plan.
"""
