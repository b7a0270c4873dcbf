"""chartlake: dated top-item snapshot analytics on Spark DataFrames.

Layers:
  sources/    landing-zone NDJSON scan and sink, parquet table loading
  functions/  column expressions (safe indexing, partial dates, decades)
  operators/  DataFrame -> DataFrame operators (staging, dims, fact, marts, enrichment)
  plans/      the model run (materialisation), the scale binding, the query registry
  streaming/  incremental landing -> dimension upsert with Structured Streaming
"""

__all__ = ["session"]
