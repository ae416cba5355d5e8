"""The training-data pipeline: the quality classifier, SimHash near-dedup, suffix-array dedup, benchmark decontamination and mixing in turn.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; see gridloom/llm/pipeline.py.
"""

from gridloom.llm.pipeline import NEAR_BITS, ORACLE_SQL, STAGES, mixture, near_dedup, quality_filter, repeated_bytes, run, without_benchmark

__all__ = ["NEAR_BITS", "ORACLE_SQL", "STAGES", "mixture", "near_dedup", "quality_filter", "repeated_bytes", "run", "without_benchmark"]
