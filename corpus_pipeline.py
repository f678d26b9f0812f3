"""The corpus pipeline of ``methspark.llm.pipeline``: its stages, their SQL and run(spark, sf_dir)."""

from methspark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
