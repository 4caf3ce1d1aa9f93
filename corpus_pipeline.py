"""The corpus pipeline of the training-data operators: STAGES, run and ORACLE_SQL, see sievework.llm.pipeline."""

from sievework.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
