"""The corpus pipeline's stages, their run, and SQL for it; defined in ``newsweft.llm.pipeline``."""

from newsweft.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
