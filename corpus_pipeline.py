"""A corpus in five stages; see ``tributary.llm.pipeline``."""

from tributary.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
