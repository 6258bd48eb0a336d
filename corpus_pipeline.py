"""From raw documents to a training mix, one operator a stage: toxicity, near-dedup, decontamination, personal data, mixing."""

from tallybook.llm.stages import STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]

#: A fitted classifier, sampled hashes and keyed hashes are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None
