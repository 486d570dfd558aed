"""playtrail: how viewers come to watch what they watch, on Spark.

Merges a clickstream with a video-playback log into one ordered timeline per
account, day and device, labels each video start (auto-played, clicked from
an up-next prompt, or chosen by hand), credits watched seconds to the start
that caused them, and reports a two-title funnel and a daily coverage
monitor on top. Everything is DataFrame code: column functions, windows,
joins and partitioned tables.
"""

from .functions.rules import R1, R2, R3, R4, RULE_SETS, RuleSet, rule_set
from .operators.attribution import build_attribution

__all__ = ["R1", "R2", "R3", "R4", "RULE_SETS", "RuleSet", "rule_set", "build_attribution"]
