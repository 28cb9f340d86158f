"""Supply-chain exception analytics as Spark DataFrame jobs."""

from tidewatch.settings import RuleSettings, configure, utc_instant

__all__ = ["RuleSettings", "configure", "utc_instant"]
