"""logpulse: log and event health analytics as Spark DataFrame operators."""

from logpulse.constants import LEVELS, HealthParams  # noqa: F401
