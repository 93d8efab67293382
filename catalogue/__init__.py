"""Every registered query: its Spark form and, where SQL can say it, the SQL to compare with."""

from catalogue import batch, landing, models, streams  # noqa: F401
from catalogue.registry import ORACLES, QUERIES  # noqa: F401
