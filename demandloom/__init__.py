"""Panel-demand analytics written as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing here starts a
session or pulls table data to the driver.
"""

from demandloom.settings import DEFAULTS, Guardrails, ReplayPolicy, Settings

__all__ = ["DEFAULTS", "Guardrails", "ReplayPolicy", "Settings"]
