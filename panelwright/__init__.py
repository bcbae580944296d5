"""Indicator-panel analytics and forecasting as Spark DataFrame operators.

Every operator takes DataFrames and returns DataFrames.  The scale axis is the
entity: ``entity_cols`` names the columns that identify one series group, and a
single-entity panel is simply the case of one group.
"""

__version__ = "0.1.0"
