"""Conversation analytics as Spark jobs.

Every stage takes and returns DataFrames keyed by ``id``; nothing relies on
row position.  See the README for the stage list.
"""

__version__ = "0.1.0"
