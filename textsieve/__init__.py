"""textsieve: labelled-text classification written as Spark DataFrame operators.

Every public operator takes DataFrames and returns DataFrames; nothing is
collected to the driver except small, size-bounded model tables.
"""

from textsieve.config import Options

__all__ = ["Options"]
__version__ = "0.1.0"
