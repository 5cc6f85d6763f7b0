"""gridtally: electricity-market backtesting tables as Spark jobs."""

from gridtally.operators.calendar import HorizonMap
from gridtally.operators.network import Network

__all__ = ["HorizonMap", "Network"]
__version__ = "0.1.0"
