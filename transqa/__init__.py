"""transqa: document translation and translation quality work as Spark DataFrames."""

from transqa.config import Endpoints, Prefixes, Settings

__all__ = ["Endpoints", "Prefixes", "Settings"]
