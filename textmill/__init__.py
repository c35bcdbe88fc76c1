"""textmill: cleaning, exploring and classifying tagged text with Spark DataFrames."""

from textmill.session import build_session

__all__ = ["build_session"]
__version__ = "0.1.0"
