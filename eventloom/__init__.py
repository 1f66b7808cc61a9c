"""Event-log analytics and process-decision modelling on Spark DataFrames."""

from eventloom.spec import LogSpec
from eventloom.session import build_session

__all__ = ["LogSpec", "build_session"]
