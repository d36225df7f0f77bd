"""Job-level compositions of the operators."""

from .trace import trace, trace_stays, trace_to

__all__ = ["trace", "trace_stays", "trace_to"]
