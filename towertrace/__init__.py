"""towertrace: contact tracing on enter/exit event tables with Spark.

Events (cellid, times, register, phone) become stays under one of four
pairing rules; stays overlapping a subject's stay on the same tower give
the contacts.  Everything is DataFrame/SQL operators.
"""

from .operators import intervals, find_contacts
from .plans import trace, trace_stays, trace_to

__all__ = ["intervals", "find_contacts", "trace", "trace_stays", "trace_to"]
