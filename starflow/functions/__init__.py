"""Column expressions shared by the operators."""

from starflow.functions.audit import audit_columns, load_time
from starflow.functions.compare import any_differs, differs

__all__ = [
    "any_differs",
    "audit_columns",
    "differs",
    "load_time",
]
