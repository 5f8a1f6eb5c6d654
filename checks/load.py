"""Imports every module that registers queries."""

from . import aggregates  # noqa: F401
from . import comparisons  # noqa: F401
from . import audit  # noqa: F401
from . import texts  # noqa: F401
from . import outreach  # noqa: F401
from . import batch  # noqa: F401
