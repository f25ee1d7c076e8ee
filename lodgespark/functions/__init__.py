"""Row-level functions: every one is a native Column expression (no Python UDF)."""

from lodgespark.functions.scalars import *  # noqa: F401,F403
from lodgespark.functions.scalars import __all__  # noqa: F401
