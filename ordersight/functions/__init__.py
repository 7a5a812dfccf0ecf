"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""
from .scalars import *  # noqa: F401,F403
