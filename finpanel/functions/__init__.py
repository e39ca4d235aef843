"""Column expressions (pure, null-safe)."""

from finpanel.functions.scalar import *  # noqa: F401,F403
