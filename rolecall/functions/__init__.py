"""Column expressions used by the jobs in ``rolecall.operators``."""
