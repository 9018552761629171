"""Verdict frames, the staged run over many tables, and the log frames."""

from veritab.plans import logs, staged_run, verdicts  # noqa: F401
from veritab.plans.staged_run import (  # noqa: F401
    FunctionalSpec, TableSpec, run_verdicts, specs_from_metadata, table_verdicts,
)
