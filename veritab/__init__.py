"""veritab — metadata-driven table validation on Spark DataFrames.

Tables are described by metadata (a catalog of tables and one rule row per
column).  Every check is a DataFrame operator that runs distributed and
returns either the offending rows or a verdict row (rule, violations,
passed).  A staged run combines the checks of many tables into one verdict
frame, derives status flags and builds the status / error log frames.

Layout:
  sources/    readers, sinks, literal frames, schema clones
  functions/  column expressions: type predicates, cell notation, rule decoding, flags
  operators/  checks: metadata, header, technical, referential, functional
  plans/      verdict frames, staged run, log frames
  streaming/  micro-batch adapter running the same checks per batch
"""

from veritab.session import get_session, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
