"""Micro-batch adapter: the technical checks on each batch of a file stream."""

from veritab.streaming.micro_batch import batch_verdicts, validate_stream  # noqa: F401
