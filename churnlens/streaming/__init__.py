"""Micro-batch publishing.

The pipeline itself is batch (every job takes an as-of date). What runs continuously
in production is publishing: staged prediction files land in a folder, and each new
file set must replace the rows of its RunDate in the published table. This module
does exactly that with Structured Streaming: a file source over the staged folder,
``foreachBatch`` calling the idempotent RunDate sink, and a checkpoint in the shared
checkpoint folder so a restarted query resumes without re-publishing.
"""

from .publish import publish_staged_predictions  # noqa: F401
