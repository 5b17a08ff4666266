"""Structured Streaming forms of the capture operators (#60-#62)."""

from .jobs import (run_to_table, stream_markdown, stream_politeness,  # noqa: F401
                   stream_unseen_urls)
