"""Error type carrying a stable code and context, as the pipeline stages report them."""

from __future__ import annotations


class PipelineError(Exception):
    def __init__(self, message: str, error_code: str = "UNKNOWN", context: dict | None = None):
        super().__init__(message)
        self.message = message
        self.error_code = error_code
        self.context = context or {}

    def __str__(self) -> str:
        return f"[{self.error_code}] {self.message}"
