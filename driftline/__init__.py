"""Change-data capture, history and migration checks as PySpark jobs."""

from driftline.session import build_session, estimated_bytes, shared_dir

__all__ = ["build_session", "estimated_bytes", "shared_dir"]
