"""Media-library and listening-history analytics expressed as Spark jobs."""

from cratebook.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
