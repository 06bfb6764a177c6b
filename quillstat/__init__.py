"""Creator analytics for social-publishing data, as lazy PySpark pipelines."""

from quillstat.session import build_session, tune

__all__ = ["build_session", "tune"]
