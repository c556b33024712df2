"""Turn large document collections into reviewed financial statements with Spark."""

from razonete.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
