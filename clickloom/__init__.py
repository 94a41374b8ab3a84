"""clickloom: behaviour analytics as Spark DataFrame jobs."""

from clickloom.session import build_session, pin_session

__all__ = ["build_session", "pin_session"]
