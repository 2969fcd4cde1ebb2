"""chainloom - chain-event analytics as Spark DataFrame operators."""

from chainloom.session import build_session, configure

__all__ = ["build_session", "configure"]
