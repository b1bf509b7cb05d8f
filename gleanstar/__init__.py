"""gleanstar: profile, audit, clean and serve e-commerce style tables as Spark jobs."""

from gleanstar.session import build_session, configure

__all__ = ["build_session", "configure"]
