"""Registered queries, each with the table-derived inputs it runs on and its check SQL."""


def load() -> None:
    """Register all queries."""
    from plantlake.plans import q_browse, q_messages, q_model, q_monitor, q_streaming  # noqa: F401
