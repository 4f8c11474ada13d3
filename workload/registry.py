"""All registered queries with their SQL checks."""

from __future__ import annotations

from workload import alert_queries, dashboard_queries, ledger_queries, rule_queries, state_queries, stream_queries

REGISTERED = {
    **state_queries.QUERIES,
    **rule_queries.QUERIES,
    **alert_queries.QUERIES,
    **dashboard_queries.QUERIES,
    **ledger_queries.QUERIES,
    **stream_queries.QUERIES,
}
FLAGSHIP = REGISTERED["messages_to_velocity"][0]
