"""DataFrame operators shared by the table loads and the KPI queries."""
