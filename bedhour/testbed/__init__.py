"""Stand-in raw tables made from the test data, the queries that run over them,
and the same queries in SQL."""
