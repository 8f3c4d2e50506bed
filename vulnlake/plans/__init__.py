"""Plans: bindings of the test tables, the query catalog with its SQL oracles, and the full medallion run."""
