"""End-to-end pipelines (account, product, time, invoice) and the registered
queries that exercise them on the driver's tables."""
