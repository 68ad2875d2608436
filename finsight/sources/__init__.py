"""Raw-layer sources and sinks: fixture mapping of the driver tables, CSV ingest/normalisation,
full-refresh loader, JDBC, premium schedule expansion."""
