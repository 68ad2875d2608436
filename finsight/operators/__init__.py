"""Row-level and grouped operators: staging projections, aggregates, windows, features,
scores, data checks and load statistics."""
