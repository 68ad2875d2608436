"""Marts, the model registry and layered runner, skew-aware window plans, and the query registry."""
