"""User-level composition: query text, pipelines and ready-made queries."""
