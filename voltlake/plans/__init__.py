"""Gold models, dashboards and the end-to-end run."""
