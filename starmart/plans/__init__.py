"""Named reports and end-to-end pipelines."""
