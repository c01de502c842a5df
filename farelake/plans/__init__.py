"""The curated relation and the jobs that keep the lake's zones."""
