"""pagemill: web-page snapshots in, clean document collections out, on Spark."""
