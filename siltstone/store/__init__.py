"""Tables with versions on Parquet and a commit log."""
