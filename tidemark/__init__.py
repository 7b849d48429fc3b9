"""Session analytics on Spark: capture streams in, session facts out."""
