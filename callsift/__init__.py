"""Intent analytics over call transcripts, as Spark DataFrame operators."""
