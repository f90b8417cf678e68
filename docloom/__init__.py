"""Technical documentation to fine-tuning data, with Spark."""
