"""Training-data pipeline operators (license, secrets, dedup, toxicity, language, WARC, mixing, ...)."""
