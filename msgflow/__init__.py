"""Message enrichment on Spark: channel pages and message feeds to typed, scored, geo-tagged tables."""
