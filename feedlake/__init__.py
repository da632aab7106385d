"""News-feed tables on Spark: collect, de-duplicate, classify, embed, retain, report."""
