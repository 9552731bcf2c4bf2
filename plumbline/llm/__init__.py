"""Training-data operators: near and exact duplicates, decontamination, tokens, toxicity, HTML and WARC."""
