"""Training-data operators: decontamination, toxicity, archives, deduplication, PII, mixing."""
