"""Training-data operators: archives, scoring, token counts, near duplicates, sharding, extraction, decontamination."""
