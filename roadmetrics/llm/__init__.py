"""Training-data operators: dedup, decontamination, scoring, mixing, formatting and URL judging at corpus scale."""
