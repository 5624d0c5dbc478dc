"""Training-data operators: joins, decontamination, scoring, search, encoding and dedup over large text tables."""
