"""Training-data pipeline operators: quality, decontamination, personal data,
mixing, language ID, near-duplicates, WARC, vector search, line dedup and
language-model scoring.  Nothing else in the package imports this one."""
