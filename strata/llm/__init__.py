"""Training-data operators: deduplication, language identification, mixing,
packing, search, license and personal-data scans over a corpus of documents."""
