"""Training-data pipeline operators: quality and toxicity scoring, exact, line,
substring and near-duplicate removal, benchmark decontamination, licence scans,
sequence packing and WARC archives. Nothing else in the library imports this
subpackage."""
