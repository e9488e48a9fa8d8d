"""textloom: corpus curation on Spark - text kernels, quality metrics, de-duplication, language votes."""
