"""millrace: a PySpark engine that assembles and audits text corpora."""
