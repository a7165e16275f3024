"""Readers and writers: company CSVs, TPC-H-derived fixtures, the versioned registry store."""
