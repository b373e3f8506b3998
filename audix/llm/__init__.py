"""Training-data operators: licence scan, line dedup, language identification,
suffix dedup, graph search, id files, near-duplicate classes, packing, exact
top-k and byte-level BPE. Nothing else in the library imports this package."""
