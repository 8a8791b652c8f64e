"""Training-data operators: cleaning, labelling, deduplicating, mixing and
encoding text corpora. Nothing else in the library imports this subpackage."""
