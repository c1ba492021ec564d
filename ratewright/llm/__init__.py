"""Training-data operators: filtering, near-duplicate removal, decontamination, sharding and packing."""
