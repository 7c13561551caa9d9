"""Training-data operators: secrets, decontamination, licences, sharding, archives, packing,
quality, repeated bytes, near duplicates and quality rules. Nothing else in kiln imports this."""
