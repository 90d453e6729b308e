"""DataFrame-in / DataFrame-out operators: bronze, silver, upsert, de-duplication,
as-of pairing, size-checked joins and high-water-mark loads."""
