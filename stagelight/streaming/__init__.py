"""The load as a stream over arriving raw files."""
