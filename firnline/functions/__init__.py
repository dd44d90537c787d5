"""Column functions: vocabularies, predicates, geodesy, physics and waveforms."""
