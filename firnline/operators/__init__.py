"""DataFrame operators on ordered trajectories, grids, lookups and waveforms."""
