"""Pipeline stages as DataFrame compositions (bronze -> silver -> gold -> features)."""
