"""Plans: session settings, size-checked broadcasts and end-to-end jobs."""
