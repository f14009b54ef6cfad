"""Ready-made flows: staging, marts with their tests, and the full report."""
