"""Multi-step table pipelines and the run log."""
