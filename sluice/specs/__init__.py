"""Example contracts."""

from sluice.specs.lead import lead_specs

__all__ = ["lead_specs"]
