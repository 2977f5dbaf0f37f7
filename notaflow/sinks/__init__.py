"""Sinks and table management (SNK-*)."""
