"""Wiring of operators over the driver tables (``checks``) and per-report
flows (``marketplace``)."""
