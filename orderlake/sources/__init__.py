"""File sources (S1-S13) and table sinks."""
