"""Sinks: observation tables, de-identified JSON, waveform records."""
