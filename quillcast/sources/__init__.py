"""Sources and sinks: CSV, JSON lines, transcripts, documents, waveforms and checksums."""
