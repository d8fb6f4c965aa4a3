"""Operators on DataFrames: scoring, splitting, manifests, paragraphs, transcripts, alignment and the rest."""
