"""Spark jobs that turn raw speech-recognition output into clean, speaker-labelled transcripts."""
