"""Streams: parsed messages, vehicle speed and word counts."""
